"""The text operators on small cases: nulls, blanks, ties, repetitions, empty tables, clashing columns, brute force."""

import json
import os
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seedloom.llm import format_duplicates as fd
from seedloom.llm import leakage, packing, residue
from seedloom.llm.visual_text import look_classes, one_form, same_looking


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- one visual form

LOOKS = [
    ("ｆｅｒｎ （１）", "fern (1)"), ("é", "é"), ("fe​rn­", "fern"), ("a b", "a b"), ("аео", "aeo"), ("ό", "ó"), ("ό", "ó"), ("ｶﾞ", "ガ"), ("ﬁg", "fig"), ("Ⅷ", "VIII"),
    ("x²", "x²"), ("a  b\t", "a  b\t"), ("a’b", "a’b"), ("", ""), ("​", ""), (None, None), ("ї", "ï"), ("ớ", "ớ"), ("e​́", "é"), ("plain", "plain"), ("　", " "),
]


def test_forms(spark):
    df = spark.createDataFrame([(n, v) for n, (v, _) in enumerate(LOOKS)] + [(99, "ｘ" * 300_000)], "n int, value string").withColumn("other", F.lit(1))
    found = {r.n: r.form for r in one_form(df, "value", "n").collect()}
    assert [found[n] for n in range(len(LOOKS))] == [form for _, form in LOOKS]
    assert found[99] == "x" * 300_000
    again = one_form(one_form(df, "value", "n").select("n", F.col("form").alias("value")), "value", "n")
    assert again.where("not form <=> value").count() == 0
    assert one_form(df.limit(0), "value").collect() == []
    with pytest.raises(ValueError):
        one_form(df.withColumn("form", F.lit("x")), "value", "form")


def test_pairs(spark):
    data = [("1", "s", "ｆern"), ("2", "s", "fern"), ("3", "s", "fern"), ("4", "t", "fern"), ("5", None, "fern"), ("6", None, "ｆern"), ("7", "s", None), ("8", "s", "Fern"), ("2", "s", "fern"), (None, "s", "ｆern"), ("9", "s", "fe​rn")]
    df = spark.createDataFrame(data, "id string, subjectId string, value string").withColumn("form", F.lit("clash"))
    assert rows(same_looking(df)) == [("1", "2"), ("1", "3"), ("1", "9"), ("2", "9"), ("3", "9")]
    assert same_looking(df.limit(0)).collect() == []


def test_classes(spark):
    data = [("1", "s", "ｆern"), ("2", "s", "fern"), ("3", "s", "fern"), ("4", "t", "fern"), ("5", None, "fern"), ("7", "s", None), ("8", "s", "Fern"), ("2", "s", "fern"), (None, "s", "ｆern"), ("9", "s", "fe\u200brn")]
    df = spark.createDataFrame(data, "id string, subjectId string, value string").withColumn("links", F.lit("clash"))
    assert rows(look_classes(df).select("id", "class_id", "links")) == [("1", "1", 3), ("2", "1", 2), ("3", "1", 2), ("9", "1", 3)]
    hot = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit("s").alias("subjectId"), F.when(F.col("id") % 2 == 0, "fern").otherwise("f\u0435rn").alias("value"))
    assert rows(look_classes(hot).groupBy("class_id", "links").count()) == [("0", 10_000, 20_000)]  # a hundred million pairs
    assert look_classes(df.limit(0)).collect() == []


# --- formatting


def naive_key(text):
    return None if text is None else [c for ch in text for c in unicodedata.normalize("NFD", ch.casefold()) if unicodedata.category(c)[0] in "LN" or unicodedata.combining(c)]


@settings(deadline=None)  # the first call builds the table
@given(st.lists(st.tuples(st.text("aÀàé́eßẞ1٣ -_\t’ÅǺガ゙", max_size=8), st.text("aÀàé́eßẞ1٣ -_\t’ÅǺガ゙", max_size=8)), max_size=6))
def test_hashes_follow_content(pairs):
    import pyarrow as pa

    texts = [t for p in pairs for t in p]
    hashes = fd.rolling_hashes(pa.array(texts, pa.string())).to_pylist()
    for a, x in zip(texts, hashes, strict=True):
        assert fd.folded_codes(a).tolist() == [ord(c) for c in naive_key(a)]
        for b, y in zip(texts, hashes, strict=True):
            assert (x == y) == fd.same_content(a, b) == (naive_key(a) == naive_key(b))


@settings(deadline=None)
@given(st.lists(st.text("aÀàé́eßẞ1٣ -_Ǻガ゙", max_size=30) | st.none(), max_size=6), st.integers(1, 9))
def test_blocks_change_nothing(texts, block):
    import pyarrow as pa

    column = pa.array(texts, pa.string())
    assert fd.rolling_hashes(column, block).to_pylist() == fd.rolling_hashes(column).to_pylist()
    for a in texts:
        for b in texts:
            assert fd.same_content(a, b, block) == (naive_key(a) == naive_key(b))


def test_copies(spark):
    data = [
        ("b", "S-1", "en", "Red Leaf"), ("a", "s1", "EN", "red-leaf!"), ("c", "S 1", "en", "REDLEAF"), ("d", "s1", "en", "réd leaf"), ("e", "s1", "en", "réd leaf"), ("f", None, "en", "x"), ("g", None, "en", "X"),
        ("h", "", "en", "x"), ("i", "s1", "en", None), ("j", "s1", "en", ""), ("k", "s1", "en", "?!"), ("l", "s", "1en", "redleaf"), ("a", "s1", "EN", "red-leaf!"), (None, "s1", "en", "red leaf"), ("m", "z", "en", "y" * 200_000), ("n", "z", "en", "Y " * 200_000),
    ]
    df = spark.createDataFrame(data, "id string, subjectId string, languageTag string, value string").withColumn("first", F.lit("clash"))
    assert rows(fd.format_duplicates(df)) == [("a", "b"), ("a", "c"), ("d", "e"), ("f", "g"), ("j", "k"), ("m", "n")]
    counts = dict(rows(fd.collapsed(df)))
    assert counts == {"a": 3, "d": 2, "f": 2, "h": 1, "i": 1, "j": 2, "l": 1, "m": 2}
    assert fd.format_duplicates(df.limit(0)).collect() == [] and fd.collapsed(df.limit(0)).collect() == []


def test_collisions_are_told_apart(spark, monkeypatch):
    # every value gets the same hash: the comparison and the digest have to do all the work
    import pyarrow as pa

    def same(n):
        def run(batches):
            for batch in batches:
                zero = pa.array([7] * batch.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, *[zero] * n], [*batch.schema.names, *(f"h{k}" for k in range(n))])

        return run

    monkeypatch.setattr(fd, "_hash", same)
    df = spark.createDataFrame([("1", "a"), ("2", "A."), ("3", "b"), ("4", "B"), ("5", "c"), ("6", None), ("7", None), ("8", "b-")], "id string, v string")
    assert rows(fd.format_duplicates(df, fields=("v",))) == [("1", "2"), ("3", "4"), ("3", "8"), ("6", "7")]


# --- containers


def by_words(documents, id, text, vocabulary):
    return documents.select(F.col(id).alias("id"), F.expr(f"cast(length({text}) as bigint)").alias("size"))


def checked(found, sizes, capacity):
    """Total room and number of containers; nothing is lost, cut or too full."""
    fill, seen = {}, {}
    for r in found:
        fill[r.container] = fill.get(r.container, 0) + r.n_tokens
        seen.setdefault(r.doc_id, []).append((r.piece, r.n_tokens))
    assert all(v <= capacity for v in fill.values())
    for k, parts in seen.items():
        assert sorted(p for p, _ in parts) == list(range(len(parts))) and sum(n for _, n in parts) == sizes[k]
        assert len(parts) == max(1, -(-sizes[k] // capacity))
    assert set(seen) == set(sizes)
    return len(fill)


def test_containers(spark):
    lengths = [(n * 7919) % 97 + 1 for n in range(600)] + [0, 100, 101, 350, 200]
    data = [(n, "x" * k) for n, k in enumerate(lengths)] + [(9999, None)]
    df = spark.createDataFrame(data, "doc_id bigint, text string").withColumn("draw", F.lit("clash"))
    packs = spark.createDataFrame([(1, 100), (2, 256), (None, 5), (3, None), (4, 0)], "pack_id int, capacity_tokens int")
    found = packing.containers(df, packs, measure=by_words, region_size=100).collect()
    for pack, capacity in ((1, 100), (2, 256)):
        n = checked([r for r in found if r.pack_id == pack], dict(enumerate(lengths)), capacity)
        least = -(-sum(lengths) // capacity)
        assert n <= least * 1.06 + 1, (pack, n, least)
    again = packing.containers(df.limit(0), packs, measure=by_words)
    assert again.collect() == [] and again.columns == ["pack_id", "doc_id", "piece", "n_tokens", "container"]
    assert packing.containers(df, packs.limit(0), measure=by_words).collect() == []


@pytest.mark.parametrize(("low", "high", "gain"), [(200, 600, 3), (250, 500, 6)])
def test_evolution_improves_on_best_fit(low, high, gain):
    from random import Random

    random = Random(3)
    sizes = [random.randint(low, high) for _ in range(500)]
    first = packing._best_fit(sorted(range(500), key=sizes.__getitem__, reverse=True), sizes, 1000, [])
    assert packing.evolve(sizes, 1000, 1, [], generations=0)[0] == first
    island = packing.evolve(sizes, 1000, 1, [])
    moved = packing.evolve(sizes, 1000, 2, island)
    for best in (island[0], moved[0]):
        assert sorted(i for b in best for i in b) == list(range(500)) and all(sum(sizes[i] for i in b) <= 1000 for b in best)
    assert len(moved[0]) <= len(island[0]) <= len(first) - gain
    assert len(moved[0]) >= -(-sum(sizes) // 1000)


@given(st.lists(st.integers(0, 100), max_size=40))
@settings(deadline=None)
def test_refilling_loses_nothing(sizes):
    bins = packing._refilled(list(range(len(sizes))), sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(b and sum(sizes[i] for i in b) <= 100 for b in bins)


@pytest.mark.skipif(not os.path.exists(packing.VOCABULARY), reason="no vocabulary here")
def test_token_lengths(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(packing.VOCABULARY, "rb"))}
    encoding = tiktoken.Encoding("t", pat_str=packing.CUT, mergeable_ranks=ranks, special_tokens={})
    texts = ["I'm here, it's 12°C.", "", None, "<|endoftext|> ñandú 日本", " \n\n  x " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = dict(rows(packing.token_lengths(df)))
    assert [found[n] for n in range(len(texts))] == [None if t is None else len(encoding.encode_ordinary(t)) for t in texts]
    assert encoding.decode(encoding.encode_ordinary(texts[3])) == texts[3]


# --- leaks

ITEMS = [(1, "When the Brona tank loses 298 litres between dusk and dawn while the Keld valve stays shut, the notebook marks 782 on the margin."), (2, "How many crates does Oril need for 380 bulbs when each crate of the Bama kind takes 893 and the last stays half empty?"), (3, None), (4, ""), (5, "too short")]


def brute(documents, items):
    grams = {}
    for i, text in items:
        w = leakage.words(text)
        for k in range(len(w) - 11):
            grams.setdefault(tuple(w[k : k + 12]), set()).add(i)
    out = set()
    for d, text in documents:
        w = leakage.words(text)
        for k in range(len(w) - 11):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + 12]), ())}
    return out


def test_leaks(spark):
    own = leakage.words(ITEMS[0][1])
    noise = "The readings were fine until day nine and then fell. My table has three columns and nothing else. "
    docs = [(n, noise * (n % 5 + 1)) for n in range(40)]
    docs += [(100 + k, f"{noise * (k % 3)}{' | '.join(own[k : k + 12]).upper()} {noise}") for k in range(len(own) - 11)]
    docs += [(200 + k, f"{noise}{' '.join(own[k : k + 11])} {noise}") for k in range(len(own) - 10)]
    docs += [(300, ITEMS[1][1]), (301, None), (302, ""), (303, "word"), (304, noise * 500 + ITEMS[1][1]), (305, "when the Brona tank lost 298 litres from dusk till dawn while the Keld valve was shut the notebook says 782 on its margin")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("kind", F.lit("clash"))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("cosine", F.lit("clash"))
    found = leakage.leaks(df, items).collect()
    assert {(r.doc_id, r.item_id) for r in found if r.kind == "verbatim"} == brute(docs, ITEMS)
    assert {(r.doc_id, r.item_id) for r in found if r.kind == "paraphrase"} >= {(305, 1)}
    by = {(r.doc_id, r.item_id): r for r in found}
    assert by[300, 2].run == by[300, 2].common == len(leakage.words(ITEMS[1][1])) and by[300, 2].answers == 1
    assert leakage.leaks(df.limit(0), items).collect() == [] and leakage.leaks(df, items.limit(0)).collect() == []


@settings(deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=12), st.lists(st.sampled_from("abc"), max_size=12))
def test_subsequence_and_run(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    run = 0
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            run = max(run, n)
    assert leakage.common_subsequence(a, b) == table[-1][-1] and leakage.longest_run(a, b) == run


# --- residue

RESIDUE = [
    "Please enable JavaScript to view this page.", "404 Not Found\n\nThe page you asked for does not exist on this server.", "{{ product }}", "Hello [NAME HERE], see %(body)s", "Use 9 cm for ${date}.", "How to grow &lt;plant&gt; on a roof",
    "I water at dusk.\n\n[more text to follow here]", "Lorem ipsum dolor sit amet consectetur adipiscing elit.", "asdf asdf qwer asdf", "TODO: write the answer", "Internal error. Ref. 9b9aa9", '{"error": {"code": 500, "message": "thread lookup failed", "trace": "9cf9"}}',
    "Fine so far. " * 5000 + "\n\nYour answer here. Your answer here.", "Veuillez activer JavaScript pour afficher cette page.", "Seite nicht gefunden.",
]
GENUINE = [
    'How do I get rid of "Please enable JavaScript" on the dashboard? Scripts are on.', "My label printer prints `{{ ros }}` instead of the bed name, which setting fills it in?", "```\n<li>{{ a.b }}</li>\n```\nIt works.", "> Please enable JavaScript to view this page.\n\nI see this too.",
    "Le gabarit affiche {{ nel }} tel quel, il manque l'appel à render() avant l'envoi.", "I left a TODO in f() and the sensor still works, should I care?", "No.", "9 cm.", "", None, "See https://x.test/p/9 (dead link since last year).", "    for f in ${DIR}/*.csv; do\n      echo $f\n    done",
    "The planner shows \"404 Not Found\" whenever I open bed 9, though the file is there.", "[original answer](https://x.test/a/9) has been taken down.", "I filled the label with lorem ipsum to test the width and the last two words were cut off.",
]


def test_residue(spark):
    docs = [(n, t) for n, t in enumerate(RESIDUE + GENUINE)] + [(1000 + n, f"I have a bed of {n} plants and the leaves curl when the page of my notebook is wet.") for n in range(200)] + [(0, RESIDUE[0])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("coverage", F.lit("clash"))
    found = {r.doc_id for r in residue.residue_documents(df).collect()}
    assert found == set(range(len(RESIDUE))), [(RESIDUE + GENUINE)[k][:60] for k in found ^ set(range(len(RESIDUE)))]
    assert residue.residue_coverage(df).where("doc_id = 0").count() == 2
    assert residue.residue_documents(df.limit(0)).collect() == []


def test_other_exemplars(spark):
    df = spark.createDataFrame([(1, "Under construction, come back soon."), (2, "Please enable JavaScript.")], "doc_id bigint, text string")
    found = residue.residue_coverage(df, kinds={"note": ["Under construction, come back soon."]}, genuine=[])
    assert {r.doc_id: r.coverage >= residue.COVERED for r in found.collect()} == {1: True, 2: False}


def test_genuine_talk_keeps_a_text(spark):
    texts = ["Glaze the pot with ⟦slot⟧.", "Brush the pot with {{ colour }} before you fire it, the kiln template wants it."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kinds = {"placeholder": ["⟦slot⟧"]}
    marked = lambda genuine: {r.doc_id for r in residue.residue_coverage(df, kinds=kinds, genuine=genuine).collect() if r.coverage >= residue.COVERED}
    assert marked([]) == {0, 1}
    assert marked(["Brush the pot with ⟦slot⟧ before you fire it in the kiln; the template wants it."]) == {0}


def test_cases_are_told_apart(spark, data):
    from seedloom.llm.queries import QUERIES

    row = QUERIES["p10_held_out"](spark, data).first()
    assert row.found and row.rightly and row.kept


def test_queries(spark, data):
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
    from oracle import compare, database

    from seedloom.llm.queries import QUERIES, SQL

    con = database(data)
    for name, query in QUERIES.items():
        if name in SQL:
            compare(spark, data, query, SQL[name], con)
        else:
            assert query(spark, data).count() >= 0, json.dumps(name)
