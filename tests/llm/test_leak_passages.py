"""A paraphrase counts wherever it stands in a document, also beside a passage that is nearer to the item."""

from seedloom.llm import leakage

ITEM = "When the Brona tank loses 298 litres between dusk and dawn while the Keld valve stays shut, the notebook marks 782 on the margin."
PIECE = "tank loses 298 litres between dusk and dawn while the Keld"
PARAPHRASE = "when the Brona tank lost 298 litres from dusk till dawn while the Keld valve was shut the notebook says 782 on its margin"
NOISE = "Our readings were fine until day nine, then fell; my table has three columns, nothing else of interest follows here. " * 8


def test_paraphrase_beside_a_nearer_passage(spark):
    texts = {1: PARAPHRASE, 2: f"{PIECE}. {NOISE}{PARAPHRASE}", 3: f"{NOISE}{PARAPHRASE}. {NOISE}{PIECE}", 4: f"{NOISE}{PIECE}", 5: NOISE, 6: f"{PIECE}. {NOISE}{ITEM}"}
    documents = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: r for r in leakage.leaks(documents, spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")).collect()}
    assert {d: r.kind for d, r in found.items()} == {1: "paraphrase", 2: "paraphrase", 3: "paraphrase", 6: "verbatim"}
    wanted = leakage.words(ITEM)
    assert all(found[d].common >= leakage.PARAPHRASE * len(wanted) and found[d].answers >= leakage.ANSWERS for d in (1, 2, 3))


def test_many_items_in_bounded_memory(spark, monkeypatch):
    import random
    import tracemalloc

    r = random.Random(1)
    vocabulary = ["".join(r.choice("aeioubcdfglmnprst") for _ in range(7)) for _ in range(20_000)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(30))) for k in range(10_000)]
    sizes = []
    monkeypatch.setattr(leakage, "MOST_PASSAGES", 40_000)
    for held in leakage.blocks_of_items(iter(items), 40_000):
        sizes.append(len(held.passages))
    assert len(sizes) == 5 and max(sizes) <= 40_000 and sum(sizes) == 10_000 * 19
    docs = [(n, " ".join(r.choice(vocabulary) for _ in range(60)) + " " + " ".join(items[n * 97 % 10_000][1].split()[4:20])) for n in range(60)]
    tracemalloc.start()
    found = leakage.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).where("kind = 'verbatim'").collect()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(x.doc_id, x.item_id) for x in found} == {(n, n * 97 % 10_000) for n in range(60)}
    assert peak < 1_000_000_000  # dense passages of the whole vocabulary would be 15 GB


def test_ids_with_two_texts(spark):
    one = "the red leaf of the old tree falls near the stone wall at dusk in june"
    two = "a green frog sits below the wet bridge and waits for the small fly at noon"
    items = spark.createDataFrame([(1, one), (1, two), (2, "?!")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, one), (2, two), (3, "nothing here")], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in leakage.leaks(docs, items).collect()) == [(1, 1), (2, 1)]
