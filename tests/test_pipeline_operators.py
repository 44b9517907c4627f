"""The general training-data operators on small cases: nulls, blanks, ties, repetitions, empty tables, clashing columns."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seedloom.operators.intervals import circular_periods_and_gaps, periods_and_gaps
from seedloom.operators.nested_tables import LEVELS, flat_paths, list_elements, member_rows, nested_objects
from seedloom.operators.orphans import PendingOrphans, orphan_state, parent_rows, referring_rows
from seedloom.operators.snapshot_diff import snapshot_changes
from seedloom.operators.wide_table import filled_cells, registry_columns, wide_table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- wide tables

REGISTRY = [("depth", "number", ["tiefe"]), ("days", "integer", []), ("edible", "boolean", None), ("light", "text", ["Light-Need"]), ("ph", "range", []), ("bloom", "window", []), ("stages", "record", [])]


@pytest.fixture
def registry(spark):
    return spark.createDataFrame(REGISTRY, "predicate string, value_type string, aliases array<string>")


FILLING = [
    ("depth", "1.5", 1.5), ("depth", '"1,5 cm"', 1.5), ("Tiefe", '{"value": "15e-1cm"}', 1.5), ("DEPTH", '"\\"2\\""', 2.0), ("depth", "-3", -3.0), ("depth", '{"unit":"cm","value":7}', 7.0),
    ("days", "9.0", 9), ("days", '"12 d"', 12), ("days", "9.5", None), ("days", "true", None), ("depth", '"deep"', None), ("depth", '"see table 3"', None),
    ("edible", '"Y"', True), ("edible", "false", False), ("edible", '" no "', False), ("edible", '"partly"', None), ("edible", "1", None),
    ("light-need", '" full sun"', "full sun"), ("light", '"n/a"', None), ("light", '"  "', None), ("light", "5", None), ("light", '{"value":"shade"}', "shade"),
    ("ph", '"5,5 – 6.5 pH"', (5.5, 6.5)), ("ph", "[1, 2]", (1.0, 2.0)), ("ph", '{"min":null,"max":3}', (None, 3.0)), ("ph", '{"min":null,"max":null}', None), ("ph", '"-1.5--0.5"', (-1.5, -0.5)), ("ph", "[]", None),
    ("bloom", '"3-1/05-20"', ("03-01", "05-20")), ("bloom", '{"from":"11-02","to":"1-3"}', ("11-02", "01-03")), ("bloom", '{"start":{"month":2,"day":3},"end":{"month":4,"day":5}}', ("02-03", "04-05")), ("bloom", '"13-01/01-01"', None), ("bloom", '"late spring"', None),
    ("stages", "{}", None), ("stages", "[]", None), ("stages", '"{\\"a\\":[]}"', '{"a":[]}'), ("stages", '[{"x":1}]', '[{"x":1}]'), ("stages", '{"value": {}}', '{"value":{}}'), ("stages", '"text"', None),
    ("depth", "{", None), ("depth", "1 2", None), ("depth", "null", None), ("depth", None, None), ("other", "1", None), (None, "1", None), ("depth", "", None),
]


@pytest.mark.filterwarnings("ignore")
def test_cells(spark, registry):
    df = spark.createDataFrame([(f"s{n}", p, v) for n, (p, v, _) in enumerate(FILLING)], "subjectId string, predicate string, value string").withColumn("cell", F.lit("clash")).withColumn("signature", F.lit(1))
    found = {r.subjectId: r for r in wide_table(df, registry).collect()}
    for n, (predicate, value, want) in enumerate(FILLING):
        row = found.get(f"s{n}")
        cells = {} if row is None else {k: tuple(v) if isinstance(v, tuple) else v for k, v in row.asDict().items() if k != "subjectId" and v is not None}
        if predicate == "bloom" and value == '"13-01/01-01"':  # one bound can be read
            assert cells == {"bloom": (None, "01-01")}
        else:
            assert list(cells.values()) == ([] if want is None else [want]), (predicate, value)


def test_wide_rows(spark, registry):
    data = [("a", "depth", "1", 3), ("a", "depth", "2", 1), ("a", "depth", "2", 1), ("a", "days", "4", 1), ("b", "light", '"x"', 1), (None, "depth", "1", 1), ("c", "depth", '"?"', 1), ("d", "light", json.dumps("y" * 200_000), 1)] + [("hot", "days", str(n), n) for n in range(300)]
    df = spark.createDataFrame(data, "subjectId string, predicate string, value string, t int")
    for tables in (1, 2, 7, 12):
        wide = wide_table(df, registry, order=("t",), tables=tables)
        assert wide.columns == ["subjectId", "bloom", "days", "depth", "edible", "light", "ph", "stages"]
        got = {r.subjectId: (r.depth, r.days, r.light and len(r.light)) for r in wide.collect()}
        assert got == {"a": (2.0, 4, None), "b": (None, None, 1), "d": (None, None, 200_000), "hot": (None, 0, None)}
        assert rows(filled_cells(wide)) == [("a", "days"), ("a", "depth"), ("b", "light"), ("d", "light"), ("hot", "days")]
    empty = wide_table(df.limit(0), registry)
    assert empty.collect() == [] and len(empty.columns) == 8
    with pytest.raises(ValueError):
        wide_table(df, registry.withColumn("value_type", F.lit("colour")))
    assert list(registry_columns(registry)) == sorted(p for p, _, _ in REGISTRY)


# --- snapshots


def naive_changes(data):
    by = {}
    for day, key, content in data:
        if day is not None:
            by.setdefault(day, {})
        if day is not None and key is not None:
            by[day][key] = max(content or "", by.get(day, {}).get(key, ""))
    out = set()
    for a, b in zip(sorted(by), sorted(by)[1:], strict=False):
        out |= {(k, str(b), "added") for k in by[b].keys() - by[a].keys()} | {(k, str(b), "removed") for k in by[a].keys() - by[b].keys()} | {(k, str(b), "changed") for k in by[a].keys() & by[b].keys() if by[a][k] != by[b][k]}
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 4), st.sampled_from([None, "", "a", "b", "c", "é"]), st.sampled_from(["x", "y"])), max_size=25))
def test_changes_as_naive(spark, data):
    data = [(dt.date(2024, d * d % 12 + 1, 1), k, c) for d, k, c in data]
    df = spark.createDataFrame(data, "snapshot_date date, id string, content string")
    found = snapshot_changes(df, received=None)
    assert {(r.id, str(r.snapshot), r.change) for r in found.collect()} == naive_changes(data)


def test_changes(spark):
    day = lambda n: dt.date(2024, n, 1)
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 9, 1)
    data = [
        (day(1), "same", '{"a":1, "b":2}', ["x", "y"], None, early), (day(3), "same", '{"b":2,"a":1.0}', ["y", "x"], None, late),
        (day(1), "null", None, None, None, early), (day(3), "null", "null", [], "c", early),
        (day(1), "twice", "1", [], "c", early), (day(3), "twice", "1", [], "c", early), (day(3), "twice", "2", [], "c", late),
        (day(1), "gone", "x", [], "c", early), (day(3), "new", "x", [], "c", early), (day(7), "new", "x" * 100_000, [], "c", early),
        (None, "undated", "x", [], "c", early), (day(3), None, "x", [], "c", early),
    ]
    df = spark.createDataFrame(data, "snapshot_date date, id string, value string, refs array<string>, snapshot string, received_at timestamp")
    found = {(r.id, r.snapshot.month, r.change, tuple(r.columns or ())) for r in snapshot_changes(df, json_columns=("value",)).collect()}
    assert found == {
        ("null", 3, "changed", ("value", "refs", "snapshot")), ("twice", 3, "changed", ("value",)), ("gone", 3, "removed", ()), ("new", 3, "added", ()),
        ("same", 7, "removed", ()), ("null", 7, "removed", ()), ("twice", 7, "removed", ()), ("new", 7, "changed", ("value",)),
    }
    assert snapshot_changes(df.limit(0)).collect() == [] and snapshot_changes(df.where("month(snapshot_date) = 1")).collect() == []


# --- orphans


def test_orphans(spark):
    t = lambda n: dt.datetime(2024, n, 5)
    refs = spark.createDataFrame(
        [("r1", t(2), ["p1", "p2", None, "p1"], "q1"), ("r1", t(3), ["p9"], "q9"), ("r2", t(4), ["late", "dead"], None), ("r3", None, ["p1"], "q1"), ("r4", t(6), None, ""), (None, t(1), ["p1"], "x"), ("r5", t(5), [], "fine")],
        "id string, received_at timestamp_ntz, many array<string>, one string",
    ).withColumn("reason", F.lit("clash"))
    parents = spark.createDataFrame([("p1", t(1), None), ("p1", t(9), t(9)), ("late", t(8), None), ("dead", t(1), t(7)), (None, t(1), None), ("tie", t(4), None)], "id string, received_at timestamp_ntz, deleted_at timestamp_ntz")
    others = spark.createDataFrame([("q1", t(2), None), ("fine", t(5), None)], parents.schema)
    references = referring_rows(refs, "t", {"many": "p", "one": "q"})
    ups = parent_rows(parents, "p").unionByName(parent_rows(others, "q"))
    want = [("many", "r1", "p2", "2024-02", "missing"), ("many", "r2", "dead", "2024-04", "deleted"), ("many", "r2", "late", "2024-04", "late"), ("one", "r4", "", "2024-06", "missing")]
    for batches in (1, 2, 5):
        found = orphan_state(references, ups, batches).open_references()
        assert rows(found.select("field", "id", "ref_id", "period", "reason")) == want
    assert rows(orphan_state(references, ups).counts().select("field", "period", "reason", "open_references")) == [("many", "2024-02", "missing", 1), ("many", "2024-04", "deleted", 1), ("many", "2024-04", "late", 1), ("one", "2024-06", "missing", 1)]
    assert orphan_state(references.limit(0), ups.limit(0)).open_references().collect() == []
    assert orphan_state(references, ups.limit(0)).open_references().count() == 9


def test_orphan_steps(spark):
    t = lambda n: dt.datetime(2024, n, 5)
    ref = lambda *ids: referring_rows(spark.createDataFrame([(f"r-{i}-{m}", t(m), i) for i, m in ids], "id string, received_at timestamp_ntz, f string"), "t", {"f": "p"})
    up = lambda *r: parent_rows(spark.createDataFrame(list(r), "id string, received_at timestamp_ntz, deleted_at timestamp_ntz"), "p")
    state = PendingOrphans(spark)
    assert state.open_references().collect() == []
    reasons = lambda **o: {r.ref_id: r.reason for r in state.open_references(**o).collect()}
    state.apply(ref(("a", 1), ("b", 1)), up(("c", t(1), None)))
    assert reasons() == {"a": "missing", "b": "missing"}
    state.apply(ref(("c", 2)), up(("a", t(2), None)))  # an arriving parent resolves what waits
    assert reasons() == {"a": "late", "b": "missing"}
    gone = spark.createDataFrame([("p", "c", t(3))], "target string, ref_id string, deleted_at timestamp_ntz")
    state.apply(ref(("a", 3)).limit(0), up(("x", t(1), None)).limit(0), gone)  # a deletion reopens
    assert reasons() == {"a": "late", "b": "missing", "c": "deleted"}
    assert reasons(until=F.lit(t(2))) == {"a": "late", "b": "missing"}


# --- intervals


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-5, 20) | st.none(), st.integers(-5, 20) | st.none()), max_size=12))
def test_line_as_naive(spark, data):
    df = spark.createDataFrame(data, "kind string, s int, e int").withColumn("delta", F.lit("clash"))
    want = set()
    for key in {k for k, s, e in data}:
        points = {p for k, s, e in data if k == key and s is not None and e is not None for p in range(s, e + 1)}
        for name, on in (("period", points), ("gap", set(range(min(points, default=0), max(points, default=0))) - points)):
            want |= {(key, name, p, next(q for q in range(p, 99) if q + 1 not in on)) for p in on if p - 1 not in on}
    df = df.withColumnRenamed("kind", "key")
    for bucket in (None, 4):
        assert {tuple(r) for r in periods_and_gaps(df, ["key"], "s", "e", bucket).collect()} == want


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 13) | st.none(), st.integers(1, 12)), max_size=8))
def test_circle_as_naive(spark, data):
    df = spark.createDataFrame(data, "k string, s int, e int")
    want = set()
    for key in {k for k, _, _ in data}:
        on = set()
        for k, s, e in data:
            if k == key and s is not None and 1 <= s <= 12:
                on |= set(range(s, e + 1)) if s <= e else set(range(s, 13)) | set(range(1, e + 1))
        if len(on) == 12:
            want.add((key, "period", 1, 12))
        elif on:
            for name, part in (("period", on), ("gap", set(range(1, 13)) - on)):
                for m in part:
                    if (m - 2) % 12 + 1 not in part:
                        end = m
                        while end % 12 + 1 in part:
                            end = end % 12 + 1
                        want.add((key, name, m, end))
    assert {tuple(r) for r in circular_periods_and_gaps(df, ["k"], "s", "e", 1, 12).collect()} == want


def test_circle_needs_points(spark):
    with pytest.raises(ValueError):
        circular_periods_and_gaps(spark.createDataFrame([], "k string, s int, e int"), ["k"], "s", "e", 5, 1)


# --- nested records


def test_nested(spark):
    texts = {
        "plain": '{"a":[{"b.c":[{"d":1},5,null,{"e":[[{}]]}]}],"o":{"p":[{}]}}', "root": "[{}, [], {}]", "text": json.dumps('[{"x":1}]'), "twice": json.dumps(json.dumps([{"y": 1}])),
        "inner": json.dumps({"a": ['{"z":[{}]}', "[broken"]}), "null": None, "blank": "", "broken": '[{"a":1}', "scalar": "5", "repeated": '[{"a":1,"a":2}]', "long": json.dumps([{"t": "x" * 50_000}] * 3),
    }
    df = spark.createDataFrame(list(texts.items()), "id string, value string").withColumn("path", F.lit("clash"))
    found = {}
    for r in nested_objects(df).collect():
        found.setdefault(r.id, []).append((r.path, r.parent_path, r.position))
    assert {k: sorted(v, key=str) for k, v in found.items()} == {
        "plain": [("value.a[0]", "value", 0), ("value.a[0].b.c[0]", "value.a[0]", 0), ("value.a[0].b.c[3]", "value.a[0]", 3), ("value.a[0].b.c[3].e[0][0]", "value.a[0].b.c[3]", 0), ("value.o.p[0]", "value.o", 0)],
        "root": [("value[0]", None, 0), ("value[2]", None, 2)], "text": [("value[0]", None, 0)], "twice": [("value[0]", None, 0)],
        "inner": [("value.a[0]", "value", 0), ("value.a[0].z[0]", "value.a[0]", 0)], "long": [(f"value[{n}]", None, n) for n in range(3)],
    }
    assert nested_objects(df.limit(0)).collect() == []


@pytest.mark.parametrize("depth", [LEVELS - 1, LEVELS, LEVELS + 1, 60])
def test_any_depth(spark, depth):
    text = '{"a":[' * depth + "{}" + "]}" * depth
    df = spark.createDataFrame([("x", text)], "id string, value string")
    assert sorted(r.path for r in nested_objects(df).collect()) == sorted("value" + ".a[0]" * k for k in range(1, depth + 1))


def test_flat_tables(spark):
    context = "struct<geographicContextIds:array<string>>"
    a = spark.createDataFrame([("1", "[{}]", (["g", None, "h"],)), ("1", "[{}]", (["g", None, "h"],)), ("2", None, None), ("3", "x", (None,)), (None, "[{}]", (["g"],))], f"id string, value string, context {context}")
    e = spark.createDataFrame([("1", ("l",)), ("2", None), ("3", (None,))], "id string, rights struct<licenceId:string>")
    path = "context.geographicContextIds"
    assert rows(flat_paths(a, e)) == [("assertions", "1", f"{path}[0]"), ("assertions", "1", f"{path}[2]"), ("assertions", "1", "value[0]"), ("evidence_references", "1", "rights.licenceId")]
    assert rows(list_elements(a.limit(1), path, "g")) == [("1", "g[0]", 0, "g"), ("1", "g[2]", 2, "h")]
    assert rows(member_rows(e, "rights.licenceId")) == [("1", "rights.licenceId", "l")]
    assert flat_paths(a.limit(0), e.limit(0)).collect() == []
