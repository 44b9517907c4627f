"""Whole results that the SQL can't express, by brute force on small tables and on the test tables."""

import datetime as dt
import json
import re
from collections import defaultdict

from pyspark.sql import Row

from seedloom.plans import catalogue_queries as q


def test_contradictions_of_any_shape(spark, tmp_path):
    context = (["g2", "g1"], "soil", None)
    said = [
        ("number", "107.5", "163.0"), ("range", '{"min": 4, "max": 6}', '{"max": 6, "min": 5}'), ("window", '{"from": "01-02"}', '{"from": "01-03"}'), ("list", "[1, 2]", "[2, 1]"), ("kinds", '"1"', "1"), ("plain", "true", "false"), ("null", "null", "0"),
        ("same number", "163", "163.0"), ("same power", "1e2", "100"), ("same members", '{"a": 1, "b": [2.50]}', '{"b":[2.5],"a":1.0}'), ("unreadable", "{", "1"), ("none", None, "1"), ("repeated member", '{"a": 1, "a": 2}', "1"), ("blanks", '"a"', ' "a" '),
    ]
    rows = [("plant-concept", "p", name, value, context) for name, *values in said for value in values]
    rows += [("plant-concept", "p", "elsewhere", "1.5", context), ("plant-concept", "p", "elsewhere", "2.5", (["g1"], "soil", None))]
    schema = "subjectType string, subjectId string, predicate string, value string, context struct<geographicContextIds: array<string>, growingSystem: string, propagation: string>"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/assertions.parquet")
    found = {r.predicate: (r.geo, r.growingSystem, r.propagation, r.different) for r in q.contradiction_report(spark, str(tmp_path)).collect()}
    assert found == dict.fromkeys(("number", "range", "window", "list", "kinds", "plain", "null"), ("g1,g2", "soil", None, 2))


def _readable(text):
    def members(pairs):
        if len(dict(pairs)) < len(pairs):
            raise ValueError("repeated member")
        return tuple(sorted(dict(pairs).items(), key=str))

    def fixed(x):
        if isinstance(x, list):
            return ("list", *map(fixed, x))
        if isinstance(x, tuple):
            return ("members", *((k, fixed(v)) for k, v in x))
        return ("number", float(x)) if type(x) in (int, float) else x

    try:
        return repr(fixed(json.loads(text, object_pairs_hook=members)))
    except ValueError:
        return None


def test_contradictions_by_brute_force(spark, data):
    groups = defaultdict(set)
    for r in spark.read.parquet(f"{data}/assertions.parquet").collect():
        c = r.context
        geo = c and c.geographicContextIds
        if r.value is not None and (value := _readable(r.value)) is not None:
            groups[r.subjectType, r.subjectId, r.predicate, None if geo is None else ",".join(sorted(g for g in geo if g is not None)), c and c.growingSystem, c and c.propagation].add(value)
    want = {(*k, len(v)) for k, v in groups.items() if len(v) > 1}
    got = [tuple(r) for r in q.contradiction_report(spark, data).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def _build(spark, folder, rows):
    schema = "snapshot_date date, id string, status string, taxonId string, replacementPlantConceptId string, evidenceReferenceIds array<string>, received_at timestamp"
    spark.createDataFrame([(dt.date.fromisoformat(d), *r, dt.datetime(2024, 1, n + 1)) for n, (d, *r) in enumerate(rows)], schema).write.parquet(f"{folder}/plant_concept_snapshots.parquet")


def test_builds_differ_in_any_column(spark, tmp_path):
    a, m, b = "2024-01-01", "2024-02-01", "2024-03-01"
    same, again = ("same", "active", "t", None, ["e1", "e2"]), ("again", "active", "t", None, None)
    rows = [(a, *same), (b, "same", "active", "t", None, ["e2", "e1"]), (a, "replaced", "active", "t", None, []), (b, "replaced", "active", "t", "p", []), (a, "evidence", "active", "t", None, ["e1"]), (b, "evidence", "active", "t", None, ["e1", "e1"])]
    rows += [(a, "null", "active", "t", None, None), (b, "null", "active", "t", None, []), (a, "status", "active", "t", None, []), (b, "status", "retired", "t", None, []), (m, "between", "active", "t", None, []), (a, *again), (a, *again), (b, *again)]
    _build(spark, tmp_path, rows)
    found = sorted((r.side, r.id) for r in q.build_compare(spark, str(tmp_path)).collect())
    assert found == [("first", x) for x in ("again", "evidence", "null", "replaced", "status")] + [("second", x) for x in ("evidence", "null", "replaced", "status")]


REGISTRY = [("depth", "number", "cm", ["wurzel tiefe"]), ("days", "integer", "d", None), ("acidity", "range", "pH", []), ("form", "text", None, []), ("bloom", "window", None, [])]


def test_measures_of_any_shape(spark, tmp_path):
    said = [
        ("depth", '{"value": 5, "unit": "mm"}', None, [(None, 5.0, "mm", 0.005)]), ("depth", '{"value": "5,5 mm"}', None, [(None, 5.5, "mm", 0.0055)]), ("Depth", '"9.9 cm"', None, [(None, 9.9, "cm", 0.099)]), ("other", '"9,9mm"', None, [(None, 9.9, "mm", 0.0099)]),
        ("other", '"9kg"', None, [(None, 9.0, "kg", 9.0)]), ("other", "7", "kg", [(None, 7.0, "kg", 7.0)]), ("other", '"7,5"', "cm", [(None, 7.5, "cm", 0.075)]), ("Wurzel-Tiefe", "12", None, [(None, 12.0, "cm", 0.12)]), ("depth", '"12 mm"', "cm", [(None, 12.0, "mm", 0.012)]),
        ("depth", '"{\\"value\\": 3, \\"unit\\": \\"cm\\"}"', None, [(None, 3.0, "cm", 0.03)]), ("depth", '{"value": 3, "unit": " CM "}', None, [(None, 3.0, "CM", 0.03)]), ("days", '"4 d"', None, [(None, 4.0, "d", None)]),
        ("acidity", '{"min": 4.5, "max": null, "unit": "pH"}', None, [("min", 4.5, "pH", None)]), ("acidity", "[4.5, 6]", None, [("min", 4.5, "pH", None), ("max", 6.0, "pH", None)]), ("acidity", '"4,5 – 6,5"', None, [("min", 4.5, "pH", None), ("max", 6.5, "pH", None)]), ("other", '"4 to 6 cm"', None, [("min", 4.0, "cm", 0.04), ("max", 6.0, "cm", 0.06)]),
        ("depth", "true", None, []), ("depth", "null", None, []), ("depth", '"see note 4"', None, []), ("depth", "{", None, []), ("depth", None, None, []), ("depth", '" "', None, []), ("other", "7", None, []), ("form", '"7"', None, []), ("bloom", '"04-12/05-03"', None, []), ("bloom", '{"from": "04-12", "to": "05-03"}', None, []), ("depth", '"9 cm", 1', None, []), ("form", "[1, 2]", None, []),
    ]
    spark.createDataFrame([(str(n), p, v, (None, None, u)) for n, (p, v, u, _) in enumerate(said)], "id string, predicate string, value string, normalization struct<originalValue: string, method: string, unit: string>").write.parquet(f"{tmp_path}/assertions.parquet")
    spark.createDataFrame(REGISTRY, "predicate string, value_type string, unit string, aliases array<string>").write.parquet(f"{tmp_path}/predicate_registry.parquet")
    found = defaultdict(set)
    for r in q.unit_normalisation(spark, str(tmp_path)).collect():
        assert r.original == said[int(r.id)][1] and r.base_unit == {"cm": "m", "mm": "m", "kg": "kg"}.get(r.unit.lower())
        found[r.id].add((r.bound, r.number, r.unit, r.base_value and round(r.base_value, 9)))
    for n, (*_, want) in enumerate(said):
        assert found[str(n)] == set(want), said[n]


_N, _U = r"[+-]?(?:\d+(?:[.,]\d*)?|[.,]\d+)(?:[eE][+-]?\d+)?", r"(?:[^\W\d_]|[%°µ])[\w°%²³/.]*"


def _measures(text, named, unit):
    """Bound, number and unit of each number of one value; ``named``: value types and units of its predicate."""

    def number(x):
        if x is None or isinstance(x, bool | dict | list):
            return None
        m = re.fullmatch(rf"({_N})\s*({_U})?", x.strip() if isinstance(x, str) else repr(x))
        return m and (float(m[1].replace(",", ".")), m[2])

    try:
        value = json.loads(text)
        while isinstance(value, str) and value.lstrip()[:1] in tuple('[{"'):
            value = json.loads(value)
    except ValueError:
        return set()
    own = value.get("unit") if isinstance(value, dict) else None
    if isinstance(value, dict) and value.get("value") is not None:
        value = value["value"]
    out = set()
    for kind, registered in named or [(None, None)]:
        parts, both = [(None, number(value))], (None, None)
        if isinstance(value, dict):
            both = [number(next((value[n] for n in names if value.get(n) is not None), None)) for names in (("min", "low", "lower", "from"), ("max", "high", "upper", "to"))]
        elif isinstance(value, list) and len(value) == 2 and kind == "range":
            both = [number(x) for x in value]
        elif isinstance(value, str) and (m := re.fullmatch(rf"({_N}(?:\s*{_U})??)\s*(?:-|–|—|~|\.\.+|to|bis|à|a|until)\s*({_N}(?:\s*{_U})?)", value.strip())):
            both = [number(m[1]), number(m[2])]
        written = [x[1] for x in both if x and x[1]]
        if kind == "range" or own or written:
            parts += zip(("min", "max"), both, strict=True)
        for bound, x in parts:
            said = x and (x[1] or own or (bound and next(iter(written), None)) or unit or registered)
            if said:
                out.add((bound, x[0], said.strip()))
    return out


def test_measures_by_brute_force(spark, data):
    plain = lambda p: re.sub(r"[\s_-]", "", p).lower()
    named = defaultdict(set)
    for r in spark.read.parquet(f"{data}/predicate_registry.parquet").collect():
        for alias in [r.predicate, *(r.aliases or [])]:
            named[plain(alias)].add((r.value_type, r.unit))
    rows = spark.read.parquet(f"{data}/assertions.parquet").collect()
    want = {(r.id, *m, r.value) for r in rows if r.value is not None for m in _measures(r.value, r.predicate and named.get(plain(r.predicate)), r.normalization and r.normalization.unit)}
    whole = q.unit_normalisation(spark, data).collect()
    assert len(whole) == len(want) and {(r.id, r.bound, r.number, r.unit, r.original) for r in whole} == want
    assert {(r.id, r.base_value, r.base_unit, r.original) for r in whole} >= {(r.id, r.base_value, r.base_unit, r.original) for r in q.unit_normalisation(spark, data).collect()}


def _parts(rows):
    """Assertions of parts, one for each cell: id, subjectId, predicate and the value that the JSON text has to have."""
    good = [r for r in rows if r.p_partkey is not None and r.p_size is not None and r.p_size > 1]
    return sorted((f"source_parts:1:{r.p_partkey}:{p}", f"part_{r.p_partkey}", p, v) for r in good for p, v in (("size", r.p_size), ("price", r.p_retailprice), ("brand", r.p_brand)) if v is not None)


def _adapted(df):
    return sorted((r.id, r.subjectId, r.predicate, json.loads(r.value)) for r in df.collect())


def test_every_mapped_column_is_adapted(spark, tmp_path):
    rows = [(1, "a", 5, 901.25, "Brand#1"), (2, "b", 1, 3.0, "x"), (3, "c", 2, 1e9, 'q"}'), (4, "d", 7, 0.1, None), (5, "e", None, 4.0, "x"), (6, "f", 3, None, "y\\"), (7, "g", 3, 1234567890.12, "é\n")]
    df = spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_size int, p_retailprice double, p_brand string")
    df.write.parquet(f"{tmp_path}/part.parquet")
    assert _adapted(q.adapted_assertions(spark, str(tmp_path))) == _parts(df.collect())


def test_adapted_parts_by_brute_force(spark, data):
    got = _adapted(q.adapted_assertions(spark, data))
    assert got == _parts(spark.read.parquet(f"{data}/part.parquet").collect())
    assert len(got) == next(r.n for r in q.import_run_counts(spark, data).collect() if r.what == "assertions")


def _timing_errors(t):
    """Path and keyword of every error of a rule's timing, by both kinds of window; none if exactly one fits."""
    t = {k: {n: x for n, x in v.asDict().items() if x is not None} if isinstance(v, Row) else v for k, v in t.asDict().items() if v is not None}
    calendar = [("/timing/type", "const")] * (t.get("type") not in (None, "calendar-date-window"))
    calendar += [("/timing", "required") for k in ("type", "start", "end", "precision") if k not in t] + [("/timing", "additionalProperties") for k in ("anchor", "startOffsetDays", "endOffsetDays") if k in t]
    calendar += [("/timing/precision", "enum")] * (t.get("precision") not in (None, "day", "month"))
    for edge in ("start", "end"):
        for part, most in (("month", 12), ("day", 31)):
            n = t.get(edge, {part: 1}).get(part)
            at = f"/timing/{edge}"
            calendar += [(at, "required")] * (n is None) + [(f"{at}/{part}", "minimum")] * (n is not None and n < 1) + [(f"{at}/{part}", "maximum")] * (n is not None and n > most)
    relative = [("/timing/type", "const")] * (t.get("type") not in (None, "relative-day-window"))
    relative += [("/timing", "required") for k in ("type", "anchor", "startOffsetDays", "endOffsetDays") if k not in t] + [("/timing", "additionalProperties") for k in ("start", "end", "precision") if k in t]
    relative += [("/timing/anchor", "enum")] * (t.get("anchor") not in (None, "last_spring_frost", "first_autumn_frost", "previous_crop_harvest"))
    return [*calendar, *relative, ("/timing", "oneOf")] if calendar and relative else []


def _timing_rows(spark, folder):
    rules = spark.read.parquet(f"{folder}/cultivation_rules.parquet").collect()
    want = sorted(((r.id, *e) for r in rules if r.timing is not None for e in _timing_errors(r.timing)), key=str)
    got = sorted(map(tuple, q.schema_errors_rules(spark, str(folder)).where("path like '/timing%'").collect()), key=str)
    assert got == want
    return got


def test_errors_inside_timings(spark, tmp_path):
    def rule(id, **timing):
        edge = lambda e: e and tuple(e)
        names = ("type", "start", "end", "precision", "anchor", "startOffsetDays", "endOffsetDays")
        return (id, "active", "p", None, "c", "direct_sow", tuple(edge(timing.get(n)) if n in ("start", "end") else timing.get(n) for n in names), ["e"])

    calendar, relative = {"type": "calendar-date-window", "precision": "day", "start": (3, 1), "end": (4, 31)}, {"type": "relative-day-window", "anchor": "last_spring_frost", "startOffsetDays": -7, "endOffsetDays": 7}
    rows = [rule("good", **calendar), rule("relative", **relative), rule("month", **calendar | {"start": (13, 1)}), rule("zero", **calendar | {"end": (0, 0)}), rule("day", **calendar | {"start": (2, 32)}), rule("part", **calendar | {"end": (5, None)})]
    rows += [rule("open", **calendar | {"end": None}), rule("mixed", **calendar | relative), rule("precise", **calendar | {"precision": "hour"}), rule("anchor", **relative | {"anchor": "easter"}), rule("kind", **relative | {"type": "other"}), rule("empty"), ("none", "active", "p", None, "c", "direct_sow", None, ["e"])]
    edge = "struct<month: int, day: int>"
    timing = f"struct<type: string, start: {edge}, end: {edge}, precision: string, anchor: string, startOffsetDays: int, endOffsetDays: int>"
    spark.createDataFrame(rows, f"id string, status string, plantConceptId string, cultivarId string, contextId string, action string, timing {timing}, evidenceReferenceIds array<string>").write.parquet(f"{tmp_path}/cultivation_rules.parquet")
    got = _timing_rows(spark, tmp_path)
    assert {r[0] for r in got} == {"month", "zero", "day", "part", "open", "mixed", "precise", "anchor", "kind", "empty"}
    assert {("month", "/timing/start/month", "maximum"), ("zero", "/timing/end/day", "minimum"), ("zero", "/timing/end/month", "minimum"), ("day", "/timing/start/day", "maximum")} <= set(got)


def test_timing_errors_by_brute_force(spark, data):
    _timing_rows(spark, data)
