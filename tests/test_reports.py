import datetime as dt

from pyspark.sql import functions as F

from seedloom.functions import columns as c
from seedloom.operators import reports as r


def values(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


def test_chains(spark):
    rows = [("a", "b"), ("b", "c"), ("c", None), ("x", "y"), ("y", "x"), ("into", "x"), ("self", "self"), ("gone", "nowhere"), ("one", None)]
    rows += [(f"n{k}", f"n{k + 1}") for k in range(40)] + [("n40", None)]
    found = {x.id: (x.final, x.steps) for x in r.resolve_replacements(spark.createDataFrame(rows, "id string, replacement string")).collect()}
    assert found["a"] == ("c", 2) and found["c"] == ("c", 0) and found["gone"] == ("nowhere", 1) and found["n0"] == ("n40", 40)
    assert found["x"] == found["y"] == found["into"] == (None, None) and found["self"] == ("self", 0)
    assert r.resolve_replacements(spark.createDataFrame([], "id string, replacement string")).collect() == []


def test_fallback(spark):
    subjects = spark.createDataFrame([(s, f"Sci {s}") for s in "abcd"] + [("e", None)], "subject string, scientificName string")
    names = spark.createDataFrame(
        [("a", "fr", "x2", False), ("a", "fr", "x1", False), ("a", "en", "w", True), ("b", "fr", "y", False), ("b", "fr", "yp", True), ("c", "de", "z", False), ("c", "pt", "p", True), ("c", "en", "q", True), ("d", None, "n", None), (None, "fr", "v", True), ("d", "fr", None, True)],
        "subject string, language string, value string, preferred boolean",
    )
    assert values(r.name_fallback(subjects, names, "fr")) == [("a", "x1", "fr"), ("b", "yp", "fr"), ("c", "q", "en"), ("d", "Sci d", None), ("e", None, None)]
    assert r.name_fallback(subjects.limit(0), names, "fr").collect() == []


def test_rollups(spark):
    df = spark.createDataFrame([("s", "b", 1), ("s", "a", 1), ("s", "a", 2), ("t", None, None), (None, "z", 3)], "g string, id string, v int")
    assert values(r.attribution(df, ["g"], "id")) == [("s", ["a", "b"]), (None, ["z"])]
    assert values(r.contradictions(df, ["g"], F.col("v"))) == [("s", 2)]
    assert values(r.more_than_one(df, ["g"], F.col("v") > 0)) == [("s", 3)]
    assert values(r.coverage(df, {"x": F.col("v") > 1, "y": F.col("id").isNotNull()}, ["g"])) == [("s", "x", 1, 3), ("s", "y", 3, 3), ("t", "x", 0, 1), ("t", "y", 0, 1), (None, "x", 1, 1), (None, "y", 1, 1)]
    assert values(r.latest(df, ["g"], ["v"], ["id"])) == [("s", "a"), ("t", None), (None, "z")]
    assert values(r.exclusions(df, {"no id": F.col("id").isNull(), "small": F.col("v") < 2}).select("id", "reason")) == [("a", "small"), ("b", "small"), (None, "no id")]
    assert values(r.ranked(df, ["g"], [F.col("v"), F.col("id")], 1).select("g", "id")) == [("s", "a"), ("t", None), (None, "z")]


def test_units_and_names(spark):
    df = spark.createDataFrame([(5.0, " CM "), (2.0, "kg"), (1.0, "ell"), (None, "cm"), (1.0, None)], "v double, u string")
    assert values(r.normalised_units(df, "v", "u", {"cm": ("m", 0.01), "kg": ("kg", 1)}).select("base_value", "base_unit")) == [(0.05, "m"), (2.0, "kg"), (None, "m"), (None, None), (None, None)]
    registry = spark.createDataFrame([("k1", "Red Leaf"), ("k2", "blue"), ("k3", "BLUE")], "key string, name string")
    names = spark.createDataFrame([("red leaf",), ("Blue",), ("green",), (None,)], "name string")
    good, issues = r.reconciled(names, registry, "name", "key", F.lower("name"))
    assert values(good) == [("red leaf", "k1")] and values(issues) == [("Blue", "ambiguous"), ("green", "unresolved"), (None, "unresolved")]


def test_columns(spark):
    tags = spark.createDataFrame([(t,) for t in ("EN-gb", "zh_hant_tw", "x-AB-latn", "de", " pt-br ", "sl-rozaj", "en-a-bb", "", None)], "t string")
    assert [x[0] for x in tags.select(c.language_tag(F.col("t"))).collect()] == ["en-GB", "zh-Hant-TW", "x-ab-latn", "de", "pt-BR", "sl-rozaj", "en-a-bb", None, None]
    versions = ["1.0.0-alpha", "1.0.0-alpha.1", "1.0.0-alpha.beta", "1.0.0-beta.2", "1.0.0-beta.11", "1.0.0", "1.0.1", "1.10.0", "2.0.0"]
    df = spark.createDataFrame([(n, v) for n, v in enumerate(versions)] + [(99, "1.0"), (98, None)], "n int, v string")
    assert [x.n for x in df.where(c.version_key(F.col("v")).isNotNull()).orderBy(c.version_key(F.col("v"))).collect()] == list(range(len(versions)))
    assert df.where(c.is_compatible(F.col("v"), F.lit("1.0.0"))).count() == 4
    numbers = spark.createDataFrame([(0.0,), (1.5,), (-1.0,), (float(2**53),), (None,), (7.0,)], "x double")
    assert [x[0] for x in numbers.select(c.is_safe_integer(F.col("x"))).collect()] == [True, False, False, False, False, True]
    days = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 6, 1),)], "d date")
    assert [x[0] for x in days.select(c.in_month_day_window(F.col("d"), F.lit("11-01"), F.lit("02-15"))).collect()] == [True, False]
    window = days.select(c.window_dates(F.col("d"), F.lit(-7), F.lit(2)).alias("w")).first().w
    assert (window.start, window.end) == (dt.date(2023, 12, 29), dt.date(2024, 1, 7))


def test_scopes_do_not_widen(spark):
    said = spark.createDataFrame([("plant-concept", "p", "size"), ("cultivar", "c", "size"), ("cultivar", "c", "colour"), ("cultivar", "x", "taste"), (None, "p", "taste"), ("plant-concept", None, "size"), ("cultivar", "c", None)], "subjectType string, subjectId string, predicate string")
    cultivars = spark.createDataFrame([("c", "p"), ("c", "p"), ("d", None)], "id string, plantConceptId string")
    assert values(r.generic_facts(said, cultivars)) == [("p", "colour", "cultivar-only"), ("p", "size", None)]


def test_month_windows(spark):
    df = spark.createDataFrame([(2, 2), (11, 4), (0, 3), (1, 13), (None, 1)], "a int, b int")
    found = [x[0] and tuple(x[0]) for x in df.select(c.month_window(F.col("a"), F.col("b"))).collect()]
    assert found == [("02-01", "02-29", "month"), ("11-01", "04-30", "month"), None, None, None]


def test_adapter(spark):
    import pytest

    from seedloom.sources.adapters import Mapping, Release, import_run, to_assertions

    df = spark.createDataFrame([(1, "a", 2.5, '5"'), (1, "a", 2.5, '5"'), (2, None, 1.0, None), (3, "c", None, None), (None, "d", 1.0, "x")], "n int, plant string, depth double, note string")
    parts = to_assertions(df, Release("s", "m", "1", "l"), "plant-concept", F.col("plant"), F.col("n"), F.concat(F.lit("row/"), F.col("n").cast("string")), [Mapping("depth", "depth", "cm"), Mapping("note", "note")])
    assert values(parts[0].select("id", "value", "normalization.originalValue", "normalization.unit")) == sorted([("s:1:1:depth", "2.5", "2.5", "cm"), ("s:1:1:note", '"5\\""', '5"', None)] * 2, key=str)
    assert values(parts[1].select("id", "locator")) == [("evidence:s:1:1", "row/1"), ("evidence:s:1:3", "row/3")]
    assert values(import_run(*parts)) == [("assertions", None, 4), ("evidence", None, 2), ("rejected", "no record", 1), ("rejected", "no subject", 1)]
    with pytest.raises(ValueError):
        to_assertions(df, Release("s", "m", "1", "l"), "x", F.col("plant"), F.col("n"), F.col("n"), [Mapping("p", "none")])
