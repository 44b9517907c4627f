import json

import pytest
from pyspark.sql import functions as F

from seedloom.operators import integrity as i
from seedloom.sources.jsonl import read_jsonl
from seedloom.sources.manifests import is_safe_path, load_cases, load_dataset


def records(spark, rows):
    df = spark.createDataFrame([(n, json.dumps(r)) for n, r in enumerate(rows, 1)], "line bigint, raw string")
    return df.withColumn("v", F.parse_json("raw"))


def issues(dataset, **options):
    rows = i.dataset_issues(dataset, **options).orderBy("phase", "line", "place").collect()
    return [(r.code, r.recordId, r.message) for r in rows]


PLACE = {"evidenceReferenceIds": ["e"], "reviewId": "v"}


@pytest.fixture
def clean():
    return {
        "plantConcepts": [{"id": "p"}], "cultivars": [{"id": "c", "plantConceptId": "p"}], "evidence": [{"id": "e"}], "reviews": [{"id": "v"}],
        "assertions": [{"id": "a", "subjectType": "plant-concept", "subjectId": "p"} | PLACE, {"id": "b", "subjectType": "cultivar", "subjectId": "c"} | PLACE],
        "rules": [{"id": "r", "plantConceptId": "p"}, {"id": "s", "cultivarId": "c", "timing": {"a": 1, "b": 2}}],
    }


def run(spark, dataset, **options):
    return issues({k: records(spark, v) for k, v in dataset.items() if v}, **options)


def test_clean(spark, clean):
    assert run(spark, clean) == []


def test_repeated_ids(spark, clean):
    clean["evidence"] += [{"id": "e"}, {"id": "e"}, {"id": ""}, {"id": ""}, {"id": 7}, {"id": 7}, {}, {}, {"id": None}]
    clean["reviews"] += [{"id": "v"}]
    want = [("e", "evidence"), ("e", "evidence"), ("", "evidence"), ("v", "reviews")]
    assert run(spark, clean) == [(i.DUPLICATE_ID, x, f"Duplicate {n} identifier {x}") for x, n in want]


def test_parents(spark, clean):
    clean["cultivars"] += [{"id": "d", "plantConceptId": "none"}, {"plantConceptId": "none"}, {"id": "f"}, {"id": "g", "plantConceptId": 1}]
    text = "Cultivar references missing plant concept none"
    assert run(spark, clean) == [(i.MISSING_REFERENCE, "d", text), (i.MISSING_REFERENCE, "<missing>", text)]


def test_scopes(spark, clean):
    clean["assertions"] += [{"id": x, "subjectType": t, "subjectId": s} for x, t, s in [("1", "cultivar-group", "c"), ("2", "other", "p"), ("3", "plant-concept", "c")]] + [{"id": "4", "subjectId": "p"}, {"id": "5", "subjectType": "cultivar"}, {"id": "6", "subjectType": 1, "subjectId": "p"}]
    found = run(spark, clean)
    assert [r[:2] for r in found] == [(i.INVALID_SCOPE, str(n)) for n in range(1, 7)]
    assert [r[2].split()[2] for r in found] == ["cultivar-group/c", "other/p", "plant-concept/c", "<missing>/p", "cultivar/<missing>", "<missing>/p"]


def test_lists_and_reviews(spark, clean):
    subject = {"subjectType": "plant-concept", "subjectId": "p"}
    clean["assertions"] += [
        subject | {"id": "1", "evidenceReferenceIds": ["x", "e", "y", "x"], "reviewId": "w"},
        subject | {"id": "2", "evidenceReferenceIds": "x"}, subject | {"id": "3", "evidenceReferenceIds": [1, None, ["x"]], "reviewId": None},
    ]
    lost = [(i.MISSING_REFERENCE, "1", f"References missing evidence record {x}") for x in "xyx"]
    assert run(spark, clean) == [*lost, (i.MISSING_REFERENCE, "1", "Assertion references missing review w")]


def test_rules(spark, clean):
    clean["rules"] += [{"id": "1", "plantConceptId": "p", "cultivarId": "c", "timing": {"a": 9}}, {"id": "2"}, {"id": "3", "plantConceptId": 1}]
    text = "Rule must target exactly one plant concept or cultivar"
    assert run(spark, clean) == [(i.INVALID_SCOPE, x, text) for x in "123"]


@pytest.mark.parametrize(("timings", "canonical", "written"), [([{"b": 2, "a": 1}], 1, 0), ([{"a": 1, "b": 2}], 1, 1), ([None, None], 1, 1), ([None], 0, 0), ([{"a": 3}], 0, 0)])
def test_distinct_rules(spark, clean, timings, canonical, written):
    clean["rules"] += [{"id": f"t{n}", "cultivarId": "c"} | ({"timing": t} if t else {}) for n, t in enumerate(timings)]
    assert len(run(spark, clean)) == canonical
    assert len(run(spark, clean, order_sensitive=True)) == written


def test_tables(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 3, "x"), ("b", 4, None), (None, 5, None)], "k string, n int, ref string")
    assert [tuple(r) for r in i.repeated_keys(df, ["k"]).collect()] == [("a", 2)]
    assert [r.n for r in i.repeated_rows(df, ["k"], "n").collect()] == [2]
    target = spark.createDataFrame([("x",), (None,), ("x",)], "id string")
    assert [r.n for r in i.missing_references(df, "ref", target, "id").collect()] == [2]
    assert i.missing_references(df, "ref", target.limit(0), "id").count() == 3
    assert i.repeated_keys(df.limit(0), ["k"]).collect() == [] and i.not_distinct(df.limit(0), F.col("k")).collect() == []
    lists = spark.createDataFrame([(1, ["x", "z", None, "z"]), (2, None), (3, [])], "n int, refs array<string>")
    assert [r.reference for r in i.missing_list_references(lists, "refs", target, "id").collect()] == ["z", "z"]


def test_dataset_from_files(spark, tmp_path, clean):
    for name, rows in clean.items():
        (tmp_path / f"{name}.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n\n")
    listed = [f"{n}.jsonl" for n in clean] + ["notes.jsonl"]
    (tmp_path / "set.json").write_text(json.dumps({"files": listed}))
    with pytest.raises(FileNotFoundError):
        load_dataset(spark, tmp_path / "set.json")
    dataset = load_dataset(spark, tmp_path / "set.json", strict=False)
    assert dataset.missing == ["notes.jsonl"]
    assert issues(dataset.collections) == []
    (tmp_path / "set.json").write_text(json.dumps({"files": ["../x.jsonl"]}))
    with pytest.raises(ValueError):
        load_dataset(spark, tmp_path / "set.json")


def test_lines(spark, tmp_path):
    import gzip

    text = '{"a":1}\n\n{"b":"x\r"}\r\n{"c":1,"c":2}\n{} x\n"é"'
    (tmp_path / "a.jsonl").write_text(text, newline="")
    with gzip.open(tmp_path / "b.jsonl.gz", "wb") as f:
        f.write(b'{"z":1}\n')
    rows = read_jsonl(spark, str(tmp_path), line_numbers=True).select(F.element_at(F.split("file", "/"), -1).alias("f"), "line", F.col("v").isNotNull().alias("ok")).orderBy("f", "line").collect()
    assert [tuple(r) for r in rows] == [("a.jsonl", 1, True), ("a.jsonl", 3, False), ("a.jsonl", 4, False), ("a.jsonl", 5, False), ("a.jsonl", 6, True), ("b.jsonl.gz", 1, True)]
    assert read_jsonl(spark, str(tmp_path)).count() == 6


def test_lines_of_split_files(spark, tmp_path):
    with open(tmp_path / "big.jsonl", "w") as f:
        f.writelines(f'{{"n":{n}}}\n' for n in range(1, 50_001))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = read_jsonl(spark, str(tmp_path), line_numbers=True)
        assert rows.rdd.getNumPartitions() > 1
        assert rows.where(F.try_variant_get("v", "$.n", "bigint") != F.col("line")).count() == 0
        assert rows.count() == 50_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_cases(tmp_path):
    def load(*cases):
        (tmp_path / "m.json").write_text(json.dumps({"schemaId": "urn:a", "cases": list(cases)}))
        return load_cases(tmp_path / "m.json")

    good = {"id": "x", "fixture": "f.json", "expected": {"valid": True}}
    bad = {"id": "y", "schemaId": "urn:b", "fixture": "f.json", "expected": {"valid": False, "errors": [{"instancePath": "/a", "keyword": "type"}]}}
    cases = load(good, bad, {"id": "z", "fixture": "f.json", "expected": {"pipelineError": "C"}})
    assert [(c.name, c.schema_id, c.valid, c.errors, c.pipeline_error) for c in cases] == [("x", "urn:a", True, (), None), ("y", "urn:b", False, (("/a", "type"),), None), ("z", "urn:a", False, (), "C")]
    for broken in ([good, good], [good | {"fixture": "../f"}], [good | {"expected": {}}], [good | {"expected": {"valid": False}}]):
        with pytest.raises(ValueError):
            load(*broken)
    assert not any(map(is_safe_path, ["/a", "a/../b", "", None, "a//b", "-a"])) and is_safe_path("a/b.json")
