import json

import pytest

from seedloom.operators.schema import SchemaSet, ValidationPipelineError, split, validate, with_validation
from seedloom.sources.catalogue_schemas import documents, object_schema, schema_id
from seedloom.sources.schema_files import SchemaCompileError, is_absolute_id, schema_documents


@pytest.fixture(scope="module")
def schemas():
    return SchemaSet(documents())


HASH = "0" * 64
PLACE = {"geographicContextIds": ["g1"], "growingSystem": "outdoor", "propagation": "transplant"}
CALENDAR = {"type": "calendar-date-window", "start": {"month": 1, "day": 2}, "end": {"month": 3, "day": 4}, "precision": "day"}
RELATIVE = {"type": "relative-day-window", "anchor": "last_spring_frost", "startOffsetDays": -7, "endOffsetDays": 14}
RULE = {"id": "r", "status": "active", "plantConceptId": "p", "contextId": "c", "action": "direct_sow", "timing": CALENDAR, "evidenceReferenceIds": ["e"]}
ARTIFACT = {"path": "a/b.jsonl.gz", "kind": "jsonl-gzip", "mediaType": "m", "schemaId": "urn:x", "contentEncoding": "gzip", "byteSize": 1, "entryCount": 2, "sha256": HASH}
MANIFEST = {"schemaVersion": "1.2.0", "catalogVersion": "2.0.0-rc.1", "minimumConsumerVersion": "1.0.0", "profile": "dev", "generatedAt": "2026-01-02T03:04:05Z", "requiredArtifacts": [ARTIFACT], "optionalArtifacts": []}
SOURCE = {
    "id": "m", "provider": {"id": "p", "name": "n"}, "release": {"identifier": "1"}, "resources": [{"locator": "l", "checksum": {"algorithm": "sha256", "value": HASH}}],
    "licenceReview": {"status": "accepted", "declaredLicence": "d", "evidenceLocator": "e"}, "profileEligibility": [{"profile": "p", "decision": "eligible", "reason": "r"}],
}
EVIDENCE = {"id": "e", "sourceId": "s", "sourceManifestId": "m", "sourceReleaseId": "1", "sourceRecordId": "x", "locator": "l", "rights": {"licenceId": "l", "decision": "eligible", "reason": "r"}, "reviewId": "v"}
VALID = {
    "artifact-descriptor": ARTIFACT,
    "assertion": {"id": "a", "subjectType": "cultivar", "subjectId": "c", "predicate": "p", "value": {"x": [1, None, {"y": "z"}]}, "context": PLACE, "evidenceReferenceIds": ["e1", "e2"], "reviewId": "v"},
    "attribution": {"id": "a", "sourceId": "s", "sourceReleaseId": "1", "sourceLocator": "l", "licenceId": "l", "requiredNotice": "n", "profile": "p", "includedRecordIds": ["r"]},
    "cultivar": {"id": "c", "status": "retired", "plantConceptId": "p", "evidenceReferenceIds": ["e"]},
    "cultivation-context": {"id": "c"} | PLACE,
    "cultivation-rule": RULE,
    "curation-issue": {"id": "i", "kind": "contradiction", "status": "open", "affectedRecordIds": ["a"], "reason": "r"},
    "evidence-reference": EVIDENCE,
    "licence": {"id": "l", "name": "n", "expression": "e", "referenceLocator": "r", "commercialUse": "allowed", "attributionRequired": True, "requiredNotice": "n"},
    "localized-name": {"id": "n", "subjectType": "taxon", "subjectId": "t", "languageTag": "pt-BR", "value": "v", "kind": "alias", "preferred": False, "evidenceReferenceIds": ["e"]},
    "plant-concept": {"id": "p", "status": "active", "taxonId": "t", "evidenceReferenceIds": ["e"], "later": {"any": 1}},
    "release-manifest": MANIFEST,
    "review": {"id": "v", "status": "accepted", "reviewedAt": "2026-02-30T00:00:00.123Z", "reviewerId": "w", "confidence": 1},
    "schema-compilation-example": {"value": "x"},
    "source": {"id": "s", "name": "n"},
    "source-manifest": SOURCE,
    "source-manifest-reference": {"sourceManifestId": "m"},
    "taxon": {"id": "t", "status": "active", "scientificName": "s", "evidenceReferenceIds": ["e"]},
}


def without(record, name):
    return {k: v for k, v in record.items() if k != name}


EXAMPLE = "schema-compilation-example"
CASES = [
    (EXAMPLE, {}, [("", "required")]),
    (EXAMPLE, [], [("", "type")]),
    (EXAMPLE, None, [("", "type")]),
    (EXAMPLE, {"value": 1}, [("/value", "type")]),
    (EXAMPLE, {"value": ""}, [("/value", "minLength")]),
    (EXAMPLE, {"value": None}, [("/value", "type")]),
    (EXAMPLE, {"value": "x", "more": 1, "other": 2}, [("", "additionalProperties")] * 2),
    ("source-manifest", without(SOURCE, "id"), [("", "required")]),
    ("source-manifest", SOURCE | {"resources": []}, [("/resources", "minItems")]),
    ("source-manifest", SOURCE | {"resources": [{"locator": "l", "checksum": {"algorithm": "sha256", "value": "ABC"}}]}, [("/resources/0/checksum/value", "pattern")]),
    ("source-manifest", SOURCE | {"resources": [{"locator": "l", "checksum": {"algorithm": "md5", "value": HASH}}]}, [("/resources/0/checksum/algorithm", "const")]),
    ("source-manifest", SOURCE | {"assertions": []}, [("", "additionalProperties")]),
    ("source-manifest-reference", {"sourceManifestId": "../m"}, [("/sourceManifestId", "pattern")]),
    ("artifact-descriptor", without(ARTIFACT, "sha256"), [("", "required")]),
    ("artifact-descriptor", ARTIFACT | {"path": "../x"}, [("/path", "pattern")]),
    ("artifact-descriptor", without(ARTIFACT, "entryCount"), [("", "if"), ("", "required")]),
    ("artifact-descriptor", ARTIFACT | {"byteSize": -1, "entryCount": 1.5}, [("/byteSize", "minimum"), ("/entryCount", "type")]),
    ("release-manifest", without(MANIFEST, "generatedAt"), [("", "required")]),
    ("release-manifest", MANIFEST | {"schemaVersion": "2.0.0"}, [("/schemaVersion", "pattern")]),
    ("release-manifest", MANIFEST | {"optionalArtifacts": [without(ARTIFACT, "path")]}, [("/optionalArtifacts/0", "required")]),
    ("source", {"name": "n"}, [("", "required")]),
    ("licence", without(VALID["licence"], "expression"), [("", "required")]),
    ("licence", without(VALID["licence"], "requiredNotice"), [("", "if"), ("", "required")]),
    ("review", {"id": "v", "status": "accepted", "reviewerId": "w"}, [("", "if"), ("", "required")]),
    ("review", {"id": "v", "status": "unreviewed", "confidence": 1.5}, [("/confidence", "maximum")]),
    ("review", {"id": "v\n", "status": "unreviewed"}, [("/id", "pattern")]),
    ("review", {"id": "x" * 129, "status": "unreviewed"}, [("/id", "maxLength")]),
    ("evidence-reference", without(EVIDENCE, "locator"), [("", "required")]),
    ("evidence-reference", EVIDENCE | {"rights": EVIDENCE["rights"] | {"more": 1}}, [("/rights", "additionalProperties")]),
    ("attribution", without(VALID["attribution"], "includedRecordIds"), [("", "required")]),
    ("taxon", without(VALID["taxon"], "scientificName"), [("", "required")]),
    ("plant-concept", without(VALID["plant-concept"], "taxonId"), [("", "required")]),
    ("localized-name", without(VALID["localized-name"], "languageTag"), [("", "required")]),
    ("localized-name", VALID["localized-name"] | {"subjectType": "cultivar"}, [("/subjectType", "enum")]),
    ("cultivation-context", VALID["cultivation-context"] | {"growingSystem": "moon"}, [("/growingSystem", "enum")]),
    ("cultivation-context", VALID["cultivation-context"] | {"geographicContextIds": ["a", "b", "a"]}, [("/geographicContextIds", "uniqueItems")]),
    ("cultivation-context", VALID["cultivation-context"] | {"geographicContextIds": ["a", 7, "/"]}, [("/geographicContextIds/1", "type"), ("/geographicContextIds/2", "pattern")]),
    ("cultivation-rule", RULE | {"cultivarId": "c"}, [("", "oneOf"), ("", "not"), ("", "not")]),
    ("cultivation-rule", without(RULE, "plantConceptId"), [("", "oneOf"), ("", "required"), ("", "required")]),
    ("cultivation-rule", without(RULE, "action"), [("", "required")]),
    ("curation-issue", VALID["curation-issue"] | {"kind": "other"}, [("/kind", "enum")]),
    ("assertion", VALID["assertion"] | {"provenance": {}}, [("", "additionalProperties")]),
    ("cultivar", without(VALID["cultivar"], "plantConceptId"), [("", "required")]),
]


def test_valid_records(spark, schemas):
    for name, record in VALID.items():
        assert validate(spark, schemas, schema_id(name), record) == {"valid": True}, name


def test_variants_of_a_rule(spark, schemas):
    for rule in (RULE | {"timing": RELATIVE}, without(RULE, "plantConceptId") | {"cultivarId": "c"}, RULE | {"timing": CALENDAR | {"start": {"month": 2.0, "day": 31}}}):
        assert validate(spark, schemas, schema_id("cultivation-rule"), rule) == {"valid": True}


@pytest.mark.parametrize(("name", "record", "expected"), CASES)
def test_errors(spark, schemas, name, record, expected):
    result = validate(spark, schemas, schema_id(name), record)
    assert [(e["instancePath"], e["keyword"]) for e in result.get("errors", [])] == expected


def test_no_branch_of_a_union(spark, schemas):
    result = validate(spark, schemas, schema_id("cultivation-rule"), RULE | {"timing": {"type": "other"}})
    assert ("/timing", "oneOf") in [(e["instancePath"], e["keyword"]) for e in result["errors"]]


def test_unknown_schema(spark, schemas):
    with pytest.raises(ValidationPipelineError) as error:
        validate(spark, schemas, "toString", None)
    assert error.value.code == "UNKNOWN_SCHEMA_ID"
    with pytest.raises(ValidationPipelineError) as error:
        SchemaSet([])
    assert error.value.code == "INVALID_SCHEMA_REGISTRY"


def test_compile_errors():
    a = {"$id": "urn:a", "type": "string"}
    with pytest.raises(SchemaCompileError):
        SchemaSet([a, a])
    for broken in ({"$ref": "urn:none"}, {"$ref": "#/$defs/none"}, {"unheardOf": 1}, {"properties": {"x": {"$ref": "#"}}}):
        with pytest.raises(SchemaCompileError):
            SchemaSet([{"$id": "urn:b"} | broken]).compile("urn:b")
    SchemaSet(documents()).compile_all()


def test_fingerprint_ignores_order():
    made = documents()
    assert SchemaSet(made).fingerprint() == SchemaSet(dict(reversed(made.items()))).fingerprint() != SchemaSet([{"$id": "urn:a"}]).fingerprint()


def test_absolute_ids():
    assert is_absolute_id({"$id": "urn:x:y"}) and is_absolute_id({"$id": "https://example.org/s"})
    assert not any(map(is_absolute_id, [{}, [], {"$id": ""}, {"$id": "relative/s.json"}, {"$id": 1}, None]))


def test_files(tmp_path, spark):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep/z.schema.json").write_text(json.dumps({"$id": "urn:a", "$ref": "urn:b#/$defs/s"}))
    (tmp_path / "a.schema.json").write_text(json.dumps({"$id": "urn:b", "$defs": {"s": {"type": "string"}}}))
    (tmp_path / "other.json").write_text("{")
    assert list(schema_documents(tmp_path)) == ["urn:a", "urn:b"]
    schemas = SchemaSet.from_folder(tmp_path)
    assert validate(spark, schemas, "urn:a", 1)["errors"][0]["keyword"] == "type"
    (tmp_path / "c.schema.json").write_text(json.dumps({"$id": "urn:a"}))
    with pytest.raises(SchemaCompileError):
        schema_documents(tmp_path)
    (tmp_path / "c.schema.json").write_text("{")
    with pytest.raises(SchemaCompileError):
        schema_documents(tmp_path)


def test_table_cases(spark, schemas):
    from pyspark.sql import functions as F

    texts = [json.dumps(VALID["source"]), '{"id":"s"}', None, '{"id":"s","name":"' + "x" * 100_000 + '"}', json.dumps(VALID["source"])]
    df = spark.createDataFrame([(t, "x") for t in texts], "t string, path string").withColumn("v", F.try_parse_json("t"))
    compiled = schemas.compile(schema_id("source"))
    assert [r.valid for r in with_validation(df, compiled).collect()] == [True, False, None, True, True]
    good, bad = split(df, compiled)
    assert (good.count(), bad.count()) == (3, 2)
    assert with_validation(df.limit(0), compiled).collect() == []
    with pytest.raises(ValueError):
        with_validation(df.withColumn("errors", F.lit(1)), compiled)


def test_open_additional_members(spark):
    schema = {"$id": "urn:m"} | object_schema({"a?": {"type": "integer", "exclusiveMinimum": 0, "multipleOf": 5}}) | {"additionalProperties": {"type": "string", "maxLength": 2}, "anyOf": [{"required": ["a"]}, {"required": ["b"]}]}
    schemas = SchemaSet([schema])
    found = lambda v: [(e["instancePath"], e["keyword"]) for e in validate(spark, schemas, "urn:m", v).get("errors", [])]
    assert found({"a": 5, "b": "xy"}) == []
    assert found({"a": 4, "b/c": "xyz"}) == [("/a", "multipleOf"), ("/b~1c", "maxLength")]
    assert found({"a": 0, "b": 1}) == [("/a", "exclusiveMinimum"), ("/b", "type")]
    assert found({"c": "x"}) == [("", "anyOf"), ("", "required"), ("", "required")]
