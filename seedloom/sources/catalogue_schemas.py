"""Schema documents of the catalogue's records, made from a compact description.

A field's description is the name of a shared definition (``id``, ``ids``, ``text`` ...), an enumeration (a list), a
constant, or a schema. A field named with a question mark at its end is optional.
"""

from __future__ import annotations

from typing import Any

BASE = "urn:seedloom:schema:v1"

# Enumerations and patterns of the record format.
ACTIONS = ["start_indoors", "direct_sow", "transplant", "plant_now"]
ANCHORS = ["last_spring_frost", "first_autumn_frost", "previous_crop_harvest"]
ARTIFACT_KINDS = ["json-document", "jsonl-gzip", "schema"]
CATALOG_STATUS = ["active", "retired"]
COMMERCIAL_USE = ["allowed", "forbidden", "unknown"]
DECISIONS = ["eligible", "ineligible", "pending-review"]
DECIDED_REVIEWS = ["accepted", "rejected", "superseded"]
GROWING_SYSTEMS = ["outdoor", "unheated_shelter", "heated_greenhouse", "indoor", "unknown"]
ISSUE_KINDS = ["unresolved-mapping", "contradiction", "missing-evidence"]
ISSUE_STATUS = ["open", "resolved", "accepted-limitation"]
LICENCE_REVIEWS = ["unreviewed", "accepted", "rejected"]
NAME_KINDS = ["common", "alias"]
NAME_SUBJECTS = ["taxon", "plant-concept"]
PRECISIONS = ["day", "month"]
PROPAGATIONS = ["direct_sowing", "transplant", "vegetative", "unknown"]
REVIEW_STATUS = ["unreviewed", "accepted", "rejected", "superseded"]
SUBJECT_TYPES = ["plant-concept", "cultivar-group", "cultivar"]
_TAIL = r"(?:-[0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)*)?(?:\+[0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)*)?$"
_NUMBER = r"(0|[1-9][0-9]*)"
PATTERNS = {
    "id": r"^[A-Za-z0-9][A-Za-z0-9._:-]*$",
    "language": r"^[A-Za-z]{2,8}(?:-[A-Za-z0-9]{1,8})*$",
    "path": r"^[A-Za-z0-9][A-Za-z0-9._-]*(?:/[A-Za-z0-9][A-Za-z0-9._-]*)*$",
    "sha256": r"^[0-9a-f]{64}$",
    "time": r"^[0-9]{4}-(0[1-9]|1[0-2])-([0-2][0-9]|3[01])T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](?:\.[0-9]+)?Z$",
    "uri": r"^[A-Za-z][A-Za-z0-9+.-]*:",
    "version": rf"^{_NUMBER}\.{_NUMBER}\.{_NUMBER}{_TAIL}",
    "version1": rf"^1\.{_NUMBER}\.{_NUMBER}{_TAIL}",
}


def _shared() -> dict[str, Any]:
    text = {name: {"type": "string", "pattern": pattern} for name, pattern in PATTERNS.items()}
    text["id"] |= {"minLength": 1, "maxLength": 128}
    again = {"$ref": "#/$defs/json"}
    return text | {
        "ids": {"type": "array", "minItems": 1, "uniqueItems": True, "items": {"$ref": "#/$defs/id"}},
        "status": {"type": "string", "enum": CATALOG_STATUS},
        "text": {"type": "string", "minLength": 1},
        "count": {"type": "integer", "minimum": 0},
        "json": {"oneOf": [{"type": "null"}, {"type": "boolean"}, {"type": "number"}, {"type": "string"}, {"type": "array", "items": again}, {"type": "object", "additionalProperties": again}]},
    }


def _field(kind: Any) -> Any:
    if isinstance(kind, str):
        return {"$ref": f"{BASE}:common#/$defs/{kind}"}
    if isinstance(kind, list):
        return {"type": "string", "enum": kind}
    return kind


def object_schema(fields: dict[str, Any], closed: bool = False, **more: Any) -> dict[str, Any]:
    """Schema of an object with described fields; ``closed`` refuses other members."""
    schema: dict[str, Any] = {"type": "object", "required": [n for n in fields if not n.endswith("?")], "properties": {n.rstrip("?"): _field(k) for n, k in fields.items()}}
    return schema | ({"additionalProperties": False} if closed else {}) | more


def _demands(field: str, values: Any, *needed: str) -> dict[str, Any]:
    """If ``field`` has one of the values, the needed members have to be there."""
    test = {"enum": values} if isinstance(values, list) else {"const": values}
    return {"if": {"properties": {field: test}, "required": [field]}, "then": {"required": list(needed)}}


def _records() -> dict[str, dict[str, Any]]:
    original = {"originalValue": "json", "method?": "text"}
    place = {"geographicContextIds": "ids", "growingSystem": GROWING_SYSTEMS, "propagation": PROPAGATIONS}
    month_day = object_schema({"month": {"type": "integer", "minimum": 1, "maximum": 12}, "day": {"type": "integer", "minimum": 1, "maximum": 31}}, closed=True)
    calendar = object_schema({"type": {"const": "calendar-date-window"}, "start": month_day, "end": month_day, "precision": PRECISIONS}, closed=True)
    days = {"type": "integer"}
    relative = object_schema({"type": {"const": "relative-day-window"}, "anchor": ANCHORS, "startOffsetDays": days, "endOffsetDays": days}, closed=True)
    only = lambda one, other: {"required": [one], "not": {"required": [other]}}
    checksum = object_schema({"algorithm": {"const": "sha256"}, "value": "sha256"}, closed=True)
    resource = object_schema({"locator": "text", "checksum": checksum, "byteSize?": "count", "mediaType?": "text"}, closed=True)
    descriptor = {"$ref": f"{BASE}:artifact-descriptor"}
    return {
        "artifact-descriptor": object_schema(
            {"path": "path", "kind": ARTIFACT_KINDS, "mediaType": "text", "schemaId": "uri", "contentEncoding?": {"type": "string", "const": "gzip"}, "byteSize": "count", "entryCount?": "count", "sha256": "sha256"},
            allOf=[_demands("kind", "jsonl-gzip", "contentEncoding", "entryCount")],
        ),
        "assertion": object_schema(
            {"id": "id", "subjectType": SUBJECT_TYPES, "subjectId": "id", "predicate": "text", "value": "json", "context": object_schema(place, closed=True), "normalization?": object_schema(original | {"unit?": "text"}, closed=True), "evidenceReferenceIds": "ids", "reviewId": "id"},
            closed=True,
        ),
        "attribution": object_schema({"id": "id", "sourceId": "id", "sourceReleaseId": "text", "sourceLocator": "text", "licenceId": "id", "requiredNotice": "text", "profile": "id", "includedRecordIds": "ids"}),
        "cultivar": object_schema({"id": "id", "status": "status", "plantConceptId": "id", "evidenceReferenceIds": "ids"}, closed=True),
        "cultivation-context": object_schema({"id": "id"} | place),
        "cultivation-rule": object_schema(
            {"id": "id", "status": "status", "plantConceptId?": "id", "cultivarId?": "id", "contextId": "id", "action": ACTIONS, "timing": {"oneOf": [calendar, relative]}, "evidenceReferenceIds": "ids"},
            oneOf=[only("plantConceptId", "cultivarId"), only("cultivarId", "plantConceptId")],
        ),
        "curation-issue": object_schema({"id": "id", "kind": ISSUE_KINDS, "status": ISSUE_STATUS, "affectedRecordIds": "ids", "reason": "text"}, closed=True),
        "evidence-reference": object_schema(
            {"id": "id", "sourceId": "id", "sourceManifestId": "id", "sourceReleaseId": "text", "sourceRecordId": "text", "locator": "text", "normalization?": object_schema(original, closed=True), "rights": object_schema({"licenceId": "id", "decision": DECISIONS, "reason": "text"}, closed=True), "reviewId": "id"}
        ),
        "licence": object_schema(
            {"id": "id", "name": "text", "expression": "text", "referenceLocator": "text", "commercialUse": COMMERCIAL_USE, "attributionRequired": {"type": "boolean"}, "requiredNotice?": "text"},
            allOf=[_demands("attributionRequired", True, "requiredNotice")],
        ),
        "localized-name": object_schema({"id": "id", "subjectType": NAME_SUBJECTS, "subjectId": "id", "languageTag": "language", "value": "text", "kind": NAME_KINDS, "preferred": {"type": "boolean"}, "evidenceReferenceIds": "ids"}),
        "plant-concept": object_schema({"id": "id", "status": "status", "taxonId": "id", "replacementPlantConceptId?": "id", "evidenceReferenceIds": "ids"}),
        "release-manifest": object_schema(
            {"schemaVersion": "version1", "catalogVersion": "version", "minimumConsumerVersion": "version", "profile": "id", "generatedAt": "time", "requiredArtifacts": {"type": "array", "minItems": 1, "items": descriptor}, "optionalArtifacts": {"type": "array", "items": descriptor}}
        ),
        "review": object_schema(
            {"id": "id", "status": REVIEW_STATUS, "reviewedAt?": "time", "reviewerId?": "id", "confidence?": {"type": "number", "minimum": 0, "maximum": 1}, "notes?": "text"},
            allOf=[_demands("status", DECIDED_REVIEWS, "reviewedAt", "reviewerId")],
        ),
        "schema-compilation-example": object_schema({"value": "text"}, closed=True),
        "source": object_schema({"id": "id", "name": "text", "publisher?": "text", "homepage?": "text"}),
        "source-manifest": object_schema(
            {
                "id": "id",
                "provider": object_schema({"id": "id", "name": "text"}, closed=True),
                "release": object_schema({"identifier": "text", "publishedAt?": "text"}, closed=True),
                "resources": {"type": "array", "minItems": 1, "items": resource},
                "licenceReview": object_schema({"status": LICENCE_REVIEWS, "declaredLicence": "text", "evidenceLocator": "text", "notes?": "text"}, closed=True),
                "profileEligibility": {"type": "array", "minItems": 1, "items": object_schema({"profile": "text", "decision": DECISIONS, "reason": "text"}, closed=True)},
            },
            closed=True,
        ),
        "source-manifest-reference": object_schema({"sourceManifestId": {"$ref": f"{BASE}:source-manifest#/properties/id"}}, closed=True),
        "taxon": object_schema({"id": "id", "status": "status", "scientificName": "text", "replacementTaxonId?": "id", "evidenceReferenceIds": "ids"}),
    }


def schema_id(name: str) -> str:
    return f"{BASE}:{name}"


def documents() -> dict[str, dict[str, Any]]:
    """All schema documents by ``$id``: one per record type, and the shared definitions."""
    made = {name: {"$schema": "https://json-schema.org/draft/2020-12/schema", "$id": schema_id(name)} | schema for name, schema in _records().items()}
    made["common"] = {"$schema": "https://json-schema.org/draft/2020-12/schema", "$id": schema_id("common"), "$defs": _shared()}
    return {schema_id(n): made[n] for n in sorted(made)}
