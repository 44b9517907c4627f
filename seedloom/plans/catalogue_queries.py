"""Queries of the catalogue operators over the whole tables, each with the DuckDB SQL it is held against."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.functions.canonical_json import canonical_json, checked_json
from seedloom.functions.columns import language_tag, sha256_hex
from seedloom.functions.json_text import canonical_text, strict_json
from seedloom.operators import integrity, reports
from seedloom.operators.artifacts import assign_chunks, compare_builds, compare_manifests, gzip_chunks
from seedloom.operators.schema import SchemaSet, listed_errors, with_validity
from seedloom.operators.units import measured_values
from seedloom.operators.wide_table import spelling
from seedloom.plans.registering import registry
from seedloom.sources import catalogue_schemas
from seedloom.sources.adapters import Mapping, Release, import_run, to_assertions
from seedloom.sources.tables import read_table

QUERIES, SQL, query = registry()


# --- identity and references -------------------------------------------------------------------------------------------

_KEYED = ("assertions", "cultivation_rules", "evidence_references", "plant_concepts", "reviews", "sources", "localized_names")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, id, count(*) AS occurrences FROM {t} WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1" for t in _KEYED))
def dup_key_summary(spark, sf):
    """Ids that a table holds more than once."""
    parts = [integrity.repeated_keys(read_table(spark, sf, t, "id"), ["id"]).select(F.lit(t).alias("table_name"), "id", "occurrences") for t in _KEYED]
    return reduce(DataFrame.unionByName, parts)


@query("SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1")
def dup_key_occurrences(spark, sf):
    """One row for each occurrence of a key after the first."""
    again = integrity.repeated_keys(read_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])
    return again.select("l_orderkey", "l_linenumber", F.explode(F.sequence(F.lit(2), F.col("occurrences").cast("int")))).drop("col")


@query("SELECT text, count(*) AS occurrences FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1")
def dup_texts(spark, sf):
    """Texts that occur more than once."""
    return integrity.repeated_keys(read_table(spark, sf, "documents", "text"), ["text"])


@query("SELECT id, reviewId FROM assertions a WHERE reviewId IS NOT NULL AND NOT EXISTS (SELECT 1 FROM reviews r WHERE r.id = a.reviewId)")
def missing_reference(spark, sf):
    """Assertions whose review is no record; no reference is no fault."""
    return integrity.missing_references(read_table(spark, sf, "assertions", "id", "reviewId"), "reviewId", read_table(spark, sf, "reviews", "id"), "id")


@query("SELECT id, e AS reference FROM (SELECT id, unnest(evidenceReferenceIds) AS e FROM assertions) a WHERE e IS NOT NULL AND NOT EXISTS (SELECT 1 FROM evidence_references r WHERE r.id = a.e)")
def exploded_references(spark, sf):
    """Evidence that is no record, once per occurrence."""
    rows = read_table(spark, sf, "assertions", "id", "evidenceReferenceIds")
    return integrity.missing_list_references(rows, "evidenceReferenceIds", read_table(spark, sf, "evidence_references", "id"), "id").select("id", "reference")


_SUBJECTS = "SELECT 'plant-concept' AS kind, id FROM plant_concepts UNION SELECT 'cultivar', cultivarId FROM cultivation_rules WHERE cultivarId IS NOT NULL"


def _targets(spark, sf) -> dict[str, tuple[DataFrame, str]]:
    cultivars = read_table(spark, sf, "cultivation_rules", "cultivarId")
    return {"plant-concept": (read_table(spark, sf, "plant_concepts", "id"), "id"), "cultivar": (cultivars, "cultivarId")}


@query(f"SELECT id, subjectType, subjectId FROM assertions a WHERE NOT EXISTS (SELECT 1 FROM ({_SUBJECTS}) s WHERE s.kind = a.subjectType AND s.id = a.subjectId)")
def polymorphic_scope(spark, sf):
    """Assertions whose subject is no record of its type; a NULL or unknown type is unresolved too."""
    rows = read_table(spark, sf, "assertions", "id", "subjectType", "subjectId")
    return integrity.unresolved_scopes(rows, F.col("subjectType"), "subjectId", _targets(spark, sf))


@query("SELECT id, plantConceptId, cultivarId FROM cultivation_rules WHERE (plantConceptId IS NULL) = (cultivarId IS NULL)")
def exactly_one_target(spark, sf):
    """Rules with both targets or none."""
    return integrity.not_exactly_one(read_table(spark, sf, "cultivation_rules", "id", "plantConceptId", "cultivarId"), "plantConceptId", "cultivarId")


_TIMING = "CASE WHEN timing IS NULL THEN '<undefined>' ELSE concat_ws('|', coalesce(timing.type, ''), coalesce(timing.start.month::VARCHAR, ''), coalesce(timing.start.day::VARCHAR, ''), coalesce(timing.\"end\".month::VARCHAR, ''), coalesce(timing.\"end\".day::VARCHAR, ''), coalesce(timing.precision, ''), coalesce(timing.anchor, ''), coalesce(timing.startOffsetDays::VARCHAR, ''), coalesce(timing.endOffsetDays::VARCHAR, '')) END"


@query(f"SELECT count(*) AS n, count(DISTINCT {_TIMING}) AS different FROM cultivation_rules WHERE cultivarId IS NOT NULL HAVING count(*) > 1 AND count(DISTINCT {_TIMING}) <> count(*)")
def global_distinctness(spark, sf):
    """Whether the timings of all cultivar rules differ; no timing is a value."""
    rules = read_table(spark, sf, "cultivation_rules", "cultivarId", "timing").where("cultivarId is not null")
    parts = ["timing.type", "timing.start.month", "timing.start.day", "timing.end.month", "timing.end.day", "timing.precision", "timing.anchor", "timing.startOffsetDays", "timing.endOffsetDays"]
    text = F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])
    return integrity.not_distinct(rules, F.when(F.col("timing").isNotNull(), text))


_ISSUES = f"""
SELECT 'DUPLICATE_ID' AS code, id AS recordId, 'Duplicate assertions identifier ' || id AS message FROM (SELECT id, row_number() OVER (PARTITION BY id) AS n FROM assertions WHERE id IS NOT NULL) WHERE n > 1
UNION ALL SELECT 'INVALID_SCOPE', coalesce(id, '<missing>'), 'Assertion subject ' || coalesce(subjectType, '<missing>') || '/' || coalesce(subjectId, '<missing>') || ' is not in the dataset' FROM ({SQL['polymorphic_scope']})
UNION ALL SELECT 'MISSING_REFERENCE', coalesce(id, '<missing>'), 'References missing evidence record ' || reference FROM ({SQL['exploded_references']})
UNION ALL SELECT 'MISSING_REFERENCE', coalesce(id, '<missing>'), 'Assertion references missing review ' || reviewId FROM assertions a WHERE reviewId IS NOT NULL AND NOT EXISTS (SELECT 1 FROM reviews r WHERE r.id = a.reviewId)
UNION ALL SELECT 'INVALID_SCOPE', coalesce(id, '<missing>'), 'Rule must target exactly one plant concept or cultivar' FROM ({SQL['exactly_one_target']})
UNION ALL SELECT 'CULTIVAR_RULES_NOT_DISTINCT', 'dataset', 'Cultivar validation rules must retain distinct reviewed parameters' FROM ({SQL['global_distinctness']})
"""


@query(_ISSUES)
def integrity_issues_union(spark, sf):
    """All issues of assertions and rules in one table."""
    record = F.coalesce("id", F.lit("<missing>")).alias("recordId")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("<missing>")) for p in parts]).alias("message")
    issue = lambda df, code, *message: df.select(F.lit(code).alias("code"), record, text(*message))
    assertions = read_table(spark, sf, "assertions", "id", "reviewId")
    again = integrity.repeated_keys(assertions, ["id"]).select("id", F.explode(F.sequence(F.lit(2), F.col("occurrences").cast("int"))))
    parts = [
        issue(again, integrity.DUPLICATE_ID, "Duplicate assertions identifier ", F.col("id")),
        issue(polymorphic_scope(spark, sf), integrity.INVALID_SCOPE, "Assertion subject ", F.col("subjectType"), "/", F.col("subjectId"), " is not in the dataset"),
        issue(exploded_references(spark, sf), integrity.MISSING_REFERENCE, "References missing evidence record ", F.col("reference")),
        issue(integrity.missing_references(assertions, "reviewId", read_table(spark, sf, "reviews", "id"), "id"), integrity.MISSING_REFERENCE, "Assertion references missing review ", F.col("reviewId")),
        issue(exactly_one_target(spark, sf), integrity.INVALID_SCOPE, "Rule must target exactly one plant concept or cultivar"),
        issue(global_distinctness(spark, sf).withColumn("id", F.lit("dataset")), integrity.NOT_DISTINCT, "Cultivar validation rules must retain distinct reviewed parameters"),
    ]
    return reduce(DataFrame.unionByName, parts)


# Every reference of the catalogue's tables: table, field, target, key.
EDGES = [
    ("assertions", "reviewId", "reviews", "id"),
    ("cultivation_rules", "contextId", "cultivation_contexts", "id"),
    ("cultivation_rules", "plantConceptId", "plant_concepts", "id"),
    ("evidence_references", "reviewId", "reviews", "id"),
    ("evidence_references", "sourceId", "sources", "id"),
    ("plant_concepts", "replacementPlantConceptId", "plant_concepts", "id"),
]
LIST_EDGES = [(t, "evidenceReferenceIds", "evidence_references", "id") for t in ("assertions", "cultivation_rules", "localized_names", "plant_concepts")]


def _edge_sql(table: str, field: str, target: str, key: str, many: bool) -> str:
    rows = f"SELECT {'unnest(' + field + ')' if many else field} AS r FROM {table}"
    return f"SELECT '{table}' AS table_name, '{field}' AS field, count(*) AS missing FROM ({rows}) x WHERE r IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {target} t WHERE t.{key} = x.r)"


@query(" UNION ALL ".join([_edge_sql(*e, False) for e in EDGES] + [_edge_sql(*e, True) for e in LIST_EDGES]))
def all_references(spark, sf):
    """Missing references of every edge of the catalogue."""
    parts = []
    for table, field, target, key in EDGES + LIST_EDGES:
        rows = read_table(spark, sf, table, field)
        if (table, field, target, key) in LIST_EDGES:
            rows = rows.select(F.explode(field).alias(field))
        lost = integrity.missing_references(rows, field, read_table(spark, sf, target, key), key)
        parts.append(lost.agg(F.count("*").alias("missing")).select(F.lit(table).alias("table_name"), F.lit(field).alias("field"), "missing"))
    return reduce(DataFrame.unionByName, parts)


# --- schema validation -------------------------------------------------------------------------------------------------


def _schemas() -> SchemaSet:
    return SchemaSet(catalogue_schemas.documents())


def _errors(df: DataFrame, name: str, id: str = "id") -> DataFrame:
    """One row per error of the records in column v: id, path, keyword."""
    return listed_errors(df, _schemas().compile(catalogue_schemas.schema_id(name))).select(id, F.col("instancePath").alias("path"), "keyword")


_ID = "'^[A-Za-z0-9][A-Za-z0-9._:-]*$'"


def _text_errors(id: str, path: str, value: str, pattern: str | None = None, least: int | None = None, most: int | None = None, where: str = "true") -> str:
    """SQL for the errors of one string member."""
    out = []
    if pattern:
        out.append(f"SELECT {id} AS id, '{path}' AS path, 'pattern' AS keyword FROM src WHERE {where} AND {value} IS NOT NULL AND NOT regexp_full_match({value}, {pattern})")
    if least:
        out.append(f"SELECT {id}, '{path}', 'minLength' FROM src WHERE {where} AND length({value}) < {least}")
    if most:
        out.append(f"SELECT {id}, '{path}', 'maxLength' FROM src WHERE {where} AND length({value}) > {most}")
    return " UNION ALL ".join(out)


def _required(names: list[str], id: str = "id") -> str:
    return " UNION ALL ".join(f"SELECT {id} AS id, '' AS path, 'required' AS keyword FROM src WHERE {n} IS NULL" for n in names)


def _list_errors(path: str, field: str) -> str:
    return (
        f"SELECT id, '{path}', 'minItems' FROM src WHERE len({field}) < 1 UNION ALL SELECT id, '{path}', 'uniqueItems' FROM src WHERE len(list_distinct({field})) + (len({field}) - list_count({field}) > 0)::INT < len({field})"
        f" UNION ALL SELECT id, '{path}/' || (i - 1), k FROM (SELECT id, i, {field}[i] AS e FROM (SELECT id, {field}, unnest(range(1, len({field}) + 1)) AS i FROM src)), (SELECT unnest(['type', 'pattern', 'minLength', 'maxLength']) AS k)"
        f" WHERE CASE k WHEN 'type' THEN e IS NULL WHEN 'pattern' THEN NOT regexp_full_match(e, {_ID}) WHEN 'minLength' THEN length(e) < 1 ELSE length(e) > 128 END"
    )


_NAME_SQL = f"""
WITH src AS (
  SELECT id AS rid, raw->>'$.id' AS id, raw->>'$.subjectType' AS subjectType, raw->>'$.subjectId' AS subjectId, raw->>'$.languageTag' AS languageTag, raw->>'$.value' AS value, raw->>'$.kind' AS kind,
    raw->>'$.preferred' AS preferred, json_type(raw, '$.preferred') AS preferred_type, (raw->'$.evidenceReferenceIds')::VARCHAR[] AS evidenceReferenceIds, raw FROM localized_names WHERE json_valid(raw)
)
SELECT * FROM (
{_required(["id", "subjectType", "subjectId", "languageTag", "value", "kind", "preferred_type", "evidenceReferenceIds"])}
UNION ALL SELECT id, '/subjectType', 'enum' FROM src WHERE subjectType NOT IN ('taxon', 'plant-concept')
UNION ALL SELECT id, '/kind', 'enum' FROM src WHERE kind NOT IN ('common', 'alias')
UNION ALL {_text_errors('id', '/id', 'id', _ID, 1, 128)}
UNION ALL {_text_errors('id', '/subjectId', 'subjectId', _ID, 1, 128)}
UNION ALL {_text_errors('id', '/languageTag', 'languageTag', "'^[A-Za-z]{2,8}(?:-[A-Za-z0-9]{1,8})*$'")}
UNION ALL {_text_errors('id', '/value', 'value', None, 1)}
UNION ALL {_list_errors('/evidenceReferenceIds', 'evidenceReferenceIds')}
)
"""


@query(_NAME_SQL)
def schema_errors_names(spark, sf):
    """Errors of names as delivered (required, type, enum, pattern, lengths, items)."""
    return _errors(read_table(spark, sf, "localized_names", "id", "raw").withColumn("v", strict_json("raw")), "localized-name")


_TIME = "'^[0-9]{4}-(0[1-9]|1[0-2])-([0-2][0-9]|3[01])T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](?:\\.[0-9]+)?Z$'"
_REVIEW_SQL = f"""
WITH src AS (SELECT id, status, reviewedAt, reviewerId, confidence, notes FROM reviews)
{_required(["id", "status"])}
UNION ALL SELECT id, '/status', 'enum' FROM src WHERE status NOT IN ('unreviewed', 'accepted', 'rejected', 'superseded')
UNION ALL {_text_errors('id', '/id', 'id', _ID, 1, 128)}
UNION ALL {_text_errors('id', '/reviewedAt', 'reviewedAt', _TIME)}
UNION ALL {_text_errors('id', '/reviewerId', 'reviewerId', _ID, 1, 128)}
UNION ALL {_text_errors('id', '/notes', 'notes', None, 1)}
UNION ALL SELECT id, '/confidence', 'minimum' FROM src WHERE confidence < 0
UNION ALL SELECT id, '/confidence', 'maximum' FROM src WHERE confidence > 1
UNION ALL SELECT id, '', 'if' FROM src WHERE status IN ('accepted', 'rejected', 'superseded') AND (reviewedAt IS NULL OR reviewerId IS NULL)
UNION ALL SELECT id, '', 'required' FROM src WHERE status IN ('accepted', 'rejected', 'superseded') AND reviewedAt IS NULL
UNION ALL SELECT id, '', 'required' FROM src WHERE status IN ('accepted', 'rejected', 'superseded') AND reviewerId IS NULL
"""


@query(_REVIEW_SQL)
def schema_errors_reviews(spark, sf):
    """Errors of reviews (conditional members, ranges)."""
    rows = read_table(spark, sf, "reviews", "id", "status", "reviewedAt", "reviewerId", "confidence", "notes")
    return _errors(rows.select("id", F.parse_json(F.to_json(F.struct("*"))).alias("v")), "review")


_CALENDAR = [
    "SELECT k, '/timing/type' AS path, 'const' AS keyword FROM t WHERE t.type <> 'calendar-date-window'",
    *[f"SELECT k, '/timing', 'required' FROM t WHERE {m} IS NULL" for m in ("t.type", "s", "e", "t.precision")],
    *[f"SELECT k, '/timing', 'additionalProperties' FROM t WHERE {m} IS NOT NULL" for m in ("t.anchor", "t.startOffsetDays", "t.endOffsetDays")],
    "SELECT k, '/timing/precision', 'enum' FROM t WHERE t.precision NOT IN ('day', 'month')",
    *[f"SELECT k, '/timing/{edge}', 'required' FROM t WHERE {n} IS NOT NULL AND {n}.{part} IS NULL" for edge, n in (("start", "s"), ("end", "e")) for part in ("month", "day")],
    *[f"SELECT k, '/timing/{edge}/{part}', '{keyword}' FROM t WHERE {n}.{part} {test}" for edge, n in (("start", "s"), ("end", "e")) for part, most in (("month", 12), ("day", 31)) for keyword, test in (("minimum", "< 1"), ("maximum", f"> {most}"))],
]
_RELATIVE = [
    "SELECT k, '/timing/type' AS path, 'const' AS keyword FROM t WHERE t.type <> 'relative-day-window'",
    *[f"SELECT k, '/timing', 'required' FROM t WHERE {m} IS NULL" for m in ("t.type", "t.anchor", "t.startOffsetDays", "t.endOffsetDays")],
    *[f"SELECT k, '/timing', 'additionalProperties' FROM t WHERE {m} IS NOT NULL" for m in ("s", "e", "t.precision")],
    "SELECT k, '/timing/anchor', 'enum' FROM t WHERE t.anchor NOT IN ('last_spring_frost', 'first_autumn_frost', 'previous_crop_harvest')",
]
_TIMED = f"""
WITH t AS (SELECT row_number() OVER () AS k, id, timing AS t, timing.start AS s, timing."end" AS e FROM cultivation_rules WHERE timing IS NOT NULL),
calendar AS ({" UNION ALL ".join(_CALENDAR)}), relative AS ({" UNION ALL ".join(_RELATIVE)}), wrong AS (SELECT k FROM calendar INTERSECT SELECT k FROM relative)
SELECT t.id, x.path, x.keyword FROM (SELECT * FROM calendar UNION ALL SELECT * FROM relative UNION ALL SELECT k, '/timing', 'oneOf' FROM wrong) x JOIN wrong USING (k) JOIN t USING (k)
"""
_RULE_SQL = f"""
WITH src AS (SELECT id, status, plantConceptId, cultivarId, contextId, action, timing, evidenceReferenceIds FROM cultivation_rules)
SELECT id, path, keyword FROM (
SELECT id, path, keyword FROM ({_required(["id", "status", "contextId", "action", "timing", "evidenceReferenceIds"])})
UNION ALL SELECT id, '/status', 'enum' FROM src WHERE status NOT IN ('active', 'retired')
UNION ALL SELECT id, '/action', 'enum' FROM src WHERE action NOT IN ('start_indoors', 'direct_sow', 'transplant', 'plant_now')
UNION ALL {_text_errors('id', '/id', 'id', _ID, 1, 128)}
UNION ALL {_text_errors('id', '/plantConceptId', 'plantConceptId', _ID, 1, 128)}
UNION ALL {_text_errors('id', '/cultivarId', 'cultivarId', _ID, 1, 128)}
UNION ALL {_text_errors('id', '/contextId', 'contextId', _ID, 1, 128)}
UNION ALL {_list_errors('/evidenceReferenceIds', 'evidenceReferenceIds')}
UNION ALL SELECT id, '', 'oneOf' FROM src WHERE (plantConceptId IS NULL) = (cultivarId IS NULL)
UNION ALL SELECT id, '', unnest(['not', 'not']) FROM src WHERE plantConceptId IS NOT NULL AND cultivarId IS NOT NULL
UNION ALL SELECT id, '', unnest(['required', 'required']) FROM src WHERE plantConceptId IS NULL AND cultivarId IS NULL
UNION ALL SELECT id, path, keyword FROM ({_TIMED})
)
"""


@query(_RULE_SQL)
def schema_errors_rules(spark, sf):
    """Errors of rules (exactly one target by oneOf and not, both kinds of window, months, days, offsets)."""
    return _rule_errors(spark, sf)


def _rule_errors(spark, sf) -> DataFrame:
    rows = read_table(spark, sf, "cultivation_rules", "id", "status", "plantConceptId", "cultivarId", "contextId", "action", "timing", "evidenceReferenceIds")
    return _errors(rows.select("id", F.parse_json(F.to_json(F.struct("*"))).alias("v")), "cultivation-rule")


@query("""
WITH t AS (SELECT id, timing AS t, timing.start AS s, timing."end" AS e FROM cultivation_rules WHERE timing IS NOT NULL),
c AS (SELECT id, (t.type = 'calendar-date-window' AND s.month BETWEEN 1 AND 12 AND s.day BETWEEN 1 AND 31 AND e.month BETWEEN 1 AND 12 AND e.day BETWEEN 1 AND 31 AND t.precision IN ('day', 'month') AND t.anchor IS NULL AND t.startOffsetDays IS NULL AND t.endOffsetDays IS NULL) AS cal,
  (t.type = 'relative-day-window' AND t.anchor IN ('last_spring_frost', 'first_autumn_frost', 'previous_crop_harvest') AND t.startOffsetDays IS NOT NULL AND t.endOffsetDays IS NOT NULL AND s IS NULL AND e IS NULL AND t.precision IS NULL) AS rel FROM t)
SELECT id FROM c WHERE (coalesce(cal, false))::INT + (coalesce(rel, false))::INT <> 1
""")
def schema_timing_union(spark, sf):
    """Rules whose timing is neither a calendar nor a relative window."""
    return _rule_errors(spark, sf).where("path = '/timing' and keyword = 'oneOf'").select("id")


@query("""
SELECT event_id FROM events WHERE NOT (json_valid(props) AND json_type(props) = 'OBJECT' AND json_type(props, '$.k') IN ('BIGINT', 'UBIGINT') AND (props->>'$.k')::BIGINT BETWEEN 0 AND 50 AND len(json_keys(props)) = 1)
""")
def schema_invalid_events(spark, sf):
    """Events whose properties break a schema given at run time (closed object, integer range)."""
    schema = {"$id": "urn:seedloom:schema:v1:event-properties"} | catalogue_schemas.object_schema({"k": {"type": "integer", "minimum": 0, "maximum": 50}}, closed=True)
    compiled = SchemaSet([schema]).compile(schema["$id"])
    rows = read_table(spark, sf, "events", "event_id", "props").withColumn("v", strict_json("props"))
    return with_validity(rows, compiled).where("not valid").select("event_id")


# --- canonical JSON and artifacts --------------------------------------------------------------------------------------


@query("SELECT DISTINCT id, 'INVALID_JSON' AS code FROM assertions WHERE value IS NOT NULL AND NOT json_valid(value)")
def strict_parse_report(spark, sf):
    """Values that aren't one JSON value, or repeat a member name."""
    checked = read_table(spark, sf, "assertions", "id", "value").select("id", checked_json("value").alias("p"))
    return checked.where("p.code is not null").select("id", F.col("p.code").alias("code")).distinct()


_MEMBERS = ["evidenceReferenceIds", "id", "kind", "languageTag", "preferred", "subjectId", "subjectType", "value"]
_CANONICAL = "concat_ws(',', " + ", ".join(f"'\"{m}\":' || (raw->'$.{m}')::VARCHAR" for m in _MEMBERS) + ")"


@query(f"SELECT id, sha256('{{' || {_CANONICAL} || '}}') AS sha256 FROM localized_names")
def canonical_record_hash(spark, sf):
    """Digest of the canonical form of every name as delivered: the same whatever the order of its members."""
    checked = read_table(spark, sf, "localized_names", "id", "raw").select("id", canonical_json("raw").alias("text"))
    return checked.select("id", sha256_hex(F.col("text")).alias("sha256"))


@query("SELECT DISTINCT languageTag, list_aggregate(list_transform(string_split(lower(replace(trim(languageTag), '_', '-')), '-'), lambda p, i: CASE WHEN i > 1 AND length(p) = 2 THEN upper(p) WHEN i > 1 AND length(p) = 4 THEN upper(p[1]) || p[2:] ELSE p END), 'string_agg', '-') AS tag FROM localized_names WHERE trim(languageTag) <> ''")
def language_tags(spark, sf):
    """Language tags in their usual letter case."""
    return read_table(spark, sf, "localized_names", "languageTag").distinct().select("languageTag", language_tag(F.col("languageTag")).alias("tag")).where("tag is not null")


@query("SELECT count(*) AS entries, sum(octet_length(encode(raw)) + 1)::BIGINT AS bytes FROM localized_names WHERE raw IS NOT NULL")
def entry_count_and_bytes(spark, sf):
    """Entries and bytes of the names framed as JSON Lines."""
    rows = read_table(spark, sf, "localized_names", "raw").where("raw is not null")
    return rows.agg(F.count("*").alias("entries"), F.sum(F.octet_length("raw") + 1).alias("bytes"))


@query("SELECT doc_id, ((sum(octet_length(encode(text))) OVER (ORDER BY doc_id) - octet_length(encode(text))) // 65536)::BIGINT AS chunk FROM documents WHERE text IS NOT NULL")
def chunk_assignment(spark, sf):
    """Chunk of every document by the running size of the texts before it."""
    rows = read_table(spark, sf, "documents", "doc_id", "text").where("text is not null").select("doc_id", F.octet_length("text").alias("size"))
    return assign_chunks(rows, "doc_id", "size", 65536).select("doc_id", "chunk")


@query()
def gzip_artifact(spark, sf):
    """Reproducible chunks of all names as canonical JSON Lines: digest, size and entries."""
    lines = read_table(spark, sf, "localized_names", "id", "raw").select("id", canonical_json("raw").alias("line"))
    return gzip_chunks(lines, "id", "line").drop("bytes")


def _compare_ends(rows: DataFrame) -> DataFrame:
    ends = rows.agg(F.min("snapshot_date").alias("a"), F.max("snapshot_date").alias("b")).first()
    pick = lambda day: rows.where(F.col("snapshot_date") == F.lit(day)).drop("snapshot_date")
    return compare_builds(pick(ends.a), pick(ends.b))


_BUILD = "SELECT id, status, taxonId, replacementPlantConceptId, list_sort(evidenceReferenceIds, 'ASC', 'NULLS LAST') AS evidenceReferenceIds FROM plant_concept_snapshots WHERE snapshot_date = (SELECT {}(snapshot_date) FROM plant_concept_snapshots)"


@query(f"""
SELECT 'first' AS side, * FROM ({_BUILD.format("min")} EXCEPT ALL {_BUILD.format("max")})
UNION ALL SELECT 'second' AS side, * FROM ({_BUILD.format("max")} EXCEPT ALL {_BUILD.format("min")})
""")
def build_compare(spark, sf):
    """Rows that only the first or only the last snapshot has, by all columns but the time of receipt; the order of evidence is no difference."""
    rows = read_table(spark, sf, "plant_concept_snapshots").drop("received_at")
    return _compare_ends(rows.withColumns({c: F.array_sort(c) for c, kind in rows.dtypes if kind.startswith("array")}))


@query("""
WITH e AS (SELECT sourceManifestId AS path, count(*) AS entries FROM evidence_references WHERE sourceManifestId IS NOT NULL GROUP BY 1), a AS (SELECT sourceManifestId AS path, count(DISTINCT id) AS entries FROM evidence_references WHERE deleted_at IS NULL AND sourceManifestId IS NOT NULL GROUP BY 1)
SELECT coalesce(e.path, a.path) AS path, CASE WHEN a.path IS NULL THEN 'missing' WHEN e.path IS NULL THEN 'extra' ELSE 'mismatch' END AS problem FROM e FULL JOIN a ON e.path = a.path WHERE a.path IS NULL OR e.path IS NULL OR e.entries <> a.entries
""")
def manifest_verify(spark, sf):
    """Manifests whose delivered rows aren't the records that are there now."""
    rows = read_table(spark, sf, "evidence_references", "id", "sourceManifestId", "deleted_at").where("sourceManifestId is not null").withColumnRenamed("sourceManifestId", "path")
    expected = rows.groupBy("path").agg(F.count("*").alias("entries"))
    actual = rows.where("deleted_at is null").groupBy("path").agg(F.count_distinct("id").alias("entries"))
    return compare_manifests(expected, actual, "path", ["entries"])


# --- reports and resolutions -------------------------------------------------------------------------------------------


@query("SELECT sourceId, licenceId, list_aggregate(list_sort(list(DISTINCT id)), 'string_agg', ',') AS included FROM (SELECT sourceId, rights.licenceId AS licenceId, id FROM evidence_references WHERE id IS NOT NULL) GROUP BY sourceId, licenceId")
def attribution_rollup(spark, sf):
    """Records that each source and licence has to be named for."""
    rows = read_table(spark, sf, "evidence_references", "id", "sourceId", "rights").select("id", "sourceId", F.col("rights.licenceId").alias("licenceId"))
    return reports.attribution(rows, ["sourceId", "licenceId"], "id").withColumn("included", F.array_join("included", ","))


@query("""
SELECT kind, metric, covered, denominator FROM (
  SELECT kind, count(*) AS denominator, count(*) FILTER (WHERE preferred) AS a, count(*) FILTER (WHERE lower(languageTag) LIKE 'fr%') AS b, count(*) FILTER (WHERE len(evidenceReferenceIds) > 0) AS c FROM localized_names GROUP BY kind)
CROSS JOIN LATERAL (VALUES ('preferred', a), ('french', b), ('with evidence', c)) v(metric, covered)
""")
def coverage_report(spark, sf):
    """Names by kind: preferred, French and with evidence, of how many."""
    metrics = {"preferred": F.col("preferred"), "french": F.lower("languageTag").startswith("fr"), "with evidence": F.size("evidenceReferenceIds") > 0}
    return reports.coverage(read_table(spark, sf, "localized_names"), metrics, ["kind"])


_IN_CONTEXT = ["subjectType", "subjectId", "predicate", "geo", "growingSystem", "propagation"]


def _said_in_context(spark, sf) -> DataFrame:
    """Values of assertions with what they are said of, predicates apart from their spelling, and the parts of their context."""
    rows = read_table(spark, sf, "assertions", "subjectType", "subjectId", "predicate", "value", "context")
    geo = F.array_join(F.array_sort(F.array_compact("context.geographicContextIds")), ",")
    return rows.select("subjectType", "subjectId", spelling(F.col("predicate")).alias("predicate"), geo.alias("geo"), F.col("context.growingSystem").alias("growingSystem"), F.col("context.propagation").alias("propagation"), "value")


# A value by its leaves: path, kind and what stands there, numbers as doubles.
_LEAVES = "(SELECT string_agg(j.fullkey || '=' || CASE WHEN j.type IN ('BIGINT', 'UBIGINT', 'HUGEINT', 'DOUBLE') THEN 'n' || (j.atom::VARCHAR)::DOUBLE ELSE j.type || coalesce(j.atom::VARCHAR, '') END, ';' ORDER BY j.fullkey) FROM json_tree(value::JSON) j)"


@query(f"""
WITH said AS (
  SELECT DISTINCT subjectType, subjectId, regexp_replace(lower(predicate), '[\\s _-]', '', 'g') AS predicate, array_to_string(list_sort(list_filter(context.geographicContextIds, lambda g: g IS NOT NULL)), ',') AS geo, context.growingSystem AS growingSystem, context.propagation AS propagation, value
  FROM assertions WHERE json_valid(value))
SELECT subjectType, subjectId, predicate, geo, growingSystem, propagation, count(DISTINCT leaves) AS different FROM (SELECT *, {_LEAVES} AS leaves FROM said) GROUP BY ALL HAVING count(DISTINCT leaves) > 1
""")
def contradiction_report(spark, sf):
    """Subjects with different values of any shape for one predicate and context, by the values' canonical JSON."""
    return reports.contradictions(_said_in_context(spark, sf).withColumn("c", canonical_json("value")), _IN_CONTEXT, F.col("c"))


@query(f"""
SELECT subjectType, subjectId, predicate, count(DISTINCT leaves) AS different FROM (
  SELECT subjectType, subjectId, regexp_replace(lower(predicate), '[\\s _-]', '', 'g') AS predicate, {_LEAVES} AS leaves FROM assertions WHERE json_valid(value))
GROUP BY ALL HAVING count(DISTINCT leaves) > 1
""")
def contradictions_in_any_context(spark, sf):
    """Subjects with different values for one predicate, whatever the context."""
    return reports.contradictions(_said_in_context(spark, sf).withColumn("c", canonical_json("value")), _IN_CONTEXT[:3], F.col("c"))


@query("SELECT subjectId, languageTag, count(*) FILTER (WHERE preferred) AS n FROM localized_names GROUP BY 1, 2 HAVING count(*) FILTER (WHERE preferred) > 1")
def preferred_uniqueness(spark, sf):
    """Subjects with several preferred names in a language."""
    return reports.more_than_one(read_table(spark, sf, "localized_names", "subjectId", "languageTag", "preferred"), ["subjectId", "languageTag"], F.col("preferred"))


@query("""
WITH s AS (SELECT id AS subject, min(taxonId) AS scientificName FROM plant_concepts GROUP BY id),
n AS (SELECT subjectId AS subject, languageTag AS language, value, row_number() OVER (PARTITION BY subjectId ORDER BY (languageTag IS DISTINCT FROM 'fr')::INT, (NOT coalesce(preferred, false))::INT, languageTag NULLS FIRST, value) AS k FROM localized_names WHERE value IS NOT NULL AND subjectId IS NOT NULL AND (languageTag = 'fr' OR preferred))
SELECT s.subject, coalesce(n.value, s.scientificName) AS name, n.language FROM s LEFT JOIN n ON s.subject = n.subject AND n.k = 1
""")
def name_fallback(spark, sf):
    """A French name of every plant, else a preferred one, else its scientific one."""
    subjects = read_table(spark, sf, "plant_concepts", "id", "taxonId").groupBy(F.col("id").alias("subject")).agg(F.min("taxonId").alias("scientificName"))
    names = read_table(spark, sf, "localized_names", "subjectId", "languageTag", "value", "preferred").withColumnsRenamed({"subjectId": "subject", "languageTag": "language"})
    return reports.name_fallback(subjects, names, "fr")


@query("SELECT reviewerId, id, status, reviewedAt FROM reviews WHERE reviewerId IS NOT NULL QUALIFY row_number() OVER (PARTITION BY reviewerId ORDER BY reviewedAt DESC NULLS LAST, id DESC, status DESC NULLS LAST) = 1")
def supersession_latest(spark, sf):
    """The latest review of every reviewer."""
    rows = read_table(spark, sf, "reviews", "id", "status", "reviewedAt", "reviewerId").where("reviewerId is not null")
    return reports.latest(rows, ["reviewerId"], ["reviewedAt"], ["id", "status", "reviewedAt"])


@query("""
WITH RECURSIVE p AS (SELECT id, min(replacementPlantConceptId) AS nxt FROM plant_concepts GROUP BY id),
walk AS (SELECT id, id AS place, nxt, 0 AS steps, [id] AS seen FROM p UNION ALL SELECT w.id, w.nxt, q.nxt, w.steps + 1, list_append(w.seen, w.nxt) FROM walk w LEFT JOIN p q ON q.id = w.nxt WHERE w.nxt IS NOT NULL AND NOT list_contains(w.seen, w.nxt))
SELECT id, CASE WHEN nxt IS NULL THEN place END AS final, CASE WHEN nxt IS NULL THEN steps END::BIGINT AS steps FROM walk QUALIFY row_number() OVER (PARTITION BY id ORDER BY walk.steps DESC) = 1
""")
def replacement_chain(spark, sf):
    """What every plant is finally replaced by; NULL for a cycle."""
    plants = read_table(spark, sf, "plant_concepts", "id", "replacementPlantConceptId").groupBy("id").agg(F.min("replacementPlantConceptId").alias("replacement"))
    return reports.resolve_replacements(plants)


_CASE = "CASE WHEN subjectId IS NULL THEN 'no subject' WHEN value IS NULL THEN 'no value' WHEN NOT json_valid(value) THEN 'unreadable value' WHEN coalesce(len(evidenceReferenceIds), 0) = 0 THEN 'no evidence' END"


@query(f"SELECT reason, count(*) AS records FROM (SELECT {_CASE} AS reason FROM assertions) WHERE reason IS NOT NULL GROUP BY reason")
def exclusions_with_reason(spark, sf):
    """Assertions that can't be used, by the first reason."""
    rows = read_table(spark, sf, "assertions", "subjectId", "value", "evidenceReferenceIds")
    reasons = {"no subject": F.col("subjectId").isNull(), "no value": F.col("value").isNull(), "unreadable value": strict_json("value").isNull(), "no evidence": F.coalesce(F.size("evidenceReferenceIds"), F.lit(0)) <= 0}
    return reports.exclusions(rows, reasons).groupBy("reason").agg(F.count("*").alias("records"))


_BASE_UNITS = {"cm": ("m", 0.01), "mm": ("m", 0.001), "kg": ("kg", 1.0)}


@query()
def unit_normalisation(spark, sf):
    """Measured values of every shape in base units, with number and unit as said and the original; ranges give a row for each bound.

    A unit without a base unit here (days, pH) leaves base_value and base_unit NULL.
    """
    rows = read_table(spark, sf, "assertions", "id", "predicate", "value", "normalization").select("id", "predicate", "value", F.col("normalization.unit").alias("unit"))
    said = measured_values(rows, read_table(spark, sf, "predicate_registry", "predicate", "value_type", "unit", "aliases"))
    based = reports.normalised_units(said, "number", "said_unit", _BASE_UNITS)
    return based.select("id", "bound", "base_value", "base_unit", "number", F.col("said_unit").alias("unit"), F.col("value").alias("original")).distinct()


_SPELLED = "regexp_replace(lower({}), '[\\s _-]', '', 'g')"


@query(f"SELECT DISTINCT a.predicate, r.name FROM assertions a JOIN (SELECT predicate AS name, unnest(list_append(aliases, predicate)) AS alias FROM predicate_registry) r ON {_SPELLED.format('a.predicate')} = {_SPELLED.format('r.alias')}")
def reconciled_predicates(spark, sf):
    """Spellings of predicates and the registry's name for them."""
    registry = read_table(spark, sf, "predicate_registry", "predicate", "aliases").select(F.col("predicate").alias("name"), F.explode(F.array_append("aliases", F.col("predicate"))).alias("predicate"))
    spelled = read_table(spark, sf, "assertions", "predicate").where("predicate is not null").distinct()
    return reports.reconciled(spelled, registry, "predicate", "name", spelling(F.col("predicate")))[0]


@query(f"SELECT DISTINCT a.predicate, 'unresolved' AS issue FROM assertions a WHERE a.predicate IS NOT NULL AND {_SPELLED.format('a.predicate')} NOT IN (SELECT {_SPELLED.format('alias')} FROM (SELECT unnest(list_append(aliases, predicate)) AS alias FROM predicate_registry))")
def unresolved_predicates(spark, sf):
    """Predicates outside the registry, as issues."""
    registry = read_table(spark, sf, "predicate_registry", "predicate", "aliases").select(F.col("predicate").alias("name"), F.explode(F.array_append("aliases", F.col("predicate"))).alias("predicate"))
    spelled = read_table(spark, sf, "assertions", "predicate").where("predicate is not null").distinct()
    return reports.reconciled(spelled, registry, "predicate", "name", spelling(F.col("predicate")))[1]


@query("SELECT source, lang, doc_id, votes, rank FROM (SELECT source, lang, doc_id, votes, row_number() OVER (PARTITION BY source, lang ORDER BY votes DESC NULLS LAST, doc_id) AS rank FROM documents) WHERE rank <= 3")
def top_answers(spark, sf):
    """The three documents with most votes of each source and language."""
    rows = read_table(spark, sf, "documents", "source", "lang", "doc_id", "votes")
    return reports.ranked(rows, ["source", "lang"], [F.desc_nulls_last("votes"), F.col("doc_id")], 3)


@query("""
SELECT p.sourceManifestId, a.predicate, count(*) AS assertions, count(DISTINCT a.id) AS records FROM (SELECT id, predicate, unnest(list_distinct(evidenceReferenceIds)) AS e FROM assertions) a
JOIN (SELECT id, min(sourceManifestId) AS sourceManifestId FROM evidence_references GROUP BY id) p ON p.id = a.e GROUP BY 1, 2
""")
def evidence_projection(spark, sf):
    """Assertions by the source manifest of their evidence."""
    uses = read_table(spark, sf, "assertions", "id", "predicate", "evidenceReferenceIds").select("id", "predicate", F.explode(F.array_distinct("evidenceReferenceIds")).alias("e"))
    evidence = read_table(spark, sf, "evidence_references", "id", "sourceManifestId").groupBy(F.col("id").alias("e")).agg(F.min("sourceManifestId").alias("sourceManifestId"))
    return uses.join(evidence, "e").groupBy("sourceManifestId", "predicate").agg(F.count("*").alias("assertions"), F.count_distinct("id").alias("records"))


def _imported(spark, sf):
    rows = read_table(spark, sf, "part", "p_partkey", "p_name", "p_size", "p_retailprice", "p_brand")
    release = Release("source_parts", "manifest_parts", "1", "licence_open_a")
    mappings = [Mapping("size", "p_size", "cm"), Mapping("price", "p_retailprice"), Mapping("brand", "p_brand")]
    locator = F.when(F.col("p_size") > 1, F.concat(F.lit("part/"), F.col("p_partkey").cast("string")))
    return to_assertions(rows, release, "part", F.concat(F.lit("part_"), F.col("p_partkey").cast("string")), F.col("p_partkey"), locator, mappings)


@query("""
SELECT 'source_parts:1:' || p_partkey || ':' || m.predicate AS id, 'part_' || p_partkey AS subjectId, m.predicate, m.value FROM part
CROSS JOIN LATERAL (VALUES ('size', p_size::VARCHAR), ('price', p_retailprice::VARCHAR), ('brand', to_json(p_brand)::VARCHAR)) m(predicate, value) WHERE p_size > 1 AND m.value IS NOT NULL
""")
def adapted_assertions(spark, sf):
    """Parts of a release as assertions of every mapped column."""
    return _imported(spark, sf)[0].select("id", "subjectId", "predicate", "value")


@query("""
SELECT 'assertions' AS what, NULL AS reason, (SELECT count(p_size) + count(p_retailprice) + count(p_brand) FROM part WHERE p_size > 1) AS n UNION ALL SELECT 'evidence', NULL, (SELECT count(DISTINCT p_partkey) FROM part WHERE p_size > 1)
UNION ALL SELECT 'rejected', 'no locator', n FROM (SELECT count(*) AS n FROM part WHERE p_size <= 1 OR p_size IS NULL) WHERE n > 0
""")
def import_run_counts(spark, sf):
    """What an import run made and refused."""
    return import_run(*_imported(spark, sf))


@query("""
WITH a AS (SELECT DISTINCT subjectType, subjectId, predicate FROM assertions WHERE predicate IS NOT NULL),
c AS (SELECT DISTINCT r.cultivarId AS id, s.id AS plant FROM cultivation_rules r JOIN plant_concepts s ON right(s.id, 5) = right(r.cultivarId, 5) WHERE r.cultivarId IS NOT NULL)
SELECT plant AS plantConceptId, predicate, CASE WHEN min(far) = 1 THEN 'cultivar-only' END AS limitation FROM (
  SELECT subjectId AS plant, predicate, 0 AS far FROM a WHERE subjectType = 'plant-concept' AND subjectId IS NOT NULL UNION ALL SELECT c.plant, a.predicate, 1 FROM a JOIN c ON a.subjectId = c.id WHERE a.subjectType = 'cultivar') GROUP BY 1, 2
""")
def generic_facts(spark, sf):
    """Predicates that plants have themselves, or only through a cultivar of the same number."""
    plants = read_table(spark, sf, "plant_concepts", "id").where("id is not null").distinct().select(F.col("id").alias("plantConceptId"), F.right("id", F.lit(5)).alias("n"))
    cultivars = read_table(spark, sf, "cultivation_rules", "cultivarId").where("cultivarId is not null").distinct().select(F.col("cultivarId").alias("id"), F.right("cultivarId", F.lit(5)).alias("n"))
    return reports.generic_facts(read_table(spark, sf, "assertions", "subjectType", "subjectId", "predicate"), cultivars.join(plants, "n"))
