"""Queries of the validation, artifact, release and calendar surface over the whole tables, each with the DuckDB SQL it is held against."""

from __future__ import annotations

import uuid
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.functions import columns
from seedloom.functions.canonical_json import checked_json
from seedloom.operators import artifacts, integrity, reports
from seedloom.operators.ordering import numbered
from seedloom.operators.schema import SchemaSet, with_validation
from seedloom.operators.wide_table import spelling
from seedloom.plans.catalogue_queries import SQL as CATALOGUE_SQL
from seedloom.plans.lineage import shared_folder
from seedloom.plans.registering import registry
from seedloom.sources import catalogue_schemas
from seedloom.sources.jsonl import read_binary, read_jsonl
from seedloom.sources.manifests import load_cases, run_cases
from seedloom.sources.tables import read_table

QUERIES, SQL, query = registry()

# --- a whole dataset ---------------------------------------------------------------------------------------------------

_CULTIVARS = "SELECT c.id, coalesce(p.id, 'plant_' || right(c.id, 8)) AS plantConceptId FROM (SELECT DISTINCT cultivarId AS id FROM cultivation_rules WHERE cultivarId IS NOT NULL) c LEFT JOIN (SELECT right(id, 8) AS n, min(id) AS id FROM plant_concepts GROUP BY 1) p ON p.n = right(c.id, 8)"
# The collections of a dataset and the tables that they are read from, in the order of the checks.
_COLLECTIONS = {
    "taxa": "SELECT DISTINCT taxonId AS id FROM plant_concepts", "plantConcepts": "SELECT id FROM plant_concepts", "cultivars": f"SELECT id FROM ({_CULTIVARS})", "contexts": "SELECT id FROM cultivation_contexts",
    "rules": "SELECT id FROM cultivation_rules", "assertions": "SELECT id FROM assertions", "evidence": "SELECT id FROM evidence_references", "reviews": "SELECT id FROM reviews",
}
_AGAIN = " UNION ALL ".join(
    f"SELECT {k} AS phase, 0 AS place, 'DUPLICATE_ID' AS code, id AS recordId, 'Duplicate {name} identifier ' || id AS message FROM (SELECT id, row_number() OVER (PARTITION BY id) AS n FROM ({rows})) WHERE id IS NOT NULL AND n > 1"
    for k, (name, rows) in enumerate(_COLLECTIONS.items())
)
_SCOPE = f"SELECT id, subjectType, subjectId FROM assertions a WHERE NOT EXISTS (SELECT 1 FROM (SELECT 'plant-concept' AS kind, id FROM plant_concepts UNION SELECT 'cultivar', id FROM ({_CULTIVARS})) s WHERE s.kind = a.subjectType AND s.id = a.subjectId)"
_DATASET = f"""
SELECT row_number() OVER (ORDER BY phase, recordId, place, message) AS position, code, recordId, message FROM (
{_AGAIN}
UNION ALL SELECT 8, 0, 'MISSING_REFERENCE', id, 'Cultivar references missing plant concept ' || plantConceptId FROM ({_CULTIVARS}) WHERE plantConceptId NOT IN (SELECT id FROM plant_concepts)
UNION ALL SELECT 9, -1, 'INVALID_SCOPE', coalesce(id, '<missing>'), 'Assertion subject ' || coalesce(subjectType, '<missing>') || '/' || coalesce(subjectId, '<missing>') || ' is not in the dataset' FROM ({_SCOPE})
UNION ALL SELECT 9, i - 1, 'MISSING_REFERENCE', coalesce(id, '<missing>'), 'References missing evidence record ' || r FROM (SELECT id, i, evidenceReferenceIds[i] AS r FROM (SELECT id, evidenceReferenceIds, unnest(range(1, len(evidenceReferenceIds) + 1)) AS i FROM assertions)) a WHERE r IS NOT NULL AND NOT EXISTS (SELECT 1 FROM evidence_references e WHERE e.id = a.r)
UNION ALL SELECT 9, 2147483647, 'MISSING_REFERENCE', coalesce(id, '<missing>'), 'Assertion references missing review ' || reviewId FROM assertions a WHERE reviewId IS NOT NULL AND NOT EXISTS (SELECT 1 FROM reviews r WHERE r.id = a.reviewId)
UNION ALL SELECT 10, 0, 'INVALID_SCOPE', coalesce(id, '<missing>'), 'Rule must target exactly one plant concept or cultivar' FROM ({CATALOGUE_SQL['exactly_one_target']})
UNION ALL SELECT 11, 0, 'CULTIVAR_RULES_NOT_DISTINCT', 'dataset', 'Cultivar validation rules must retain distinct reviewed parameters' FROM ({CATALOGUE_SQL['global_distinctness']})
)"""


def _records(rows: DataFrame) -> DataFrame:
    """Rows as records: v, and line, their place in the files."""
    return rows.select(F.parse_json(F.to_json(F.struct(*[c for c in rows.columns if c != "line"]))).alias("v"), "line")


@query(_DATASET)
def dataset_issues(spark, sf):
    """All issues of the catalogue as one dataset, in the order of the checks and, within one, of the records' ids."""

    def read(table: str, *names: str) -> DataFrame:
        # A table has no lines; a row's file and its number there are unique and the same in every task.
        return spark.read.parquet(f"{sf}/{table}.parquet").select(*names, F.struct("_metadata.file_path", "_metadata.row_index").alias("line"))

    made = lambda df: df.withColumn("line", F.struct(F.col("id").alias("file_path"), F.lit(0).cast("bigint").alias("row_index")))  # noqa: E731 - distinct ids
    plants = read_table(spark, sf, "plant_concepts", "id", "taxonId")
    cultivars = read_table(spark, sf, "cultivation_rules", "cultivarId").where("cultivarId is not null").distinct().select(F.col("cultivarId").alias("id"), F.right("cultivarId", F.lit(8)).alias("n"))
    numbers = plants.groupBy(F.right("id", F.lit(8)).alias("n")).agg(F.min("id").alias("plant"))
    cultivars = cultivars.join(numbers, "n", "left").select("id", F.coalesce("plant", F.concat(F.lit("plant_"), "n")).alias("plantConceptId"))
    dataset = {
        "taxa": made(plants.select(F.col("taxonId").alias("id")).distinct()), "plantConcepts": read("plant_concepts", "id"), "cultivars": made(cultivars), "contexts": read("cultivation_contexts", "id"),
        "rules": read("cultivation_rules", "id", "plantConceptId", "cultivarId", "timing"), "assertions": read("assertions", "id", "subjectType", "subjectId", "evidenceReferenceIds", "reviewId"),
        "evidence": read("evidence_references", "id"), "reviews": read("reviews", "id"),
    }
    issues = integrity.dataset_issues({k: _records(v) for k, v in dataset.items()})
    return numbered(issues.drop("line"), ["phase", "recordId", "place", "message"]).select("position", "code", "recordId", "message")


@query("""
WITH c AS (SELECT id, any_value(growingSystem) AS growingSystem, any_value(propagation) AS propagation FROM cultivation_contexts GROUP BY id),
p AS (SELECT id, arg_min(taxonId, received_at) AS taxonId FROM plant_concepts GROUP BY id)
SELECT DISTINCT r.id, r.action, r.contextId, c.growingSystem, c.propagation, coalesce(r.plantConceptId, r.cultivarId) AS target, CASE WHEN r.plantConceptId IS NOT NULL THEN 'plant-concept' WHEN r.cultivarId IS NOT NULL THEN 'cultivar' END AS kind, p.taxonId
FROM cultivation_rules r LEFT JOIN c ON c.id = r.contextId LEFT JOIN p ON p.id = r.plantConceptId
""")
def rule_details(spark, sf):
    """Rules with their context and their target, a plant or a cultivar; what is missing stays NULL."""
    rules = read_table(spark, sf, "cultivation_rules", "id", "action", "contextId", "plantConceptId", "cultivarId").distinct()
    contexts = read_table(spark, sf, "cultivation_contexts", "id", "growingSystem", "propagation")
    plants = read_table(spark, sf, "plant_concepts", "id", "taxonId", "received_at")
    return reports.rule_details(rules, contexts, reports.best_of(plants, ["id"], [F.col("received_at")], ["taxonId"]))


# --- canonical JSON ----------------------------------------------------------------------------------------------------


def _checked(rows: DataFrame, key: str, text: Column, *fields: str) -> DataFrame:
    return rows.select(key, checked_json(text).alias("p")).select(key, *[f"p.{f}" for f in fields])


@query("SELECT p_partkey, 'DUPLICATE_KEY' AS code, '/parts/0/a~1' || (p_partkey % 3) AS path FROM part WHERE p_partkey % 3 = p_size % 3")
def duplicate_members(spark, sf):
    """Documents that name a member twice, once with an escape, with the pointer to it."""
    text = F.expr("""concat('{"parts":[{"a/', p_partkey % 3, '":1,"x":{"x":[]},"a\\\\u002f', p_size % 3, '":2}]}')""")
    return _checked(read_table(spark, sf, "part", "p_partkey", "p_size"), "p_partkey", text, "code", "path").where("code is not null")


@query("SELECT p_partkey, CASE WHEN p_size > 30 THEN 'UNSUPPORTED_VALUE' END AS code, CASE WHEN p_size > 30 THEN '/a/1' END AS path, CASE WHEN p_size <= 30 THEN '{\"a\":[\"' || p_brand || '\",1e+' || (p_size * 10) || ']}' END AS text FROM part WHERE p_size >= 3")
def unsupported_numbers(spark, sf):
    """Numbers beyond the range of doubles are refused with their pointer, others written as ECMAScript does."""
    rows = read_table(spark, sf, "part", "p_partkey", "p_size", "p_brand").where("p_size >= 3")
    return _checked(rows, "p_partkey", F.expr("""concat('{"a": ["', p_brand, '", 1E', p_size * 10, ']}')"""), "code", "path", "text")


@query("SELECT p_partkey, '[' || CASE WHEN p_retailprice = floor(p_retailprice) THEN p_retailprice::BIGINT::VARCHAR ELSE p_retailprice::DOUBLE::VARCHAR END || ',' || p_size || ',0]' AS text FROM part")
def canonical_numbers(spark, sf):
    """Numbers written in several ways come out in one: without trailing zeros, exponents within the usual range, or a minus before zero."""
    rows = read_table(spark, sf, "part", "p_partkey", "p_size", "p_retailprice")
    return _checked(rows, "p_partkey", F.expr("concat('[ ', cast(p_retailprice as decimal(18,2)), '00 , ', p_size, '0e-1, -0.0 ]')"), "text")


@query("SELECT count(*) FILTER (WHERE o_totalprice = floor(o_totalprice) AND o_totalprice BETWEEN 0 AND 9007199254740991) AS safe, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS texts FROM orders")
def safe_values(spark, sf):
    """How many totals are integers that a double holds exactly, and how many byte strings are UTF-8 (every other one is made not to be)."""
    rows = read_table(spark, sf, "orders", "o_orderkey", "o_totalprice")
    bytes_ = F.when(F.col("o_orderkey") % 2 == 0, F.encode(F.lit("é"), "UTF-8")).otherwise(F.unhex(F.lit("C3")))
    return rows.agg(F.count_if(columns.is_safe_integer(F.col("o_totalprice"))).alias("safe"), F.count_if(columns.is_utf8(bytes_)).alias("texts"))


# --- schemas -----------------------------------------------------------------------------------------------------------

_ERRORS = """
WITH e AS (
  SELECT id, '/status' AS instancePath, '#/properties/status/enum' AS schemaPath, 'enum' AS keyword, 'must be equal to one of the allowed values' AS message FROM reviews WHERE status NOT IN ('unreviewed', 'accepted', 'rejected', 'superseded')
  UNION ALL SELECT id, '/confidence', '#/properties/confidence/maximum', 'maximum', 'must be <= 1' FROM reviews WHERE confidence > 1
  UNION ALL SELECT id, '/confidence', '#/properties/confidence/minimum', 'minimum', 'must be >= 0' FROM reviews WHERE confidence < 0
  UNION ALL SELECT id, '', '#/required', 'required', 'must have required property ''status''' FROM reviews WHERE status IS NULL
  UNION ALL SELECT id, '', '#/allOf/0/if', 'if', 'must match "then" schema' FROM reviews WHERE status IN ('accepted', 'rejected', 'superseded') AND (reviewedAt IS NULL OR reviewerId IS NULL)
  UNION ALL SELECT id, '', '#/allOf/0/then/required', 'required', 'must have required property ''reviewedAt''' FROM reviews WHERE status IN ('accepted', 'rejected', 'superseded') AND reviewedAt IS NULL
  UNION ALL SELECT id, '', '#/allOf/0/then/required', 'required', 'must have required property ''reviewerId''' FROM reviews WHERE status IN ('accepted', 'rejected', 'superseded') AND reviewerId IS NULL
)
SELECT DISTINCT id, dense_rank() OVER (PARTITION BY id ORDER BY instancePath, schemaPath, keyword, message)::INT AS place, instancePath, schemaPath, keyword, message FROM e
"""


@query(_ERRORS)
def review_errors_in_order(spark, sf):
    """All four fields of the errors of every review, with their place in the order of errors."""
    rows = read_table(spark, sf, "reviews", "id", "status", "reviewedAt", "reviewerId", "confidence", "notes").distinct()
    schema = SchemaSet(catalogue_schemas.documents()).compile(catalogue_schemas.schema_id("review"))
    checked = with_validation(rows.select("id", F.parse_json(F.to_json(F.struct("*"))).alias("v")), schema)
    listed = checked.select("id", F.posexplode("errors").alias("place", "e"))
    return listed.select("id", (F.col("place") + 1).alias("place"), "e.*").distinct()


@query("SELECT 19::BIGINT AS schemas, true AS compile, true AS stable, 'UNKNOWN_SCHEMA_ID' AS unknown")
def schema_registry(spark, sf):
    """The registry: how many schemas it has, that all compile, that its fingerprint is the same in any order, and what an unknown id gives."""
    documents = list(catalogue_schemas.documents().values())
    first, second = SchemaSet(documents).compile_all(), SchemaSet(reversed(documents))
    try:
        first.compile("urn:seedloom:schema:v1:nothing")
        unknown = None
    except RuntimeError as error:
        unknown = error.code
    return spark.createDataFrame([(len(first.documents), True, first.fingerprint() == second.fingerprint(), unknown)], "schemas bigint, compile boolean, stable boolean, unknown string")


SUITE = Path(__file__).resolve().parent.parent / "sources" / "conformance" / "manifest.json"


@query("SELECT name, passed FROM (VALUES ('name-complete', true), ('name-without-language', true), ('review-bad-confidence', true), ('review-decided-without-reviewer', true), ('rule-two-targets', true), ('source-complete', true), ('source-unknown-schema', true)) t(name, passed)")
def conformance(spark, sf):
    """The cases of the conformance suite, and whether each gives what it expects."""
    return run_cases(spark, SchemaSet(catalogue_schemas.documents()), load_cases(SUITE)).select("name", "passed")


# --- artifacts and releases --------------------------------------------------------------------------------------------


@query("SELECT 36::BIGINT AS byteSize, 2::BIGINT AS entryCount, 'ace7c84639a46036fb0ad1892dcc2f86f7874fd11448920f2ca2ec0d237a97fe' AS sha256")
def gzip_golden(spark, sf):
    """Size and digest of a pinned input."""
    made = artifacts.compress(b'{"a":1}\n{"b":2}\n', 2)
    return spark.createDataFrame([(made.byte_size, made.entry_count, made.sha256)], "byteSize bigint, entryCount bigint, sha256 string")


#: Bytes of a chunk, so small that even little tables have several.
_CHUNK = 1 << 15


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    names = read_table(spark, sf, "localized_names", "id", "raw")
    return artifacts.gzip_chunks(names, "id", "raw", _CHUNK)


_LINES = f"SELECT id, raw, (sum(octet_length(encode(raw)) + 1) OVER (ORDER BY id) - octet_length(encode(raw)) - 1) // {_CHUNK} AS chunk FROM localized_names WHERE raw IS NOT NULL"


@query(f"SELECT chunk::BIGINT AS chunk, count(*) AS entryCount, sha256(string_agg(raw || chr(10), '' ORDER BY id)) AS sha256 FROM ({_LINES}) GROUP BY chunk")
def gzip_contents(spark, sf):
    """What every chunk of the names holds once it is unpacked: entries, and the digest of the lines."""

    def unpacked(batches):
        import hashlib
        import zlib

        import pyarrow as pa

        for batch in batches:
            digests = [hashlib.sha256(zlib.decompress(b.as_py(), 31)).hexdigest() for b in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.string())], ["chunk", "entryCount", "sha256"])

    return _chunks(spark, sf).select("chunk", "entryCount", "bytes").mapInArrow(unpacked, "chunk bigint, entryCount bigint, sha256 string")


def _damaged(spark: SparkSession, sf: str) -> DataFrame:
    """Problems of a release of which a quarter of the chunks is missing, a quarter cut off, and one file is not listed."""
    chunks = _chunks(spark, sf).withColumn("path", F.format_string("names-%05d.jsonl.gz", "chunk"))
    expected = chunks.select("path", "sha256", "byteSize", "entryCount", F.lit(True).alias("required"))
    cut = F.when(F.col("chunk") % 4 == 2, F.expr("substr(bytes, 1, length(bytes) - 4)")).otherwise(F.col("bytes"))
    files = chunks.where("chunk % 4 <> 1").select("path", cut.alias("content"))
    stray = spark.createDataFrame([("stray.txt", bytearray(b"x"))], "path string, content binary")
    return artifacts.verify(expected, files.unionByName(stray))


_PROBLEMS = f"""SELECT format('names-{{:05d}}.jsonl.gz', chunk) AS path, problem FROM (SELECT DISTINCT chunk::BIGINT AS chunk FROM ({_LINES})),
  (VALUES (1, 'missing'), (2, 'size'), (2, 'hash'), (2, 'entries')) p(rest, problem) WHERE chunk % 4 = rest UNION ALL SELECT 'stray.txt', 'extra'"""


@query(_PROBLEMS)
def release_problems(spark, sf):
    """Every problem of a damaged release."""
    return _damaged(spark, sf)


@query(f"SELECT count(*) = 0 AS activatable, string_agg(path || ': ' || problem, '; ' ORDER BY path || ': ' || problem) AS reasons FROM ({_PROBLEMS})")
def release_verdict(spark, sf):
    """A damaged release must not be activated, and why."""
    return artifacts.verdict(_damaged(spark, sf)).withColumn("reasons", F.array_join("reasons", "; "))


@query(f"SELECT count(DISTINCT chunk) AS files, count(*)::BIGINT AS entries, true AS activatable FROM ({_LINES})")
def written_release(spark, sf):
    """A release that is written by the executors, read again and verified: its files, their entries, and that it may be activated."""
    folder = f"{shared_folder(spark)}/release_{uuid.uuid4().hex}"
    manifest = artifacts.write_release(_chunks(spark, sf), folder, "names", catalogue_schemas.schema_id("localized-name"), {"releaseId": "1"})
    listed = [(a["path"], a["sha256"], a["byteSize"], a["entryCount"], True) for a in manifest["requiredArtifacts"]]
    expected = spark.createDataFrame(listed, "path string, sha256 string, byteSize bigint, entryCount bigint, required boolean")
    files = read_binary(spark, folder, "*.gz").withColumn("path", F.element_at(F.split("path", "/"), -1))
    verdict = artifacts.verdict(artifacts.verify(expected, files.select("path", "content"))).select("activatable")
    return expected.agg(F.count("*").alias("files"), F.sum("entryCount").alias("entries")).join(verdict)  # one row and one row


@query("SELECT count(*) AS files, sum(n)::BIGINT AS bytes, 1048576::BIGINT AS \"limit\", sum(n) <= 1048576 AS within FROM (SELECT sum(octet_length(encode(text))) AS n FROM documents WHERE text IS NOT NULL GROUP BY lang)")
def release_budget(spark, sf):
    """Whether the texts, one file per language, would stay within a mebibyte."""
    files = read_table(spark, sf, "documents", "lang", "text").where("text is not null").groupBy("lang").agg(F.sum(F.octet_length("text")).alias("byteSize"))
    return artifacts.size_budget(files, 1 << 20)


@query("SELECT count(*) AS records, true AS unique_lines, true AS contiguous, count(DISTINCT id) AS ids FROM localized_names WHERE raw IS NOT NULL")
def jsonl_round_trip(spark, sf):
    """Names written as gzip JSON Lines and read again with line numbers: each line has a number of its own, from 1 on in every file."""
    folder = f"{shared_folder(spark)}/jsonl_{uuid.uuid4().hex}"
    read_table(spark, sf, "localized_names", "raw").where("raw is not null").select(F.col("raw").alias("value")).write.option("compression", "gzip").option("lineSep", "\n").text(folder)
    lines = read_jsonl(spark, folder, line_numbers=True).select("file", "line", F.try_variant_get("v", "$.id", "string").alias("id"))
    files = lines.groupBy("file").agg(F.count("*").alias("n"), F.count_distinct("line").alias("lines"), F.min("line").alias("a"), F.max("line").alias("b"))
    checks = files.agg(F.sum("n").alias("records"), F.every(F.col("n") == F.col("lines")).alias("unique_lines"), F.every((F.col("a") == 1) & (F.col("b") == F.col("n"))).alias("contiguous"))
    return checks.join(lines.agg(F.count_distinct("id").alias("ids")))  # one row and one row


@query("SELECT DISTINCT sourceReleaseId, (split_part(sourceReleaseId, '.', 1)::INT, split_part(sourceReleaseId, '.', 2)::INT) >= (2021, 3) AS compatible, split_part(sourceReleaseId, '.', 1)::INT >= 2021 AND sourceReleaseId <> '2021.1' AND sourceReleaseId <> '2021.2' AND sourceReleaseId <> '2021.3' AS early FROM evidence_references WHERE sourceReleaseId IS NOT NULL")
def release_compatibility(spark, sf):
    """Releases whose version is at least a minimum; a release candidate of the minimum is below it."""
    rows = read_table(spark, sf, "evidence_references", "sourceReleaseId").where("sourceReleaseId is not null").distinct()
    version = F.concat("sourceReleaseId", F.lit(".0"))
    least = F.lit("2021.3.0")
    return rows.select("sourceReleaseId", columns.is_compatible(version, least).alias("compatible"), columns.is_compatible(F.concat(version, F.lit("-rc.1")), least).alias("early"))


# --- calendar ----------------------------------------------------------------------------------------------------------

_MONTHS = "timing.start.month BETWEEN 1 AND 12 AND timing.\"end\".month BETWEEN 1 AND 12"


@query(f"SELECT DISTINCT id, CASE WHEN {_MONTHS} THEN format('{{:02d}}-01', timing.start.month) END AS starts, CASE WHEN {_MONTHS} THEN format('{{:02d}}-{{:02d}}', timing.\"end\".month, day(last_day(make_date(2024, timing.\"end\".month::BIGINT, 1)))) END AS ends FROM cultivation_rules WHERE timing.start.month IS NOT NULL AND timing.\"end\".month IS NOT NULL".replace("make_date(2024, timing.\"end\".month::BIGINT, 1)", "make_date(2024, least(12, greatest(1, timing.\"end\".month))::BIGINT, 1)"))
def month_windows(spark, sf):
    """Advice given in months as a window of month and day; NULL for impossible months."""
    rules = read_table(spark, sf, "cultivation_rules", "id", "timing").where("timing.start.month is not null and timing.end.month is not null")
    window = columns.month_window(F.col("timing.start.month"), F.col("timing.end.month"))
    return rules.select("id", window["start"].alias("starts"), window["end"].alias("ends")).distinct()


@query("SELECT month(o_orderdate)::INT AS month, count(*) AS orders, count(*) FILTER (WHERE strftime(o_orderdate, '%m-%d') >= '11-15' OR strftime(o_orderdate, '%m-%d') <= '02-10') AS winter, count(*) FILTER (WHERE strftime(o_orderdate, '%m-%d') BETWEEN '05-20' AND '06-05') AS spring FROM orders GROUP BY 1")
def orders_in_season(spark, sf):
    """Orders by month that lie in a window over the turn of the year and in one within it."""
    day = F.col("o_orderdate").cast("date")
    inside = lambda a, b: F.count_if(columns.in_month_day_window(day, F.lit(a), F.lit(b)))
    return read_table(spark, sf, "orders", "o_orderdate").groupBy(F.month(day).alias("month")).agg(F.count("*").alias("orders"), inside("11-15", "02-10").alias("winter"), inside("05-20", "06-05").alias("spring"))


@query("SELECT DISTINCT id, a + timing.startOffsetDays::INT AS starts, a + timing.endOffsetDays::INT AS ends FROM (SELECT id, timing, CASE timing.anchor WHEN 'last_spring_frost' THEN DATE '2024-05-11' WHEN 'first_autumn_frost' THEN DATE '2024-10-20' END AS a FROM cultivation_rules WHERE timing.type = 'relative-day-window')")
def relative_windows(spark, sf):
    """Relative windows as dates, from the dates of the anchors; NULL where an anchor or offset isn't known."""
    rules = read_table(spark, sf, "cultivation_rules", "id", "timing").where("timing.type = 'relative-day-window'")
    anchor = F.when(F.col("timing.anchor") == "last_spring_frost", F.lit("2024-05-11")).when(F.col("timing.anchor") == "first_autumn_frost", F.lit("2024-10-20")).cast("date")
    window = columns.window_dates(anchor, F.col("timing.startOffsetDays"), F.col("timing.endOffsetDays"))
    return rules.select("id", window["start"].alias("starts"), window["end"].alias("ends")).distinct()


# --- reports -----------------------------------------------------------------------------------------------------------

_SPELLED = "regexp_replace(lower(predicate), '[\\s _-]', '', 'g')"
_COVERED = f"""
WITH p AS (SELECT DISTINCT id FROM plant_concepts WHERE id IS NOT NULL), n AS (SELECT count(*) AS n FROM p),
own AS (SELECT DISTINCT subjectId AS id, {_SPELLED} AS predicate FROM assertions WHERE subjectType = 'plant-concept'),
r AS (SELECT DISTINCT r.plantConceptId AS id, r.action, c.growingSystem FROM cultivation_rules r LEFT JOIN cultivation_contexts c ON c.id = r.contextId WHERE r.plantConceptId IS NOT NULL),
v AS (SELECT subjectId AS id FROM assertions WHERE subjectType = 'plant-concept' AND subjectId IS NOT NULL GROUP BY subjectId, {_SPELLED}, context HAVING count(DISTINCT value) > 1),
e AS (SELECT DISTINCT a.subjectId AS id, x.sourceId FROM (SELECT subjectId, unnest(evidenceReferenceIds) AS r FROM assertions WHERE subjectType = 'plant-concept') a JOIN evidence_references x ON x.id = a.r WHERE x.sourceId IS NOT NULL),
m AS (
  SELECT 'accepted identity' AS metric, id FROM plant_concepts WHERE status = 'active' AND taxonId IS NOT NULL
  UNION SELECT 'cold sensitivity', id FROM own WHERE predicate = 'coldresponse'
  UNION SELECT 'contradicting assertions', id FROM v
  UNION SELECT 'evidence from source ' || sourceId, id FROM e
  UNION SELECT 'geographic context', subjectId FROM assertions WHERE subjectType = 'plant-concept' AND list_count(context.geographicContextIds) > 0
  UNION SELECT 'name in ' || t, s FROM (SELECT subjectId AS s, CASE WHEN lower(languageTag) LIKE 'fr%' THEN 'fr' WHEN lower(languageTag) LIKE 'en%' THEN 'en' END AS t FROM localized_names WHERE preferred) WHERE t IS NOT NULL
  UNION SELECT 'planting rule', id FROM r WHERE action IN ('transplant', 'direct_sow', 'plant_now')
  UNION SELECT 'rule for ' || growingSystem, id FROM r WHERE growingSystem IS NOT NULL
)
SELECT metric, count(DISTINCT m.id) AS covered, any_value(n.n) AS denominator FROM m JOIN p ON p.id = m.id CROSS JOIN n GROUP BY metric
"""


@query(_COVERED)
def plant_coverage(spark, sf):
    """Plants that each part of the coverage report counts, of all plants: identity, names, cold, rules by system, contradictions, sources, places."""
    plants = read_table(spark, sf, "plant_concepts", "id", "status", "taxonId")
    said = read_table(spark, sf, "assertions", "subjectType", "subjectId", "predicate", "value", "context", "evidenceReferenceIds").where("subjectType = 'plant-concept'").withColumn("predicate", spelling(F.col("predicate")))
    rules = read_table(spark, sf, "cultivation_rules", "plantConceptId", "contextId", "action").join(read_table(spark, sf, "cultivation_contexts", F.col("id").alias("contextId"), "growingSystem"), "contextId", "left")
    names = read_table(spark, sf, "localized_names", "subjectId", "languageTag", "preferred").where("preferred")
    tag = F.lower("languageTag")
    evidence = read_table(spark, sf, "evidence_references", F.col("id").alias("r"), "sourceId").distinct()
    metric = lambda df, name, id="subjectId": df.select((F.lit(name) if isinstance(name, str) else name).alias("metric"), F.col(id).alias("id"))
    parts = [
        metric(plants.where("status = 'active' and taxonId is not null"), "accepted identity", "id"),
        metric(said.where("predicate = 'coldresponse'"), "cold sensitivity"),
        metric(reports.contradictions(said, ["subjectId", "predicate", "context"], F.col("value")), "contradicting assertions"),
        metric(said.select("subjectId", F.explode("evidenceReferenceIds").alias("r")).join(evidence, "r"), F.concat(F.lit("evidence from source "), "sourceId")),
        metric(said.where(F.size(F.array_compact("context.geographicContextIds")) > 0), "geographic context"),
        metric(names, F.concat(F.lit("name in "), F.when(tag.startswith("fr"), "fr").when(tag.startswith("en"), "en"))),
        metric(rules.where(F.col("action").isin("transplant", "direct_sow", "plant_now")), "planting rule", "plantConceptId"),
        metric(rules, F.concat(F.lit("rule for "), "growingSystem"), "plantConceptId"),
    ]
    return reports.coverage_of(plants.select("id").where("id is not null").distinct(), reduce(DataFrame.unionByName, parts), "id")


_NOTICES = """
SELECT u.sourceId, s.name, s.publisher, s.homepage, u.release, u.licenceId, count(DISTINCT u.id) AS records FROM (
  SELECT DISTINCT e.sourceId, e.sourceReleaseId AS release, e.rights.licenceId AS licenceId, e.id FROM evidence_references e JOIN (SELECT DISTINCT unnest(evidenceReferenceIds) AS id FROM assertions) a ON a.id = e.id WHERE e.sourceId IS NOT NULL) u
LEFT JOIN (SELECT id, name, publisher, homepage FROM sources WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY received_at) = 1) s ON s.id = u.sourceId GROUP BY ALL
"""


@query(_NOTICES)
def attribution_notices(spark, sf):
    """A notice per source, release and licence of evidence that an assertion uses: who is to be named, and for how many records."""
    return _notices(spark, sf)


def _notices(spark, sf) -> DataFrame:
    used = read_table(spark, sf, "assertions", "evidenceReferenceIds").select(F.explode("evidenceReferenceIds").alias("id")).distinct()
    evidence = read_table(spark, sf, "evidence_references", "id", "sourceId", "sourceReleaseId", "rights")
    sources = read_table(spark, sf, "sources", "id", "name", "publisher", "homepage", "received_at")
    return reports.notices(evidence.select("id", "sourceId", F.col("sourceReleaseId").alias("release"), F.col("rights.licenceId").alias("licenceId")), used, reports.best_of(sources, ["id"], [F.col("received_at")], ["name", "publisher", "homepage"]))


_NAMED = "coalesce(name, sourceId) || coalesce(', ' || publisher, '') || coalesce(', release ' || release, '') || coalesce(', ' || homepage, '') || '. Licence: ' || coalesce(licenceId, 'unknown') || '. Records: ' || records"


@query(f"SELECT row_number() OVER (ORDER BY line) AS position, line FROM (SELECT {_NAMED} AS line FROM ({_NOTICES}))")
def attribution_page(spark, sf):
    """The page of attributions, line by line."""
    return numbered(_notices(spark, sf).select(reports.notice_line().alias("line")), ["line"])
