"""DuckDB SQL that the general training-data queries are held against, written without regard to how the operators work."""

from __future__ import annotations

_SPELL = "regexp_replace(lower({}), '[\\s _-]', '', 'g')"

# p1: the JSON value is unwrapped, then each type has its own test.
_P1_CHECKED = f"""
WITH names AS (
  SELECT predicate AS name, value_type, unnest(list_append(coalesce(aliases, []), predicate)) AS alias FROM predicate_registry
), typed AS (
  SELECT a.subjectId, n.name, n.value_type, a.received_at, a.id, a.value AS written, CASE WHEN json_valid(a.value) THEN a.value::JSON END AS j0
  FROM assertions a JOIN (SELECT DISTINCT name, value_type, {_SPELL.format('alias')} AS key FROM names) n ON {_SPELL.format('a.predicate')} = n.key
  WHERE a.subjectId IS NOT NULL AND a.value IS NOT NULL
), unwrapped AS (
  SELECT *, CASE WHEN json_type(j0) = 'VARCHAR' AND json_valid(j0->>'$') AND json_type((j0->>'$')::JSON) IN ('OBJECT', 'ARRAY') THEN (j0->>'$')::JSON ELSE j0 END AS j1 FROM typed WHERE j0 IS NOT NULL
), core AS (
  SELECT *, CASE WHEN value_type <> 'record' AND json_type(j1) = 'OBJECT' AND json_exists(j1, '$.value') THEN j1->'$.value' ELSE j1 END AS j FROM unwrapped
), said AS (
  SELECT *, json_type(j) AS kind, trim(j->>'$') AS s FROM core
), checked AS (
  SELECT *, kind IN ('VARCHAR') AND lower(s) IN ('', '-', '--', '?', 'n/a', 'na', 'no data', 'none given', 'not known', 'not given', 'not recorded', 'unknown', 'null') AS nothing,
    CASE WHEN kind IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR', 'HUGEINT') THEN TRY_CAST(replace(regexp_extract(s, '^([+-]?[0-9]+(?:[.,][0-9]+)?(?:[eE][+-]?[0-9]+)?)\\s*(?:[%°µ\\p{{L}}][\\p{{L}}/]*)?$', 1), ',', '.') AS DOUBLE) END AS number
  FROM said
)
"""
_FILLS = """WHERE NOT nothing AND CASE value_type
  WHEN 'number' THEN number IS NOT NULL
  WHEN 'integer' THEN number IS NOT NULL AND number = floor(number)
  WHEN 'boolean' THEN kind = 'BOOLEAN' OR (kind = 'VARCHAR' AND lower(s) IN ('y', 'n', 'yes', 'no', 'true', 'false', 't', 'f'))
  WHEN 'text' THEN kind = 'VARCHAR'
  WHEN 'range' THEN (kind = 'OBJECT' AND (j->>'$.min' IS NOT NULL OR j->>'$.max' IS NOT NULL)) OR (kind = 'ARRAY' AND json_array_length(j) > 0 AND TRY_CAST(j->>'$[0]' AS DOUBLE) IS NOT NULL)
    OR (kind = 'VARCHAR' AND regexp_matches(s, '^[+-]?[0-9]+(?:[.,][0-9]+)?\\s*(?:-|–|—|to)\\s*[+-]?[0-9]+(?:[.,][0-9]+)?\\s*\\p{L}*$'))
  WHEN 'window' THEN (kind = 'OBJECT' AND (regexp_matches(coalesce(j->>'$.from', ''), '^[0-9]{1,2}-[0-9]{1,2}$') OR json_type(j, '$.start.month') IN ('BIGINT', 'UBIGINT')))
    OR (kind = 'VARCHAR' AND regexp_matches(s, '^[0-9]{1,2}-[0-9]{1,2}/[0-9]{1,2}-[0-9]{1,2}$'))
  WHEN 'record' THEN (kind = 'OBJECT' AND len(json_keys(j)) > 0) OR (kind = 'ARRAY' AND json_array_length(j) > 0)
END"""
_P1 = f"{_P1_CHECKED} SELECT DISTINCT subjectId, name AS predicate FROM checked {_FILLS}"

# The value of each cell: that of the first filling assertion, by kind of value; records by the number of their members.
_AMOUNT = "TRY_CAST(replace(regexp_extract({}, '^([+-]?[0-9]+(?:[.,][0-9]+)?)\\s*\\p{{L}}*$', 1), ',', '.') AS DOUBLE)"
_SPAN = "TRY_CAST(replace(regexp_extract(s, '^([+-]?[0-9]+(?:[.,][0-9]+)?)\\s*(?:-|–|—|to)\\s*([+-]?[0-9]+(?:[.,][0-9]+)?)\\s*\\p{{L}}*$', {}), ',', '.') AS DOUBLE)"
_DAY = "lpad({}, 2, '0') || '-' || lpad({}, 2, '0')"


def _split(text: str) -> str:
    """SQL for MM-DD of text like 3-1."""
    return _DAY.format(f"split_part({text}, '-', 1)", f"split_part({text}, '-', 2)")


def _edge(first: str, second: str, group: int) -> str:
    """SQL for MM-DD of an edge of a window: an object's text or month and day, or part of a text."""
    said = f"(j->>'$.{first}')"
    parts = _DAY.format(f"(j->>'$.{second}.month')", f"(j->>'$.{second}.day')")
    return f"CASE WHEN kind = 'OBJECT' AND {said} IS NOT NULL THEN {_split(said)} WHEN kind = 'OBJECT' THEN {parts} ELSE {_split(f'''split_part(s, '/', {group})''')} END"


def _bound(member: str, place: int) -> str:
    """SQL for a bound of a range: an object's member, an element of a list, or part of a text."""
    said, element = f"(j->>'$.{member}')", f"(j->>'$[{place}]')"
    return f"CASE kind WHEN 'OBJECT' THEN {_AMOUNT.format(said)} WHEN 'ARRAY' THEN {_AMOUNT.format(element)} ELSE {_SPAN.format(place + 1)} END"


_P1_CELLS = f"""{_P1_CHECKED} SELECT subjectId, name AS predicate,
  CASE WHEN value_type = 'number' THEN number END AS number, CASE WHEN value_type = 'integer' THEN number::BIGINT END AS whole,
  CASE WHEN value_type = 'boolean' THEN lower(s) IN ('y', 'yes', 'true', 't') END AS flag, CASE WHEN value_type = 'text' THEN s END AS said,
  CASE WHEN value_type = 'range' THEN {_bound('min', 0)} END AS low, CASE WHEN value_type = 'range' THEN {_bound('max', 1)} END AS high,
  CASE WHEN value_type = 'window' THEN {_edge('from', 'start', 1)} END AS begins, CASE WHEN value_type = 'window' THEN {_edge('to', 'end', 2)} END AS ends,
  CASE WHEN value_type = 'record' THEN CASE kind WHEN 'OBJECT' THEN len(json_keys(j)) ELSE json_array_length(j) END END::BIGINT AS members
FROM checked {_FILLS} QUALIFY row_number() OVER (PARTITION BY subjectId, name ORDER BY received_at NULLS FIRST, id NULLS FIRST, written) = 1"""


def _changes(table: str, columns: str) -> str:
    return f"""
    SELECT '{table}' AS table_name, strftime(coalesce(b.day, a.following), '%Y-%m-%d') AS snapshot_date, coalesce(a.id, b.id) AS id,
      CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'removed' ELSE 'changed' END AS change
    FROM (SELECT s.*, d.following FROM s_{table} s JOIN d_{table} d ON s.day = d.day WHERE d.following IS NOT NULL) a
    FULL JOIN (SELECT s.*, d.previous FROM s_{table} s JOIN d_{table} d ON s.day = d.day WHERE d.previous IS NOT NULL) b ON a.id = b.id AND a.following = b.day
    WHERE a.id IS NULL OR b.id IS NULL OR a.content <> b.content"""


def _snapshots(table: str, columns: str) -> str:
    return f"""
    s_{table} AS (SELECT snapshot_date AS day, id, max({columns}) AS content FROM {table} WHERE id IS NOT NULL AND snapshot_date IS NOT NULL GROUP BY ALL),
    d_{table} AS (SELECT day, lead(day) OVER (ORDER BY day) AS following, lag(day) OVER (ORDER BY day) AS previous FROM (SELECT DISTINCT day FROM s_{table}))"""


# One JSON text with members in order: the leaves of the value, by path, are what it holds.
_CANONICAL = "CASE WHEN json_valid(value) THEN (SELECT string_agg(t.fullkey || '=' || coalesce(t.atom::VARCHAR, t.type), ';' ORDER BY t.fullkey, t.type) FROM json_tree(value::JSON) t) ELSE value END"
_IDS = "coalesce(array_to_string(list_sort(evidenceReferenceIds), ','), '?')"
_PLANTS = f"concat_ws('|', coalesce(status, '?'), coalesce(taxonId, '?'), coalesce(replacementPlantConceptId, '?'), {_IDS})"
_ASSERTED = f"concat_ws('|', coalesce(subjectType, '?'), coalesce(subjectId, '?'), coalesce(predicate, '?'), coalesce(value_text, '?'), {_IDS}, coalesce(reviewId, '?'))"
_P3 = f"""
WITH {_snapshots('plant_concept_snapshots', _PLANTS)},
 assertion_rows AS (SELECT * EXCLUDE (value), {_CANONICAL} AS value_text FROM assertion_snapshots),
 {_snapshots('assertion_snapshots', _ASSERTED).replace('FROM assertion_snapshots WHERE', 'FROM assertion_rows WHERE')}
{_changes('plant_concept_snapshots', '')} UNION ALL {_changes('assertion_snapshots', '')}
"""

_FIRST = "(SELECT * FROM {} QUALIFY row_number() OVER (PARTITION BY id ORDER BY received_at) = 1)"


def _orphans(table: str, field: str, target: str, reference: str) -> str:
    return f"""
    SELECT DISTINCT '{table}' AS table_name, '{field}' AS field, a.id, a.ref_id, strftime(a.received_at, '%Y-%m') AS period,
      CASE WHEN p.id IS NULL THEN 'missing' WHEN p.deleted_at IS NOT NULL THEN 'deleted' ELSE 'late' END AS reason
    FROM (SELECT id, received_at, {reference} AS ref_id FROM {_FIRST.format(table)}) a LEFT JOIN {_FIRST.format(target)} p ON p.id = a.ref_id
    WHERE a.ref_id IS NOT NULL AND (p.id IS NULL OR p.deleted_at IS NOT NULL OR p.received_at > a.received_at)"""


_P4_EDGES = [
    ("assertions", "evidenceReferenceIds", "evidence_references", "unnest(evidenceReferenceIds)"),
    ("assertions", "reviewId", "reviews", "reviewId"),
    ("cultivation_rules", "plantConceptId", "plant_concepts", "plantConceptId"),
    ("evidence_references", "sourceId", "sources", "sourceId"),
]
_P4 = " UNION ALL ".join(_orphans(*e) for e in _P4_EDGES)


def _as_of(table: str, field: str, target: str, reference: str) -> str:
    return f"""
    SELECT y.t, '{table}' AS table_name, '{field}' AS field, strftime(a.received_at, '%Y-%m') AS period,
      CASE WHEN p.id IS NULL OR p.received_at >= y.t THEN 'missing' WHEN p.deleted_at < y.t THEN 'deleted' WHEN p.received_at > a.received_at THEN 'late' END AS reason, a.id, a.ref_id
    FROM years y JOIN (SELECT DISTINCT id, received_at, {reference} AS ref_id FROM {_FIRST.format(table)}) a ON a.received_at < y.t LEFT JOIN {_FIRST.format(target)} p ON p.id = a.ref_id
    WHERE a.ref_id IS NOT NULL"""


_TIMES = " UNION ALL ".join(
    [f"SELECT received_at AS t FROM {t}" for t in ("assertions", "cultivation_rules", "evidence_references", "reviews", "plant_concepts", "sources")]
    + [f"SELECT deleted_at FROM {t}" for t in ("evidence_references", "reviews", "plant_concepts", "sources")]
)
_P4_COUNTS = f"""
WITH years AS (SELECT make_timestamp(y, 1, 1, 0, 0, 0) AS t FROM (SELECT unnest(range(min(year(t)) + 1, max(year(t)) + 2)) AS y FROM ({_TIMES})))
SELECT strftime(t, '%Y-%m-%d') AS as_of, table_name, field, period, reason, count(*) AS open_references FROM ({" UNION ALL ".join(_as_of(*e) for e in _P4_EDGES)}) WHERE reason IS NOT NULL GROUP BY ALL
"""

# p5: months are marked one by one; a run starts where the month before isn't in the same state.
_P5 = """
WITH r AS (
  SELECT DISTINCT plantConceptId, contextId, timing.start.month AS s, timing."end".month AS e FROM cultivation_rules
  WHERE plantConceptId IS NOT NULL AND contextId IS NOT NULL AND timing.type = 'calendar-date-window' AND timing.start.month BETWEEN 1 AND 12 AND timing."end".month BETWEEN 1 AND 12
), months AS (
  SELECT plantConceptId, contextId, m, max(CASE WHEN s <= e THEN m BETWEEN s AND e ELSE m >= s OR m <= e END) AS on_
  FROM r, range(1, 13) t(m) GROUP BY ALL
), k AS (SELECT plantConceptId, contextId, m, on_, sum(on_::INT) OVER (PARTITION BY plantConceptId, contextId) AS n FROM months
), starts AS (SELECT a.* FROM k a JOIN k b ON a.plantConceptId = b.plantConceptId AND a.contextId = b.contextId AND b.m = (a.m + 10) % 12 + 1 WHERE a.on_ <> b.on_
), ends AS (SELECT a.* FROM k a JOIN k b ON a.plantConceptId = b.plantConceptId AND a.contextId = b.contextId AND b.m = a.m % 12 + 1 WHERE a.on_ <> b.on_)
SELECT plantConceptId, contextId, CASE WHEN on_ THEN 'period' ELSE 'gap' END AS kind, m::INT AS start_month,
  (SELECT arg_min(e.m, (e.m - starts.m + 12) % 12) FROM ends e WHERE e.plantConceptId = starts.plantConceptId AND e.contextId = starts.contextId AND e.on_ = starts.on_)::INT AS end_month
FROM starts UNION ALL SELECT DISTINCT plantConceptId, contextId, 'period', 1, 12 FROM k WHERE n = 12
"""

# p7: a recursive walk over the JSON values.
_P7 = """
WITH RECURSIVE walk AS (
  SELECT id, 'value' AS path, false AS element, value::JSON AS v FROM (SELECT DISTINCT id, value FROM assertions WHERE json_valid(value))
  UNION ALL
  SELECT id, path || c.suffix, c.element, c.v FROM (
    SELECT id, path, unnest(CASE json_type(v)
      WHEN 'ARRAY' THEN list_transform(range(0, json_array_length(v)::BIGINT), lambda i: {suffix: '[' || i || ']', element: true, v: v->('$[' || i || ']')})
      WHEN 'OBJECT' THEN list_transform(json_keys(v), lambda k: {suffix: '.' || k, element: false, v: v->('$."' || k || '"')})
      WHEN 'VARCHAR' THEN CASE WHEN json_valid(v->>'$') AND json_type((v->>'$')::JSON) IN ('OBJECT', 'ARRAY') THEN [{suffix: '', element: element, v: (v->>'$')::JSON}] END
    END) AS c, element FROM walk)
)
SELECT DISTINCT 'assertions' AS table_name, id, path FROM walk WHERE element AND json_type(v) = 'OBJECT'
UNION ALL SELECT DISTINCT 'assertions', id, 'context.geographicContextIds[' || (i - 1) || ']' FROM (SELECT id, context.geographicContextIds AS g, unnest(range(1, len(context.geographicContextIds) + 1)) AS i FROM assertions) WHERE g[i] IS NOT NULL
UNION ALL SELECT DISTINCT 'evidence_references', id, 'rights.licenceId' FROM evidence_references WHERE rights.licenceId IS NOT NULL
"""



def _columns(table: str, contents: dict[str, str], rows: str) -> str:
    """Columns in which a record differs from the snapshot before; one row of a record in a snapshot is as good as another."""
    listed = ", ".join(f"any_value(coalesce({sql}, '?')) AS {c}" for c, sql in contents.items())
    pairs = " UNION ALL ".join(f"SELECT day, '{c}' AS \"column\" FROM pairs_{table} WHERE a_{c} <> {c}" for c in contents)
    return f"""
    SELECT '{table}' AS table_name, strftime(day, '%Y-%m-%d') AS snapshot_date, "column", count(*) AS records FROM (
      WITH one AS (SELECT snapshot_date AS day, id, {listed} FROM {rows} WHERE id IS NOT NULL GROUP BY ALL),
      days AS (SELECT day, lag(day) OVER (ORDER BY day) AS previous FROM (SELECT DISTINCT day FROM one)),
      pairs_{table} AS (SELECT b.*, {", ".join(f"a.{c} AS a_{c}" for c in contents)} FROM one b JOIN days d ON d.day = b.day JOIN one a ON a.day = d.previous AND a.id = b.id)
      {pairs}) GROUP BY ALL"""


_P3_COLUMNS = " UNION ALL ".join(
    [
        _columns("plant_concept_snapshots", {"status": "status", "taxonId": "taxonId", "replacementPlantConceptId": "replacementPlantConceptId", "evidenceReferenceIds": _IDS}, "plant_concept_snapshots"),
        _columns("assertion_snapshots", {"subjectType": "subjectType", "subjectId": "subjectId", "predicate": "predicate", "value": "value_text", "evidenceReferenceIds": _IDS, "reviewId": "reviewId"}, f"(SELECT * EXCLUDE (value), {_CANONICAL} AS value_text FROM assertion_snapshots)"),
    ]
)
_P5_SHIPPING = """
WITH i AS (SELECT DISTINCT l_suppkey, (l_shipdate::DATE - DATE '1970-01-01')::BIGINT AS s, (l_shipdate::DATE - DATE '1970-01-01')::BIGINT + l_linenumber AS e FROM lineitem),
m AS (SELECT *, max(e) OVER (PARTITION BY l_suppkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM i),
n AS (SELECT *, sum((before IS NULL OR s > before + 1)::INT) OVER (PARTITION BY l_suppkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM m),
p AS (SELECT l_suppkey, run, min(s) AS s, max(e) AS e FROM n GROUP BY ALL)
SELECT l_suppkey, 'period' AS kind, s AS start, e AS "end" FROM p
UNION ALL SELECT l_suppkey, 'gap', e + 1, following - 1 FROM (SELECT l_suppkey, e, lead(s) OVER (PARTITION BY l_suppkey ORDER BY s) AS following FROM p) WHERE following IS NOT NULL
"""

SQL = {
    "p3_columns": _P3_COLUMNS,
    "p3_kept": f"SELECT snapshot_date, id, change FROM ({_P3}) WHERE table_name = 'plant_concept_snapshots'",
    "p5_shipping": _P5_SHIPPING,
    "p1_found": _P1,
    "p1_cells": _P1_CELLS,
    "p3_found": _P3,
    "p4_found": _P4,
    "p4_counts": _P4_COUNTS,
    "p5_found": _P5,
    "p7_found": _P7,
}
