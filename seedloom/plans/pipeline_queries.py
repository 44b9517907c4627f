"""Queries of the general training-data operators over the whole catalogue tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.operators.intervals import circular_periods_and_gaps, periods_and_gaps
from seedloom.operators.nested_tables import flat_paths
from seedloom.operators.orphans import orphan_state, parent_rows, periodic_counts, referring_rows
from seedloom.operators.snapshot_diff import MOST_SNAPSHOTS, KeptSnapshots, snapshot_changes
from seedloom.operators.wide_table import filled_cells, typed_values, wide_table
from seedloom.sources.tables import read_table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Filled cells of the wide table of assertions."""
    return filled_cells(p1_wide(spark, sf))


def p1_wide(spark: SparkSession, sf: str) -> DataFrame:
    """One row per subject, one typed column per predicate of the registry."""
    assertions = read_table(spark, sf, "assertions", "id", "subjectId", "predicate", "value", "received_at")
    return wide_table(assertions, read_table(spark, sf, "predicate_registry"), order=("received_at", "id"))


def p1_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The typed value of every filled cell, a column for each kind of value; records by the number of their members."""
    return typed_values(p1_wide(spark, sf), read_table(spark, sf, "predicate_registry"))


def p3_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Typed changes of both snapshot tables, with the columns that differ."""
    parts = []
    for name, json_columns in (("plant_concept_snapshots", ()), ("assertion_snapshots", ("value",))):
        changes = snapshot_changes(read_table(spark, sf, name), json_columns=json_columns)
        parts.append(changes.select(F.lit(name).alias("table_name"), F.date_format("snapshot", "yyyy-MM-dd").alias("snapshot_date"), "id", "change", "columns"))
    return parts[0].unionByName(parts[1])


def p3_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of plants as the snapshots come one by one: each is kept, partitioned and sorted, and compared with the one before it alone."""
    rows = read_table(spark, sf, "plant_concept_snapshots")
    dates = [r.d for r in rows.select(F.col("snapshot_date").alias("d")).where("d is not null").distinct().orderBy("d").limit(MOST_SNAPSHOTS + 1).collect()]
    if len(dates) > MOST_SNAPSHOTS:
        raise ValueError(f"more than {MOST_SNAPSHOTS} snapshots")
    kept, parts = KeptSnapshots(spark), []
    for day in dates:
        kept.add(rows.where(F.col("snapshot_date") == F.lit(day)).drop("snapshot_date"), day)
        parts.append(kept.changes().select(F.date_format("snapshot", "yyyy-MM-dd").alias("snapshot_date"), "id", "change"))
    return reduce(DataFrame.unionByName, parts)


def p3_columns(spark: SparkSession, sf: str) -> DataFrame:
    """How many records changed in each column, per table and snapshot."""
    changes = p3_changes(spark, sf).where("change = 'changed'").select("table_name", "snapshot_date", F.explode("columns").alias("column"))
    return changes.groupBy("table_name", "snapshot_date", "column").agg(F.count("*").alias("records"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Record, later snapshot date and type of every change."""
    return p3_changes(spark, sf).drop("columns")


def _references(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All references of the catalogue and all rows that they may name."""
    # Reference fields and the tables they name.
    fields = {
        "assertions": {"evidenceReferenceIds": "evidence_references", "reviewId": "reviews"},
        "cultivation_rules": {"plantConceptId": "plant_concepts"},
        "evidence_references": {"sourceId": "sources"},
    }
    references = parents = None
    for table, named in fields.items():
        rows = referring_rows(read_table(spark, sf, table), table, named)
        references = rows if references is None else references.unionByName(rows)
    for table in sorted({t for named in fields.values() for t in named.values()}):
        rows = parent_rows(read_table(spark, sf, table), table)
        parents = rows if parents is None else parents.unionByName(rows)
    return references, parents


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every open reference with its month and reason."""
    return orphan_state(*_references(spark, sf)).open_references().select("table_name", "field", "id", "ref_id", "period", "reason")


def p4_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Open references per table, field, month and reason as they stood at the start of every year, deletions at their own time."""
    references, parents = _references(spark, sf)
    times = references.select(F.col("received_at").alias("t")).unionByName(parents.select(F.col("parent_received_at").alias("t"))).unionByName(parents.select(F.col("deleted_at").alias("t")))
    last = times.agg(F.min(F.year("t")).alias("a"), F.max(F.year("t")).alias("b")).first()
    return periodic_counts(references, parents, [dt.datetime(y, 1, 1) for y in range(last.a + 1, last.b + 2)])


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """Continuous periods and gaps of the calendar windows per plant and context, on the circle of months."""
    rules = read_table(spark, sf, "cultivation_rules")
    rules = rules.where("plantConceptId is not null and contextId is not null and timing.type = 'calendar-date-window'")
    rules = rules.select("plantConceptId", "contextId", F.col("timing.start.month").alias("s"), F.col("timing.end.month").alias("e"))
    found = circular_periods_and_gaps(rules, ["plantConceptId", "contextId"], "s", "e", 1, 12)
    return found.select("plantConceptId", "contextId", "kind", F.col("start").alias("start_month"), F.col("end").alias("end_month"))


def p5_shipping(spark: SparkSession, sf: str) -> DataFrame:
    """Continuous periods in which a supplier had parts on their way, taken to take a day for each line number, and the gaps between them, in days since
    1970; the line is cut into years.
    """
    items = read_table(spark, sf, "lineitem", "l_suppkey", "l_shipdate", "l_linenumber")
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    rows = items.select("l_suppkey", day.alias("s"), (day + F.col("l_linenumber")).alias("e"))
    return periods_and_gaps(rows, ["l_suppkey"], "s", "e", bucket=365)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of the flat child tables by its parent and path."""
    assertions = read_table(spark, sf, "assertions", "id", "value", "context")
    return flat_paths(assertions, read_table(spark, sf, "evidence_references", "id", "rights"))


QUERIES = {f.__name__: f for f in (p1_found, p1_wide, p1_cells, p3_found, p3_changes, p3_columns, p3_kept, p4_found, p4_counts, p5_found, p5_shipping, p7_found)}
