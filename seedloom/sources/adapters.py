"""Adapters: rows of a pinned source release as assertions that keep where and how they were said."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mapping:
    """How one column of a release becomes a predicate: its unit, and whether its original spelling is kept."""

    predicate: str
    column: str
    unit: str | None = None
    original: str | None = None


@dataclass(frozen=True)
class Release:
    """A pinned release of a source, and the rights its records come with."""

    source_id: str
    manifest_id: str
    release_id: str
    licence_id: str


ASSERTION = ["id", "subjectType", "subjectId", "predicate", "value", "normalization", "evidenceReferenceIds"]


def to_assertions(rows: DataFrame, release: Release, subject_type: str, subject: Column, record: Column, locator: Column, mappings: list[Mapping]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(assertions, evidence, rejected) of a release's rows.

    ``value`` is JSON text; a NULL cell makes no assertion. Ids follow from source, release, record and predicate, so the same
    release gives the same ids. Rows without subject, record or locator are rejected with the reason and make nothing: an
    adapter fails closed. Columns that a mapping names have to be there.
    """
    missing = sorted({c for m in mappings for c in (m.column, m.original) if c and c not in rows.columns})
    if missing:
        raise ValueError(f"the release has no columns {', '.join(missing)}")
    named = rows.withColumns({"__subject": subject.cast("string"), "__record": record.cast("string"), "__locator": locator.cast("string")})
    reason = F.when(F.coalesce(F.col("__subject"), F.lit("")) == "", "no subject").when(F.coalesce(F.col("__record"), F.lit("")) == "", "no record").when(F.coalesce(F.col("__locator"), F.lit("")) == "", "no locator")
    checked = named.withColumn("reason", reason)
    rejected = checked.where("reason is not null").drop("__subject", "__record", "__locator")
    good = checked.where("reason is null")
    evidence_id = F.concat_ws(":", F.lit("evidence"), F.lit(release.source_id), F.lit(release.release_id), F.col("__record"))

    def said(m: Mapping) -> Column:
        value = F.to_json(F.struct(F.col(m.column).alias("v")))
        inner = F.regexp_extract(value, r"^\{\"v\":(.*)\}$", 1)
        original = F.col(m.original or m.column).cast("string")
        normal = F.struct(original.alias("originalValue"), F.lit(None).cast("string").alias("method"), F.lit(m.unit).cast("string").alias("unit"))
        return F.when(F.col(m.column).isNotNull(), F.struct(F.lit(m.predicate).alias("predicate"), inner.alias("value"), normal.alias("normalization")))

    cells = good.select("__subject", "__record", evidence_id.alias("e"), F.explode(F.array_compact(F.array(*map(said, mappings)))).alias("c"))
    assertions = cells.select(
        F.concat_ws(":", F.lit(release.source_id), F.lit(release.release_id), "__record", "c.predicate").alias("id"), F.lit(subject_type).alias("subjectType"), F.col("__subject").alias("subjectId"),
        "c.predicate", "c.value", "c.normalization", F.array("e").alias("evidenceReferenceIds"),
    )
    evidence = good.select(
        evidence_id.alias("id"), F.lit(release.source_id).alias("sourceId"), F.lit(release.manifest_id).alias("sourceManifestId"), F.lit(release.release_id).alias("sourceReleaseId"), F.col("__record").alias("sourceRecordId"),
        F.col("__locator").alias("locator"), F.lit(release.licence_id).alias("licenceId"),
    ).distinct()
    return assertions, evidence, rejected


def import_run(assertions: DataFrame, evidence: DataFrame, rejected: DataFrame) -> DataFrame:
    """Counts of an import run: what, reason, n."""
    count = lambda df, what: df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), F.lit(None).cast("string").alias("reason"), "n")
    refused = rejected.groupBy("reason").agg(F.count("*").alias("n")).select(F.lit("rejected").alias("what"), "reason", "n")
    return count(assertions, "assertions").unionByName(count(evidence, "evidence")).unionByName(refused)
