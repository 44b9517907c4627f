"""References to records that do not exist, kept incrementally.

The state is keyed by (target table, referred id): an index of the parents that have arrived, the references that wait for
one (pending) and the references that met one (settled or late, with the parent's times). A batch is applied in keyed
steps: new references probe the parent index, arriving parents resolve waiting references, and deletions reopen settled
ones. Counts of open references per table, field, month and reason can be taken after every batch. Each state table is
written to the shared folder and a batch is committed as a whole, so that no lineage grows from batch to batch, lost executors cost
only their tasks, and a failed batch or a lost driver loses nothing.

All joins are on the keyed side with one row per parent, so adaptive execution can split a parent that a third
of all references name; repeated rows are reduced before the shuffle.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedloom.plans.lineage import list_names, read_text, shared_folder, write_text, written

_PARENT = "target string, ref_id string, parent_received_at timestamp_ntz, deleted_at timestamp_ntz"
_MET = f"table_name string, id string, received_at timestamp_ntz, field string, {_PARENT}"
_DELETION = "target string, ref_id string, late_deletion timestamp_ntz"
PENDING, LATE, SETTLED = "pending", "late", "settled"
#: Batches after which the parts of the state are merged.
MERGED = 16
#: Batches that can be staged at once.
MOST_CUTS = 1000


def referring_rows(df: DataFrame, table_name: str, fields: dict[str, str], id: str = "id", received: str = "received_at") -> DataFrame:
    """Rows of a table that refer to others: table_name, id, received_at, refs.

    ``fields`` maps a reference field, one id or a list of ids, to its target table. NULL ids and NULL references, also
    within lists, are no references; an id named twice in a list is one.
    """
    kind = "array<struct<field:string,target:string,ref_id:string>>"

    def named(field: str, target: str) -> Column:
        ids = F.col(field) if df.schema[field].dataType.typeName() == "array" else F.array(F.col(field))
        made = F.transform(F.array_distinct(F.array_compact(ids)), lambda r: F.struct(F.lit(field).alias("field"), F.lit(target).alias("target"), r.cast("string").alias("ref_id")))
        return F.coalesce(made, F.array().cast(kind))

    refs = F.concat(*[named(f, t) for f, t in fields.items()])
    return df.select(F.lit(table_name).alias("table_name"), F.col(id).cast("string").alias("id"), F.col(received).cast("timestamp_ntz").alias("received_at"), refs.alias("refs")).where("id is not null")


def parent_rows(df: DataFrame, target: str, id: str = "id", received: str = "received_at", deleted: str | None = "deleted_at") -> DataFrame:
    """Rows of a target table: target, ref_id, parent_received_at, deleted_at."""
    gone = F.col(deleted).cast("timestamp_ntz") if deleted else F.lit(None).cast("timestamp_ntz")
    return df.select(F.lit(target).alias("target"), F.col(id).cast("string").alias("ref_id"), F.col(received).cast("timestamp_ntz").alias("parent_received_at"), gone.alias("deleted_at")).where("ref_id is not null")


def _first(df: DataFrame, keys: list[str], time: str, *rest: str) -> DataFrame:
    """Of repeated rows of a key the one received first, then the least by its other columns; unknown times come last."""
    picked = df.groupBy(*keys).agg(F.min(F.struct(F.col(time).isNull().alias("unknown"), F.col(time), *rest)).alias("first"))
    return picked.select(*keys, f"first.{time}", *[f"first.{c}" for c in rest])


class PendingOrphans:
    """The state, applied batch by batch; any split of the same rows into batches in order of arrival ends in the same state.

    The state is what the latest commit in ``folder`` lists, so an object on the same folder goes on where another one ended, also after
    the loss of the driver. A batch writes all of its tables under names of its own and then its commit, by one rename: a batch that fails
    leaves the state as it was and can be applied again, and a ``number`` that was committed already is skipped. One writer at a
    time is assumed. Every ``MERGED``-th batch merges the parts of each table, so that plans don't grow with the number of batches.
    """

    TABLES = ("parents", "referrers", "met", "deletions")

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = (folder or f"{shared_folder(spark)}/orphans_{uuid.uuid4().hex}").rstrip("/")
        self.number = -1
        self._parts: dict[str, list[str]] = {t: [] for t in self.TABLES}
        commits = list_names(spark, f"{self.folder}/commits")
        if names := sorted(n for n in commits if n.endswith(".json")):
            self._set(json.loads(read_text(spark, f"{self.folder}/commits/{names[-1]}")))

    def _set(self, commit: dict) -> None:
        self.number, self._parts = commit["number"], {t: list(commit[t]) for t in self.TABLES}

    def _all(self, table: str) -> DataFrame | None:
        """All parts of a table; only the latest part of met has references that wait."""
        schema = {"parents": _PARENT, "referrers": "table_name string, id string", "met": f"{_MET}, state string", "deletions": _DELETION}[table]
        parts = [self.spark.read.schema(schema).parquet(f"{self.folder}/{p}") for p in self._parts[table]]
        if table == "met" and len(parts) > 1:
            parts = [p.where(f"state <> '{PENDING}'") for p in parts[:-1]] + parts[-1:]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def apply(self, references: DataFrame, parents: DataFrame, deletions: DataFrame | None = None, number: int | None = None) -> PendingOrphans:
        """One batch: rows of :func:`referring_rows` and :func:`parent_rows`, and deletions (target, ref_id, deleted_at) of parents.

        ``number`` is that of the batch, for batches that may come again; they come in the order of their numbers.
        """
        number = self.number + 1 if number is None else number
        if number <= self.number:
            return self
        home = f"batches/{number:010d}_{uuid.uuid4().hex}"
        parts = {t: list(p) for t, p in self._parts.items()}

        def write(df: DataFrame, table: str, *by: str) -> DataFrame:
            path = f"{home}/{table}"
            writer = df.write.partitionBy(*by) if by else df.write
            writer.parquet(f"{self.folder}/{path}")
            parts[table].append(path)
            return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{path}")

        key = ["target", "ref_id"]
        fresh = _first(parents, key, "parent_received_at", "deleted_at")
        index = self._all("parents")
        if index is not None:
            fresh = fresh.join(index, key, "left_anti")
        fresh = write(fresh, "parents")
        index = fresh if index is None else index.unionByName(fresh)

        new = _first(references, ["table_name", "id"], "received_at", "refs")
        known = self._all("referrers")
        if known is not None:
            new = new.join(known, ["table_name", "id"], "left_anti")
        new = written(new)
        write(new.select("table_name", "id"), "referrers")

        # New references probe the index of all parents, parents that arrive now among them; what waits probes it again.
        probes = new.select("table_name", "id", "received_at", F.inline("refs"))
        before = self._all("met")
        if before is not None:
            probes = probes.unionByName(before.where(f"state = '{PENDING}'").select(*probes.columns))
        met = probes.join(index.withColumn("here", F.lit(True)), key, "left")
        state = F.when(F.col("here").isNull(), PENDING).when(F.col("parent_received_at") > F.col("received_at"), LATE).otherwise(SETTLED)
        write(met.withColumn("state", state).drop("here"), "met", "state")
        if deletions is not None:
            write(deletions.groupBy(*key).agg(F.min("deleted_at").alias("late_deletion")).where("late_deletion is not null"), "deletions")
        self._commit({"number": number, **parts})
        if (number + 1) % MERGED == 0:
            self.merge()
        return self

    def merge(self) -> None:
        """Every table as one part; the parts that it replaces stay for those who still read them."""
        home = f"merged/{self.number:010d}_{uuid.uuid4().hex}"
        parts = {}
        for table in self.TABLES:
            rows = self._all(table)
            parts[table] = [] if rows is None else [f"{home}/{table}"]
            if rows is not None:
                (rows.write.partitionBy("state") if table == "met" else rows.write).parquet(f"{self.folder}/{home}/{table}")
        self._commit({"number": self.number, **parts}, "merged")

    def _commit(self, commit: dict, mark: str = "") -> None:
        write_text(self.spark, f"{self.folder}/commits/{commit['number']:010d}{mark}.json", json.dumps(commit))
        self._set(commit)

    def open_references(self, until: Column | None = None) -> DataFrame:
        """References that are open: table_name, field, id, ref_id, period, reason (missing, deleted or late).

        With ``until`` a deletion counts only if it is not after that time.
        """
        out = ["table_name", "field", "id", "ref_id", F.date_format("received_at", "yyyy-MM").alias("period")]
        met = self._all("met")
        if met is None:
            return self.spark.createDataFrame([], "table_name string, field string, id string, ref_id string, period string, reason string")
        settled = met.where(f"state <> '{PENDING}'")
        gone = self._all("deletions")
        if gone is not None:
            gone = gone.groupBy("target", "ref_id").agg(F.min("late_deletion").alias("late_deletion"))
            settled = settled.join(gone, ["target", "ref_id"], "left").withColumn("deleted_at", F.least("deleted_at", "late_deletion")).drop("late_deletion")
        deleted = F.col("deleted_at").isNotNull() if until is None else F.coalesce(F.col("deleted_at") <= until, F.lit(False))
        reason = F.when(deleted, "deleted").when(F.col("state") == LATE, "late")
        reopened = settled.withColumn("reason", reason).where("reason is not null").select(*out, "reason")
        return met.where(f"state = '{PENDING}'").select(*out, F.lit("missing").alias("reason")).unionByName(reopened)

    def counts(self, until: Column | None = None) -> DataFrame:
        """Open references per table_name, field, period and reason."""
        return self.open_references(until).groupBy("table_name", "field", "period", "reason").agg(F.count("*").alias("open_references"))


def orphan_state(references: DataFrame, parents: DataFrame, batches: int = 3) -> PendingOrphans:
    """The state after all rows, applied in ``batches`` batches by time of arrival.

    Rows are staged once, partitioned by batch; rows with unknown time of arrival come with the last batch.
    """
    span = references.select(F.col("received_at").alias("t")).unionByName(parents.select(F.col("parent_received_at").alias("t"))).agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
    step = (span.b - span.a) / batches if span.a else None
    cuts = [span.a + step * k for k in range(1, batches)] if step else []
    state = PendingOrphans(references.sparkSession)
    for refs, ups, _ in staged(references, parents, cuts):
        state.apply(refs, ups)
    return state


def staged(references: DataFrame, parents: DataFrame, cuts: list[dt.datetime], deletions: DataFrame | None = None) -> Iterator[tuple[DataFrame, DataFrame, DataFrame | None]]:
    """Batches (references, parents, deletions) of what arrived before each of the ``cuts``, in their order, and of the rest.

    A deletion arrives at its deleted_at. All rows are written once, partitioned by batch.
    """
    if len(cuts) > MOST_CUTS:
        raise ValueError(f"more than {MOST_CUTS} batches")

    def split(rows: DataFrame, time: str) -> DataFrame:
        number = reduce(lambda c, k: c.when(F.col(time) < F.lit(cuts[k]).cast("timestamp_ntz"), k), range(len(cuts)), F).otherwise(len(cuts)) if cuts else F.lit(0)
        return written(rows.withColumn("batch", number), "batch")

    tables = [split(references, "received_at"), split(parents, "parent_received_at"), None if deletions is None else split(deletions, "deleted_at")]
    for k in range(len(cuts) + 1):
        yield tuple(None if t is None else t.where(F.col("batch") == k).drop("batch") for t in tables)


def periodic_counts(references: DataFrame, parents: DataFrame, cuts: list[dt.datetime]) -> DataFrame:
    """Open references at each of the ``cuts`` as they stood then: as_of (YYYY-MM-DD), table_name, field, period, reason, open_references.

    A batch is applied for each cut, deletions at their own time, and the counts are written after it.
    Of repeated parents the one received first tells when the record is deleted. What arrives after the last cut isn't counted.
    """
    ups = written(_first(parents, ["target", "ref_id"], "parent_received_at", "deleted_at"))
    gone = ups.where("deleted_at is not null").select("target", "ref_id", "deleted_at")
    here = ups.withColumn("deleted_at", F.lit(None).cast("timestamp_ntz"))
    state, counted = PendingOrphans(references.sparkSession), []
    for cut, batch in zip(cuts, staged(references, here, cuts, gone), strict=False):
        rows = state.apply(*batch).counts().select(F.lit(cut.strftime("%Y-%m-%d")).alias("as_of"), "table_name", "field", "period", "reason", "open_references")
        counted.append(written(rows.coalesce(1)))  # a row per table, field, month and reason
    if not counted:
        raise ValueError("there is no time to count at")
    return reduce(DataFrame.unionByName, counted)
