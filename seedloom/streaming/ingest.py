"""Incremental ingest: the same checks on streams of JSON Lines and of deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seedloom.functions.json_text import strict_json
from seedloom.operators.orphans import PendingOrphans
from seedloom.operators.schema import Compiled, with_validation


def stream_jsonl(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New JSON Lines files of a folder as a stream: raw, v."""
    rows = spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", files_per_batch).text(folder)
    return rows.where("value <> ''").select(F.col("value").alias("raw"), strict_json("value").alias("v"))


def stream_validated(spark: SparkSession, folder: str, schema: Compiled) -> DataFrame:
    """Stream of records with ``valid`` and ``errors``; stateless."""
    return with_validation(stream_jsonl(spark, folder), schema)


def stream_first_ids(stream: DataFrame, id: str, time: str, delay: str = "1 day") -> DataFrame:
    """A stream without repeated ids, for repetitions that come within ``delay``; the state is bounded by it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([id])


def stream_orphans(references: DataFrame, parents: DataFrame, state: PendingOrphans, checkpoint: str) -> StreamingQuery:
    """Keeps a pending-orphan state up to date from streams of references and parents (columns as the state's batches have).

    Both are carried by one stream of batches, in which parents have a NULL id. The state's folder and the stream's checkpoint belong
    together: after a restart with both, batches that were applied are skipped by their number and all others applied once.
    """
    kind = "array<struct<field:string,target:string,ref_id:string>>"
    refs = references.select("table_name", "id", "received_at", "refs", F.lit(None).cast("string").alias("target"), F.lit(None).cast("string").alias("ref_id"), F.lit(None).cast("timestamp_ntz").alias("parent_received_at"), F.lit(None).cast("timestamp_ntz").alias("deleted_at"))
    ups = parents.select(F.lit(None).cast("string").alias("table_name"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("timestamp_ntz").alias("received_at"), F.lit(None).cast(kind).alias("refs"), "target", "ref_id", "parent_received_at", "deleted_at")

    def batch(rows: DataFrame, number: int) -> None:
        state.apply(rows.where("id is not null").select("table_name", "id", "received_at", "refs"), rows.where("id is null").select("target", "ref_id", "parent_received_at", "deleted_at"), number=number)

    return refs.unionByName(ups).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
