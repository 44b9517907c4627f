"""What changed between consecutive full snapshots.

Method: rows are reduced to one per record and snapshot (map-side combining), range-partitioned by record id and sorted
by id and snapshot within each range; one streaming pass per range then holds two pointers, to the record as the
earlier snapshot has it and to the next row, compares the columns and emits typed changes. Rows are compared a batch at
a time with Arrow kernels; only the last row of a batch is carried on. A range holds at most one row per record and
snapshot, so a repeated record can't make a range large. :func:`snapshot_changes` takes a whole history at once; :class:`KeptSnapshots` keeps
the partitioned, sorted copy, so that only a new snapshot is shuffled.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedloom.functions.json_text import canonical_text
from seedloom.plans.lineage import list_names, read_text, shared_folder, write_text, written

#: More snapshots than this are refused, as their dates are held by the driver and by every task.
MOST_SNAPSHOTS = 100_000

_OUT = "id string, snapshot date, change string, columns array<string>"


def content(df: DataFrame, column: str, json_columns: tuple[str, ...] = ()) -> Column:
    """A column's content as text: lists sorted, JSON text canonical, everything else by its JSON or string form."""
    kind = df.schema[column].dataType
    if kind.typeName() == "array":
        return F.to_json(F.array_sort(F.col(column)))
    if kind.typeName() in ("struct", "map"):
        return F.to_json(F.col(column))
    if column in json_columns:
        return canonical_text(f"`{column}`")
    return F.col(column).cast("string")


def _merge(dates: list[dt.date], names: list[str]):
    last = len(dates) - 1

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        order = np.array(dates, dtype="datetime64[D]")
        schema = pa.schema([("id", pa.string()), ("snapshot", pa.date32()), ("change", pa.string()), ("columns", pa.list_(pa.string()))])

        def emit(ids, at, change, columns=None):
            n = len(ids)
            return pa.RecordBatch.from_arrays(
                [ids.cast(pa.string()), pa.array(order[at], pa.date32()), pa.array([change] * n, pa.string()), pa.array(columns if columns is not None else [None] * n, pa.list_(pa.string()))],
                schema=schema,
            )

        carry = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if carry is None:
                first = table.slice(0, 1)
                at = np.searchsorted(order, first["snapshot"].to_numpy().astype("datetime64[D]"))
                if at[0] > 0:
                    yield emit(first["id"].combine_chunks(), at, "added")
            else:
                table = pa.concat_tables([carry, table])
            carry = table.slice(table.num_rows - 1)
            n = table.num_rows - 1
            if not n:
                continue
            table = table.combine_chunks()
            before, after = table.slice(0, n), table.slice(1, n)
            at = np.searchsorted(order, table["snapshot"].to_numpy().astype("datetime64[D]"))
            same = pc.equal(before["id"], after["id"]).to_numpy()
            follows = same & (at[1:] == at[:-1] + 1)
            apart = {}
            for c in names:
                a, b = before[c], after[c]
                differs = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
                apart[c] = differs.to_numpy() & follows
            gone = np.flatnonzero(~follows & (at[:-1] < last))
            come = np.flatnonzero(~follows & (at[1:] > 0))
            changed = np.flatnonzero(np.logical_or.reduce(list(apart.values()))) if names else np.array([], int)
            if len(gone):
                yield emit(before["id"].take(pa.array(gone)).combine_chunks(), at[:-1][gone] + 1, "removed")
            if len(come):
                yield emit(after["id"].take(pa.array(come)).combine_chunks(), at[1:][come], "added")
            if len(changed):
                yield emit(after["id"].take(pa.array(changed)).combine_chunks(), at[1:][changed], "changed", [[c for c in names if apart[c][i]] for i in changed])
        if carry is not None:
            at = np.searchsorted(order, carry["snapshot"].to_numpy().astype("datetime64[D]"))
            if at[0] < last:
                yield emit(carry["id"].combine_chunks(), at + 1, "removed")

    return run


def snapshot_changes(df: DataFrame, id: str = "id", snapshot: str = "snapshot_date", received: str | None = "received_at", json_columns: tuple[str, ...] = (), ignored: tuple[str, ...] = ()) -> DataFrame:
    """Changes between every pair of consecutive snapshots: id, snapshot (the later date), change, columns.

    ``change`` is added, removed or changed; ``columns`` names the columns that differ and is NULL for the other two.
    All columns but ``received`` and ``ignored`` are compared; two NULLs are equal, a NULL and a value are not. Of
    several rows of a record in one snapshot the one received last counts, then the greatest by content. Rows without id or
    snapshot date are left out. The first snapshot gives no rows, nor does an empty table or a single snapshot. Dates
    at which no record at all was delivered aren't known and so aren't snapshots.
    """
    names = [c for c in df.columns if c not in {id, snapshot, received, *ignored}]
    dates = [r[0] for r in df.select(F.col(snapshot).cast("date").alias("d")).where("d is not null").distinct().orderBy("d").limit(MOST_SNAPSHOTS + 1).collect()]
    if len(dates) > MOST_SNAPSHOTS:
        raise ValueError(f"more than {MOST_SNAPSHOTS} snapshots")
    keys = {c: f"c{i}" for i, c in enumerate(names)}
    rows = df.select(
        F.col(id).cast("string").alias("id"), F.col(snapshot).cast("date").alias("snapshot"),
        F.struct(*([F.col(received).alias("r")] if received else []), *[content(df, c, json_columns).alias(k) for c, k in keys.items()]).alias("row"),
    ).where("id is not null and snapshot is not null")
    rows = rows.groupBy("id", "snapshot").agg(F.max("row").alias("row")).select("id", "snapshot", *[F.col(f"row.{k}").alias(k) for k in keys.values()])
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", "snapshot")
    changes = rows.mapInArrow(_merge(dates, list(keys.values())), _OUT)
    back = F.create_map(*[x for c, k in keys.items() for x in (F.lit(k), F.lit(c))]) if keys else None
    return changes.withColumn("columns", F.transform("columns", lambda k: F.element_at(back, k))) if keys else changes


def _merged(left: Iterator, right: Iterator) -> Iterator:
    """Batches of two streams that are sorted by id as one stream sorted by id and snapshot; a batch of each is held."""
    import pyarrow as pa
    import pyarrow.compute as pc

    streams, held = [left, right], [None, None]
    while True:
        for k in (0, 1):
            while held[k] is None and streams[k] is not None:
                batch = next(streams[k], None)
                if batch is None:
                    streams[k] = None
                elif batch.num_rows:
                    held[k] = pa.Table.from_arrays(batch.columns, batch.schema.names)
        there = [t for t in held if t is not None]
        if not there:
            return
        # Up to the lesser last id of the streams that go on, both are known.
        lasts = [t["id"][-1].as_py().encode() for t, s in zip(held, streams, strict=True) if t is not None and s is not None]
        cut, parts = min(lasts).decode() if lasts else None, []
        for k, t in enumerate(held):
            if t is not None:
                n = t.num_rows if cut is None else pc.sum(pc.less_equal(t["id"], cut)).as_py() or 0
                parts.append(t.slice(0, n))
                held[k] = t.slice(n) if n < t.num_rows else None
        table = pa.concat_tables(parts)
        if table.num_rows:
            yield from table.sort_by([("id", "ascending"), ("snapshot", "ascending")]).combine_chunks().to_batches()


class KeptSnapshots:
    """Snapshots that are kept range-partitioned and sorted by id, so that a new one is compared without a shuffle of those before it.

    The first snapshot gives the bounds of the ranges. Each snapshot is reduced to one row per record and written once, a file per range;
    a comparison streams two files per range side by side. The commits of ``folder``, which all executors reach, list the snapshots, so an object on
    the same folder goes on where another one ended. Snapshots come in the order of their dates; all have the columns of the first.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, json_columns: tuple[str, ...] = (), ignored: tuple[str, ...] = (), id: str = "id", received: str | None = "received_at"):
        self.spark, self.id, self.received, self.json_columns, self.ignored = spark, id, received, json_columns, ignored
        self.folder = (folder or f"{shared_folder(spark)}/snapshots_{uuid.uuid4().hex}").rstrip("/")
        names = sorted(n for n in list_names(spark, f"{self.folder}/commits") if n.endswith(".json"))
        self.state = json.loads(read_text(spark, f"{self.folder}/commits/{names[-1]}")) if names else {"columns": None, "bounds": None, "snapshots": []}

    def add(self, df: DataFrame, date: dt.date) -> None:
        """Keeps one snapshot: rows of one date, without a column for it. A date that is not after the last one is refused."""
        kept = self.state["snapshots"]
        if kept and date.isoformat() <= kept[-1][0]:
            raise ValueError(f"{date} is not after {kept[-1][0]}")
        names = [c for c in df.columns if c not in {self.id, self.received, *self.ignored}]
        if self.state["columns"] not in (None, names):
            raise ValueError(f"the columns are not {', '.join(self.state['columns'])}")
        rows = df.select(F.col(self.id).cast("string").alias("id"), F.struct(*([F.col(self.received).alias("r")] if self.received else []), *[content(df, c, self.json_columns).alias(f"c{i}") for i, c in enumerate(names)]).alias("row")).where("id is not null")
        rows = rows.groupBy("id").agg(F.max("row").alias("row")).select("id", F.lit(date).alias("snapshot"), *[f"row.c{i}" for i in range(len(names))])
        bounds = self.state["bounds"]
        if bounds is None:
            number = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            rows = written(rows.repartitionByRange(number, "id").withColumn("part", F.spark_partition_id()))
            bounds = sorted((r["least"] for r in rows.groupBy("part").agg(F.min("id").alias("least")).collect()), key=str.encode)[1:]  # one per shuffle partition
            rows = rows.drop("part")
        schema = T.StructType([*rows.schema.fields, T.StructField("range", T.IntegerType())])
        ranged = rows.mapInArrow(_ranges(bounds), schema)
        path = f"snapshots/{date.isoformat()}_{uuid.uuid4().hex}"
        ranged.repartition(len(bounds) + 1, "range").sortWithinPartitions("range", "id").write.partitionBy("range").parquet(f"{self.folder}/{path}")
        state = {"columns": names, "bounds": bounds, "snapshots": [*kept, [date.isoformat(), path]]}
        write_text(self.spark, f"{self.folder}/commits/{len(kept):010d}.json", json.dumps(state))
        self.state = state

    def changes(self) -> DataFrame:
        """Changes from the last snapshot but one to the last: id, snapshot, change, columns, as :func:`snapshot_changes` gives them."""
        kept, names = self.state["snapshots"], self.state["columns"]
        if len(kept) < 2:
            return self.spark.createDataFrame([], _OUT)
        keys = [f"c{i}" for i in range(len(names))]
        folders = [f"{self.folder}/{path}" for _, path in kept[-2:]]
        run = _files_compared(folders, [dt.date.fromisoformat(d) for d, _ in kept[-2:]], keys)
        ranges = len(self.state["bounds"]) + 1
        changes = self.spark.range(0, ranges, 1, ranges).mapInArrow(run, _OUT)
        back = F.create_map(*[x for k, c in zip(keys, names, strict=True) for x in (F.lit(k), F.lit(c))])
        return changes.withColumn("columns", F.transform("columns", lambda k: F.element_at(back, k))) if keys else changes


def _ranges(bounds: list[str]):
    encoded = [b.encode() for b in bounds]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = [bisect_right(encoded, i.encode()) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], [*batch.schema.names, "range"])

    return run


def _files_compared(folders: list[str], dates: list[dt.date], keys: list[str]):
    merge = _merge(dates, keys)

    def run(batches):
        from pyarrow import dataset, fs

        def stream(folder: str, number: int):
            system, root = fs.FileSystem.from_uri(folder)
            selector = fs.FileSelector(f"{root}/range={number}", allow_not_found=True)
            files = sorted(f.path for f in system.get_file_info(selector) if f.base_name.endswith(".parquet"))
            for file in files:  # one file, as a range is one task's work
                yield from dataset.dataset(file, filesystem=system, format="parquet").to_batches(columns=["id", "snapshot", *keys], batch_size=10_000, use_threads=False)

        for batch in batches:
            for number in batch.column(0).to_pylist():
                yield from merge(_merged(*(stream(f, number) for f in folders)))

    return run
