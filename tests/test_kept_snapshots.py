"""Snapshots kept range-partitioned give the changes that the whole history gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from seedloom.operators.snapshot_diff import KeptSnapshots, _merged, snapshot_changes

SCHEMA = "id string, a string, ids array<string>, v string, received_at timestamp"


def day(n):
    return dt.date(2024, 1, n)


def test_kept_as_whole_history(spark, tmp_path):
    r = random.Random(4)
    t = lambda n: dt.datetime(2024, 2, n)
    snapshots = []
    for _ in range(4):
        rows = [(f"é{k:03d}" if k % 7 == 0 else f"id{k:03d}", r.choice([None, "", "x", "y"]), r.choice([None, ["p", None, "q"], ["q", "p", None], []]), r.choice(['{"a":1,"b":2}', '{"b": 2, "a": 1}', "{", None]), t(1)) for k in r.sample(range(200), 150)]
        snapshots.append([*rows, *[(i, "later", None, None, t(3)) for i, *_ in rows[:5]], (None, "x", None, None, t(1)), rows[9]])
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in snapshots]
    folder, got = f"file://{tmp_path}/kept", []
    for n, df in enumerate(frames, 1):
        kept = KeptSnapshots(spark, folder, json_columns=("v",))  # a new driver each time
        kept.add(df, day(n))
        got += [(x.id, x.snapshot, x.change, x.columns and tuple(x.columns)) for x in kept.changes().collect()]
    assert len(kept.state["bounds"]) > 0 and len(kept.state["snapshots"]) == 4
    whole = frames[0].withColumn("d", F.lit(day(1)))
    for n, df in enumerate(frames[1:], 2):
        whole = whole.unionByName(df.withColumn("d", F.lit(day(n))))
    want = [(x.id, x.snapshot, x.change, x.columns and tuple(x.columns)) for x in snapshot_changes(whole, snapshot="d", json_columns=("v",)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) > 200
    with pytest.raises(ValueError):
        kept.add(frames[0], day(4))
    with pytest.raises(ValueError):
        kept.add(frames[0].drop("a"), day(5))


def test_empty_snapshots(spark, tmp_path):
    df = spark.createDataFrame([("1", "x", None, None, None)], SCHEMA)
    kept = KeptSnapshots(spark, f"file://{tmp_path}/kept")
    assert kept.changes().collect() == []
    for n, rows in enumerate((df.limit(0), df, df.limit(0), df.limit(0)), 1):
        kept.add(rows, day(n))
        assert [(x.id, x.change) for x in kept.changes().collect()] == [[], [("1", "added")], [("1", "removed")], []][n - 1]


def test_two_streams_as_one():
    import pyarrow as pa

    r = random.Random(1)
    for _ in range(50):
        streams, rows = [], []
        for d in (1, 2):
            ids = sorted({f"{r.randrange(60):02d}" for _ in range(r.randrange(40))})
            rows += [(i, d) for i in ids]
            table = pa.table({"id": pa.array(ids, pa.string()), "snapshot": pa.array([d] * len(ids), pa.int64())})
            streams.append(iter(table.to_batches(max_chunksize=r.randrange(1, 9))))
        got = [(i, d) for b in _merged(*streams) for i, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        assert got == sorted(rows)
