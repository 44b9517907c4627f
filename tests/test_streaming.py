import datetime as dt

from seedloom.operators.orphans import PendingOrphans
from seedloom.operators.schema import SchemaSet
from seedloom.sources.catalogue_schemas import documents, schema_id
from seedloom.streaming.ingest import stream_first_ids, stream_orphans, stream_validated


def finish(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def test_validated_stream(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"s","name":"n"}\n\n{"id":"s"}\n{broken\n')
    compiled = SchemaSet(documents()).compile(schema_id("source"))
    rows = finish(stream_validated(spark, str(tmp_path), compiled), "validated").collect()
    assert sorted(str(r.valid) for r in rows) == ["False", "None", "True"]


def test_first_ids(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("a", t), ("a", t), ("b", t)], "id string, at timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id string, at timestamp").parquet(str(tmp_path / "in"))
    assert sorted(r.id for r in finish(stream_first_ids(stream, "id", "at"), "first_ids").collect()) == ["a", "b"]


def test_orphan_stream(spark, tmp_path):
    t = lambda n: dt.datetime(2024, n, 1)
    refs = "table_name string, id string, received_at timestamp_ntz, refs array<struct<field:string,target:string,ref_id:string>>"
    ups = "target string, ref_id string, parent_received_at timestamp_ntz, deleted_at timestamp_ntz"
    spark.createDataFrame([("t", "1", t(1), [("f", "p", "a"), ("f", "p", "b")])], refs).write.parquet(str(tmp_path / "refs"))
    spark.createDataFrame([("p", "a", t(2), None)], ups).write.parquet(str(tmp_path / "ups"))
    folder = f"file://{tmp_path}/orphans"
    read = lambda name, schema: spark.readStream.schema(schema).parquet(str(tmp_path / name))
    for extra in (None, ("p", "b", t(3), None)):
        if extra:
            spark.createDataFrame([extra], ups).write.mode("append").parquet(str(tmp_path / "ups"))
        state = PendingOrphans(spark, folder)  # a new driver on the same folders
        stream_orphans(read("refs", refs), read("ups", ups), state, str(tmp_path / "state")).awaitTermination(120)
        assert sorted((r.ref_id, r.reason) for r in state.open_references().collect()) == [("a", "late"), ("b", "late" if extra else "missing")]
    assert PendingOrphans(spark, folder).number == state.number > 0
