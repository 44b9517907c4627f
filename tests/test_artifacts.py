import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from seedloom.operators import artifacts as a
from seedloom.sources.jsonl import read_binary


def test_golden_bytes():
    made = a.compress(b'{"a":1}\n{"b":2}\n', 2)
    # The pinned bytes of this input.
    assert made.data.hex() == "1f8b08000000000002ffab564a54b232ace5aa564a52b232aae50200c8b2ce9f10000000"
    assert made.sha256 == hashlib.sha256(made.data).hexdigest() == "ace7c84639a46036fb0ad1892dcc2f86f7874fd11448920f2ca2ec0d237a97fe"
    assert (made.byte_size, made.entry_count) == (36, 2)


def test_round_trip_and_parts():
    stream = a.GzipStream()
    for part in (b"", b"abc" * 10_000, b"\n"):
        stream.write(part)
    made = stream.finish(1)
    assert gzip.decompress(made.data) == b"abc" * 10_000 + b"\n" and made.byte_size == len(made.data)
    assert gzip.decompress(a.compress(b"", 0).data) == b""


@pytest.mark.parametrize("count", [-1, 1.5, float("inf"), 2**53])
def test_bad_counts(count):
    with pytest.raises(ValueError):
        a.compress(b"", count)


@pytest.fixture
def lines(spark):
    rows = [(f"k{n:04d}", f'{{"n":{n},"t":"{"ä" * (n % 7)}"}}') for n in range(500)]
    return spark.createDataFrame([*rows, ("none", None)], "id string, line string").withColumn("size", F.lit("clash"))


def chunks(df):
    return [(r.chunk, bytes(r.bytes), r.sha256, r.byteSize, r.entryCount) for r in a.gzip_chunks(df, "id", "line", 4000).orderBy("chunk").collect()]


def test_chunks_do_not_depend_on_partitions(spark, lines):
    first = chunks(lines)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert chunks(lines.repartition(5)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    text = b"".join(gzip.decompress(c[1]) for c in first).decode()
    assert text.splitlines() == [r.line for r in lines.where("line is not null").orderBy("id").collect()]
    assert len(first) > 2 and sum(c[4] for c in first) == 500
    assert a.gzip_chunks(lines.limit(0), "id", "line").collect() == []


def test_release(spark, lines, tmp_path):
    manifest = a.write_release(a.gzip_chunks(lines, "id", "line", 4000), tmp_path, "names", "urn:x", {"schemaVersion": "1.0.0"})
    listed = spark.createDataFrame([(x["path"], x["sha256"], x["byteSize"], x["entryCount"], True) for x in manifest["requiredArtifacts"]], "path string, sha256 string, byteSize bigint, entryCount bigint, required boolean")
    files = lambda: read_binary(spark, str(tmp_path), "*.gz").select(F.element_at(F.split("path", "/"), -1).alias("path"), "content")
    assert a.verify(listed, files()).collect() == []
    assert tuple(a.verdict(a.verify(listed, files())).first()) == (True, [])
    (tmp_path / manifest["requiredArtifacts"][0]["path"]).write_bytes(b"broken")
    (tmp_path / manifest["requiredArtifacts"][1]["path"]).unlink()
    (tmp_path / "more.gz").write_bytes(a.compress(b"", 0).data)
    more = listed.unionByName(listed.limit(1)).unionByName(spark.createDataFrame([("optional.gz", "x", 1, 1, False)], listed.schema))
    found = {(r.path[-8:], r.problem) for r in a.verify(more, files()).collect()}
    assert found == {("jsonl.gz", p) for p in ("size", "hash", "entries", "missing", "duplicate")} | {("more.gz", "extra")}


def test_comparisons(spark):
    x = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("b", 2)], "k string, n int")
    y = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("d", 3)], "k string, n int")
    assert sorted(tuple(r) for r in a.compare_builds(x, y).select("side", "k").collect()) == [("first", "b"), ("second", "d")]
    z = spark.createDataFrame([("a", 5), ("c", None), ("d", 3)], "k string, n int")
    got = sorted(tuple(r) for r in a.compare_manifests(x.distinct(), z, "k", ["n"]).collect())
    assert got == [("a", "mismatch"), ("b", "missing"), ("d", "extra")]


def test_releases_are_never_changed(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "id string")
    a.append_release(df, str(tmp_path), "1.0.0")
    a.append_release(df, str(tmp_path), "1.1.0")
    with pytest.raises(Exception, match="(?i)exists"):
        a.append_release(df, str(tmp_path), "1.0.0")
    assert sorted(r.catalogVersion for r in spark.read.parquet(str(tmp_path)).select(F.col("catalogVersion").cast("string")).collect()) == ["1.0.0", "1.1.0"]
