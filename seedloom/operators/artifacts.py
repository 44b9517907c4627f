"""Reproducible artifacts: canonical JSON Lines in gzip chunks, their descriptors, and verification.

The order is that of the key, chunk boundaries follow from the sizes of the lines, and the gzip bytes have no time or machine in
them, so that equal records give equal bytes whatever the partitioning.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.functions.canonical_json import SAFE_INTEGER, canonical_bytes
from seedloom.operators.ordering import running_sum
from seedloom.plans.lineage import make_folder, write_text

#: Uncompressed bytes of a chunk, so that the compressed chunk stays near 1 MiB for usual records, and the most that it may have.
CHUNK_BYTES, MOST_COMPRESSED = 4 << 20, 2 << 20
# Gzip header without name and time, with the strongest level marked and the system unknown.
_HEADER = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 2, 255])


@dataclass(frozen=True)
class Artifact:
    data: bytes
    sha256: str
    byte_size: int
    entry_count: int


class GzipStream:
    """Reproducible gzip of bytes that come in parts; the digest is taken on the way."""

    def __init__(self) -> None:
        self._deflate = zlib.compressobj(9, zlib.DEFLATED, -15, 8, zlib.Z_DEFAULT_STRATEGY)
        self._crc, self._size, self._hash = 0, 0, hashlib.sha256(_HEADER)
        self._parts = [_HEADER]
        self.byte_size = len(_HEADER)

    def _emit(self, data: bytes) -> None:
        self._hash.update(data)
        self.byte_size += len(data)
        self._parts.append(data)

    def write(self, data: bytes) -> None:
        self._crc, self._size = zlib.crc32(data, self._crc), self._size + len(data)
        self._emit(self._deflate.compress(data))

    def finish(self, entry_count: int) -> Artifact:
        if isinstance(entry_count, float) and not entry_count.is_integer() or not 0 <= entry_count <= SAFE_INTEGER:
            raise ValueError("the number of entries is no integer from 0 to the largest safe one")
        self._emit(self._deflate.flush())
        self._emit(struct.pack("<II", self._crc, self._size & 0xFFFFFFFF))
        return Artifact(b"".join(self._parts), self._hash.hexdigest(), self.byte_size, int(entry_count))


def compress(data: bytes, entry_count: int) -> Artifact:
    """Reproducible gzip of ``data`` with digest, size and the given number of entries."""
    stream = GzipStream()
    stream.write(data)
    return stream.finish(entry_count)


def assign_chunks(df: DataFrame, key: str, size: str, limit: int) -> DataFrame:
    """``df`` with ``chunk``: the running size before a row, in order of ``key`` (unique), divided by ``limit``."""
    return running_sum(df, [key], F.col(size), "__running").withColumn("chunk", F.floor(F.col("__running") / limit).cast("bigint")).drop("__running")


def _gzip_chunk(table):
    import pyarrow as pa

    ordered = table.sort_by("key")
    stream = GzipStream()
    for line in ordered["line"].to_pylist():
        stream.write(line.encode() + b"\n")
    made = stream.finish(ordered.num_rows)
    if made.byte_size > MOST_COMPRESSED:
        raise ValueError(f"a chunk has {made.byte_size} bytes; choose a smaller chunk size")
    return pa.table({"chunk": [ordered["chunk"][0].as_py()], "bytes": [made.data], "sha256": [made.sha256], "byteSize": [made.byte_size], "entryCount": [made.entry_count]})


def gzip_chunks(df: DataFrame, key: str, line: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of JSON Lines: chunk, bytes, sha256, byteSize, entryCount. ``key`` is unique; NULL lines are left out.

    A chunk holds about ``chunk_bytes`` of lines, and is one task's work; the longest line comes on top.
    """
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(line).alias("line")).where("line is not null").withColumn("size", F.octet_length("line") + 1)
    chunked = assign_chunks(rows, "key", "size", chunk_bytes).select("chunk", "key", "line")
    return chunked.groupBy("chunk").applyInArrow(_gzip_chunk, "chunk bigint, bytes binary, sha256 string, byteSize bigint, entryCount bigint")


def _write_files(folder: str, name: str):
    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            files = [f"{name}-{k:05d}.jsonl.gz" for k in batch.column(0).to_pylist()]
            for file, data in zip(files, batch.column(1), strict=True):
                draft = f"{root}/.{file}.{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as out:
                    out.write(data.as_buffer())
                system.move(draft, f"{root}/{file}")  # equal bytes, whichever attempt of a task comes last
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), *[batch.column(k) for k in (2, 3, 4)]], ["path", "sha256", "byteSize", "entryCount"])

    return run


def write_release(chunks: DataFrame, folder: str | Path, name: str, schema_id: str, manifest: dict) -> dict:
    """Writes chunk files and ``manifest.json`` (which doesn't list itself) into a flat folder, a path or URI that all executors reach; returns the manifest.

    The executors write the files; the driver gets their descriptors only. A manifest that is there already is refused.
    """
    home = str(folder) if "://" in str(folder) else f"file://{Path(folder).absolute()}"
    make_folder(chunks.sparkSession, home)
    rows = chunks.select("chunk", "bytes", "sha256", "byteSize", "entryCount").mapInArrow(_write_files(home, name), "path string, sha256 string, byteSize bigint, entryCount bigint")
    listed = [
        {"path": r.path, "kind": "jsonl-gzip", "mediaType": "application/x-ndjson", "schemaId": schema_id, "contentEncoding": "gzip", "byteSize": r.byteSize, "entryCount": r.entryCount, "sha256": r.sha256}
        for r in sorted(rows.collect(), key=lambda r: r.path)
    ]
    document = manifest | {"requiredArtifacts": listed, "optionalArtifacts": manifest.get("optionalArtifacts", [])}
    write_text(chunks.sparkSession, f"{home}/manifest.json", canonical_bytes(document).decode())
    return document


def size_budget(files: DataFrame, limit: int, size: str = "byteSize") -> DataFrame:
    """One row: files, bytes, limit, and whether the release is within its budget; an empty release is."""
    total = F.coalesce(F.sum(size), F.lit(0)).cast("bigint")
    return files.agg(F.count("*").alias("files"), total.alias("bytes"), F.lit(limit).cast("bigint").alias("limit"), (total <= limit).alias("within"))


def _counted(batches):
    import pyarrow as pa

    for batch in batches:
        counts = []
        for data, name in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True):
            try:
                text = zlib.decompress(data, 31) if name.endswith(".gz") else data
                counts.append(sum(1 for x in text.split(b"\n") if x))
            except zlib.error:
                counts.append(None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["path", "entries"])


def verify(expected: DataFrame, files: DataFrame) -> DataFrame:
    """Problems of a release: path, problem. ``expected`` has path, sha256, byteSize, entryCount, required; ``files`` has path, content.

    Problems are duplicate, missing (only if required), extra, size, hash and entries. An empty result means that it may be activated.
    """
    actual = files.select("path", F.sha2("content", 256).alias("actual_hash"), F.octet_length("content").cast("bigint").alias("actual_size"))
    entries = files.select("path", "content").mapInArrow(_counted, "path string, entries bigint")
    repeated = expected.groupBy("path").agg(F.count("*").alias("n")).where("n > 1").select("path", F.lit("duplicate").alias("problem"))
    both = expected.dropDuplicates(["path"]).withColumn("listed", F.lit(True)).join(actual.withColumn("there", F.lit(True)), "path", "full_outer").join(entries, "path", "left")
    problems = F.array_compact(
        F.array(
            F.when(F.col("there").isNull() & F.col("required"), "missing"),
            F.when(F.col("listed").isNull(), "extra"),
            F.when(F.col("actual_size") != F.col("byteSize"), "size"),
            F.when(F.col("actual_hash") != F.col("sha256"), "hash"),
            F.when(F.col("there") & F.col("entryCount").isNotNull() & ~F.col("entryCount").eqNullSafe(F.col("entries")), "entries"),
        )
    )
    return both.select("path", F.explode(problems).alias("problem")).unionByName(repeated)


def verdict(problems: DataFrame) -> DataFrame:
    """One row: activatable, and the problems as sorted ``path: problem`` texts; a release with any problem must not be activated."""
    listed = F.array_sort(F.collect_set(F.concat_ws(": ", "path", "problem")))  # a release has few files
    return problems.agg(listed.alias("reasons")).select((F.size("reasons") == 0).alias("activatable"), "reasons")


def append_release(df: DataFrame, folder: str, version: str) -> None:
    """Adds a release's records as a partition of their own; a version that is there already is refused."""
    target = f"{folder}/catalogVersion={version}"
    df.write.mode("errorifexists").parquet(target)


def compare_manifests(expected: DataFrame, actual: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Keys on which two manifests differ: key, problem (missing, extra or mismatch). Keys are unique; NULL values are equal."""
    b = actual.select(F.col(key).alias("__key"), *[F.col(v).alias(f"__{v}") for v in values])
    both = expected.join(b, F.col(key) == F.col("__key"), "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(v).eqNullSafe(F.col(f"__{v}")) for v in values])
    problem = F.when(F.col("__key").isNull(), "missing").when(F.col(key).isNull(), "extra").when(~same, "mismatch")
    return both.select(F.coalesce(key, "__key").alias(key), problem.alias("problem")).where("problem is not null")


def compare_builds(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows that only one of two builds has, as often as it has more of them: side (first or second) and the columns."""
    return first.exceptAll(second).withColumn("side", F.lit("first")).unionByName(second.exceptAll(first).withColumn("side", F.lit("second")))
