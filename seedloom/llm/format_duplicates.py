"""Duplicates hidden by formatting.

Method: the bytes of each field are streamed through a skip-and-fold table (everything but letters and digits is
skipped, letter case is folded, composed letters are taken apart so that both spellings of an accent meet) into rolling
polynomial hashes modulo two primes, a block of at most BLOCK letters at a time, so that neither a long text nor a batch of them is ever
folded as a whole; a canonical string is never made. Rows whose hashes collide are verified by a
two-pointer comparison with the first row of their group that skips and folds on the way. Rows that collide without being
equal are grouped again by a streamed digest, so the result is exact up to SHA-256.

The first row of a group is found with map-side combining, so a group that holds a third of all rows shrinks before
the shuffle; its rows then meet their one representative in a join that adaptive execution may split.
"""

from __future__ import annotations

import functools
import hashlib
import sys
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.plans.lineage import written

#: Bases of the hashes and the primes that they are taken modulo.
BASES = ((1048583, 2147483647), (786433, 2147483629))
#: Letters that are folded at a time.
BLOCK = 1 << 20


@functools.cache
def fold_table():
    """(table, expansions): the code of each code point, 0 for skip, -1 for those taken apart; and how these are taken apart."""
    import numpy as np

    table = np.zeros(sys.maxunicode + 1, np.int32)
    expansions: dict[int, list[int]] = {}
    for code in range(sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000:
            continue
        ch = chr(code)
        category = unicodedata.category(ch)
        if category[0] in "LN":
            folded = [ord(c) for c in unicodedata.normalize("NFD", ch.casefold()) if unicodedata.category(c)[0] in "LN" or unicodedata.combining(c)]
        elif category[0] == "M" and unicodedata.combining(ch):
            folded = [ord(c) for c in unicodedata.normalize("NFD", ch)]
        else:
            continue
        if len(folded) == 1:
            table[code] = folded[0]
        elif folded:
            table[code], expansions[code] = -1, folded
    return table, expansions


def folded_codes(text: str):
    """Folded codes of a piece of text, skipping everything else, as an array."""
    import numpy as np

    table, expansions = fold_table()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = table[points]
    if (codes < 0).any():
        return np.array([x for p, c in zip(points.tolist(), codes.tolist(), strict=True) if c for x in (expansions[p] if c < 0 else (c,))], np.int32)
    return codes[codes != 0]


@functools.lru_cache(maxsize=4)
def _powers(n: int, base: int, prime: int):
    import numpy as np

    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    filled = 1
    while filled < n:  # doubling: the next run is the last one times a power
        step = min(filled, n - filled)
        out[filled : filled + step] = out[:step] * np.uint64(int(out[filled - 1]) * base % prime) % np.uint64(prime)
        filled += step
    return out


def _piece_hashes(texts: list[str]):
    """(letters and digits, hash by each base) of every text of a block."""
    import numpy as np

    table, expansions = fold_table()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    rows = np.repeat(np.arange(len(texts)), lengths)
    codes = table[points]
    if (codes < 0).any():
        times = np.ones(len(codes), np.int64)
        apart = np.flatnonzero(codes < 0)
        parts = [expansions[p] for p in points[apart].tolist()]
        times[apart] = [len(p) for p in parts]
        starts = np.cumsum(times) - times
        codes, rows = np.repeat(codes, times), np.repeat(rows, times)
        for at, part in zip(starts[apart].tolist(), parts, strict=True):
            codes[at : at + len(part)] = part
    kept = codes > 0
    codes, rows = codes[kept].astype(np.uint64), rows[kept]
    counts = np.bincount(rows, minlength=len(texts))
    ends = np.cumsum(counts)
    place = np.repeat(ends, counts) - 1 - np.arange(len(codes))  # power of the base: the last code has power 0
    longest = 1 << int(counts.max(initial=1)).bit_length()
    full, out = np.flatnonzero(counts), []
    for base, prime in BASES:
        terms = codes * _powers(longest, base, prime)[place] % np.uint64(prime)
        sums = np.zeros(len(texts), np.uint64)
        if len(full):
            sums[full] = np.add.reduceat(terms, (ends - counts)[full]) % np.uint64(prime)
        out.append(sums)
    return counts, out


def rolling_hashes(column, block: int = BLOCK):
    """Two polynomial hashes per value of an Arrow string column as one number; NULL hashes as -1."""
    import numpy as np
    import pyarrow as pa

    n = len(column)
    counts, sums = np.zeros(n, np.int64), [np.zeros(n, np.uint64) for _ in BASES]

    def add(rows: list[int], pieces: list[str]) -> None:
        """Rolls pieces, each a row's next one, into the rows' hashes; a row has one piece at most."""
        more, parts = _piece_hashes(pieces)
        for (base, prime), total, part in zip(BASES, sums, parts, strict=True):
            if counts[rows].any():
                shift = np.array([pow(base, k, prime) for k in more.tolist()], np.uint64)
                part = (total[rows] * shift + part) % np.uint64(prime)
            total[rows] = part
        counts[rows] += more

    rows, pieces, room = [], [], 0
    for r, value in enumerate(column):
        text = value.as_py() or ""
        for k in range(0, len(text), block):
            piece = text[k : k + block]
            if rows and (room + len(piece) > block or rows[-1] == r):
                add(rows, pieces)
                rows, pieces, room = [], [], 0
            rows.append(r)
            pieces.append(piece)
            room += len(piece)
    if rows:
        add(rows, pieces)
    first, second = [((total + np.uint64(1)) * np.uint64(31) + counts.astype(np.uint64)) % np.uint64(prime) for (_, prime), total in zip(BASES, sums, strict=True)]
    both = (first.astype(np.int64) << 31) ^ second.astype(np.int64)
    if column.null_count:
        both[column.is_null().to_numpy(zero_copy_only=False)] = -1
    return pa.array(both)


def same_content(a: str | None, b: str | None, block: int = BLOCK) -> bool:
    """Two-pointer comparison of two texts that skips and folds on the way, a block at a time; NULL equals NULL only."""
    import numpy as np

    if a is None or b is None or a == b:
        return a is b or a == b

    def refilled(codes, text: str, at: int):
        while not len(codes) and at < len(text):
            codes, at = folded_codes(text[at : at + block]), at + block
        return codes, at

    left = right = np.empty(0, np.int32)
    i = j = 0
    while True:
        left, i = refilled(left, a, i)
        right, j = refilled(right, b, j)
        n = min(len(left), len(right))
        if not n:
            return len(left) == len(right)
        if not np.array_equal(left[:n], right[:n]):
            return False
        left, right = left[n:], right[n:]


def _hash(n: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            hashes = [rolling_hashes(batch.column(k + 1)) for k in range(n)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *hashes], [*batch.schema.names, *(f"h{k}" for k in range(n))])

    return run


def _verify(n: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            own, first = columns[1 : n + 1], columns[n + 2 : 2 * n + 2]
            same = [all(same_content(a[i], b[i]) for a, b in zip(own, first, strict=True)) for i in range(batch.num_rows)]
            digests = [None] * batch.num_rows
            for i, ok in enumerate(same):
                if not ok:  # a true collision: this row is grouped again by a digest of its folded codes
                    digest = hashlib.sha256()
                    for a in own:
                        digest.update(b"-" if a[i] is None else b"+")
                        for k in range(0, len(a[i] or ""), BLOCK):
                            digest.update(folded_codes(a[i][k : k + BLOCK]).tobytes())
                        digest.update(bytes(4))  # no code is 0
                    digests[i] = digest.hexdigest()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(n + 1), pa.array(same), pa.array(digests, pa.string())], ["id", "first_id", "same", "digest"])

    return run


def format_duplicates(df: DataFrame, id: str = "id", fields: tuple[str, ...] = ("subjectId", "languageTag", "value")) -> DataFrame:
    """Membership of duplicates: id_first (the smallest id of the group), id_copy (every other id of it).

    Records are copies if each field holds the same letters and digits in the same order, letter case aside; accents count,
    several on one letter in the order in which they are written (composed letters have Unicode's order). A NULL
    field equals a NULL field only, not an empty one. Rows with a NULL id take no part; a repeated id is one record unless
    its fields differ, in which case it belongs to several groups. Groups of one record give no row. Texts of any
    length are read whole. Other columns are left out.
    """
    n = len(fields)
    named = [f"f{k}" for k in range(n)]
    rows = df.select(F.col(id).cast("string").alias("id"), *[F.col(f).cast("string").alias(k) for f, k in zip(fields, named, strict=True)]).where("id is not null")
    schema = "id string, " + ", ".join(f"f{k} string" for k in range(n)) + ", " + ", ".join(f"h{k} bigint" for k in range(n))
    hashed = written(rows.mapInArrow(_hash(n), schema))  # read for the groups and again for their rows
    keys = [f"h{k}" for k in range(n)]
    first = hashed.groupBy(*keys).agg(F.min(F.struct("id", *named)).alias("first"), F.max("id").alias("last")).where("first.id <> last")
    first = first.select(*keys, F.col("first.id").alias("first_id"), *[F.col(f"first.{f}").alias(f"first_{f}") for f in named])
    pairs = hashed.join(first, keys).where("id <> first_id").select("id", *named, "first_id", *[f"first_{f}" for f in named])
    checked = written(pairs.mapInArrow(_verify(n), "id string, first_id string, same boolean, digest string"), "same")
    again = checked.where("not same").select("id", "digest")
    firsts = again.groupBy("digest").agg(F.min("id").alias("first_id"))
    rest = again.join(firsts, "digest").where("id <> first_id")
    return checked.where("same").select(F.col("first_id").alias("id_first"), F.col("id").alias("id_copy")).unionByName(rest.select(F.col("first_id").alias("id_first"), F.col("id").alias("id_copy"))).distinct()


def collapsed(df: DataFrame, id: str = "id", fields: tuple[str, ...] = ("subjectId", "languageTag", "value")) -> DataFrame:
    """One row per distinct record: id (the smallest of its group) and copies, the number of its ids.

    NULL ids are left out. Every id is counted once.
    """
    copies = format_duplicates(df, id, fields)
    ids = df.select(F.col(id).cast("string").alias("id")).where("id is not null").distinct()
    members = ids.join(copies, ids["id"] == copies["id_copy"], "left").select(F.coalesce("id_first", ids["id"]).alias("id"))
    return members.groupBy("id").agg(F.count("*").alias("copies"))
