"""Evaluation texts that leak into training text.

Method: latent semantic retrieval. Every document is cut into overlapping passages; document frequencies of the held-out
items' terms over all passages give TF-IDF vectors. A distributed randomised SVD (one pass over all passages: each task adds
up its part of A'A times a random matrix, the small sketch is summed by Spark and solved by the Nyström formula) gives the
latent space. A second map-only pass projects all passages, finds items by cosine to their own passages, and
checks each candidate exactly: longest run of shared words, longest common subsequence, and whether the item's answers (its
numbers and names) occur.

The terms are those of the held-out items, so the SVD has a fixed number of dimensions however large the corpus is;
other words can't add to a cosine. A passage with fewer words of that vocabulary than ``least_shared`` can't share that
many words with an item and is not projected; this loses no verbatim case.

Vectors are never made dense: a passage is the numbers of its terms, and its product with a matrix is a sum of rows. Held-out items
come to the driver a block at a time, of bounded size, and each block has a latent space and a search of its own, so there may be any number of them.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain, islice, repeat
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.plans.lineage import written

#: Words of a passage and of the step to the next: every run of up to WORDS - STEP words lies within one passage.
WORDS, STEP = 24, 12
#: Words of a passage of an item; they start at every word.
ITEM_WORDS = 12
#: Dimensions of the latent space, and surplus of the random sketch.
LATENT, SURPLUS = 192, 32
#: Cosine from which a passage is a candidate, calibrated so that every run of ITEM_WORDS shared words is one.
COSINE = 0.45
#: Consecutive words that make a verbatim leak.
RUN = 12
#: Share of an item's words in common order, and of its answers, that make a paraphrase.
PARAPHRASE, ANSWERS = 0.6, 0.5
#: Cosine from which a candidate that isn't verbatim is checked for a paraphrase.
NEAR = 0.6
#: Fewest words that a passage and an item can share.
LEAST_SHARED = 10
#: Passages that are projected at a time.
ROWS = 2000
#: Passages of a block of held-out items, which every task holds with their vectors; an item longer than that is a block by itself.
MOST_PASSAGES = 100_000
#: Numbers of a product of passages with held-out passages that are made at a time.
CELLS = 8_000_000

_WORD = re.compile(r"[^\W_]+")


def one_thread() -> None:
    """Keeps NumPy's linear algebra of this worker to one thread; a task has one core."""
    import ctypes
    from pathlib import Path

    import numpy  # noqa: F401 - its library has to be loaded

    maps = Path("/proc/self/maps")
    for library in {x.split()[-1] for x in maps.read_text().splitlines() if "openblas" in x} if maps.exists() else ():
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if call := getattr(ctypes.CDLL(library), name, None):
                call(1)


def words(text: str | None) -> list[str]:
    """Longest runs of letters and digits, in folded case."""
    if not text:
        return []
    return _WORD.findall((text if text.isascii() else unicodedata.normalize("NFC", text)).casefold())


class HeldOut:
    """A block of held-out items: their terms, passages and answers. Of bounded size: it is sent to every executor."""

    def __init__(self, items: list[tuple[int, str]]):
        texts = [(i, t, w) for i, t in items if (w := words(t))]
        self.ids = [i for i, _, _ in texts]  # an item goes by its place, so that an id with two texts is two items
        self.items = [w for _, _, w in texts]
        self.terms = {t: k for k, t in enumerate(sorted({x for w in self.items for x in w}))}
        self.passages = [(i, w[k : k + ITEM_WORDS]) for i, w in enumerate(self.items) for k in range(max(1, len(w) - ITEM_WORDS + 1))]
        self.answers = []
        for _, text, found in texts:
            named = {w.casefold() for k, w in enumerate(_WORD.findall(unicodedata.normalize("NFC", text))) if k and w[:1].isupper()}
            self.answers.append({w for w in found if any(map(str.isdigit, w))} | named)
        self.runs: dict[tuple[str, ...], set[int]] = {}
        for i, w in enumerate(self.items):
            for k in range(len(w) - RUN + 1):
                self.runs.setdefault(tuple(w[k : k + RUN]), set()).add(i)

    def shared_runs(self, found: list[str]) -> set[int]:
        """Items that share a run of RUN words with a text; only runs of the items' own words are looked up."""
        terms, runs, out, length = self.terms, self.runs, set(), 0
        for k, w in enumerate(found):
            length = length + 1 if w in terms else 0
            if length >= RUN:
                out |= runs.get(tuple(found[k - RUN + 1 : k + 1]), set())
        return out

    def codes(self, found: list[str]):
        """Term numbers of a word list, -1 for other words, as an array."""
        import numpy as np

        return np.fromiter(map(self.terms.get, found, repeat(-1)), np.int32, len(found))

    def blocks(self):
        """Term numbers of the items' own passages, ITEM_WORDS columns filled up with -1."""
        import numpy as np

        out = np.full((len(self.passages), ITEM_WORDS), -1, np.int32)
        for r, (_, p) in enumerate(self.passages):
            out[r, : len(p)] = self.codes(p)
        return out


def _passages(texts: list[str | None], held: HeldOut):
    """Passages of a batch of texts: (words of each text, text of each passage, its start, its term numbers).

    A passage has WORDS columns, filled up with -1; a text without words has none.
    """
    import numpy as np

    found = [words(t) for t in texts]
    n = np.fromiter(map(len, found), np.int64, len(found))
    passages = np.where(n <= WORDS, np.minimum(n, 1), -(-(n - WORDS) // STEP) + 1)
    room = np.where(passages > 0, (passages - 1) * STEP + WORDS, 0)  # padded length of each text
    begin = np.cumsum(room) - room
    padded = np.full(int(room.sum()) + 1, -1, np.int32)
    padded[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] = held.codes(list(chain.from_iterable(found)))
    text = np.repeat(np.arange(len(found)), passages)
    start = (np.arange(len(text)) - np.repeat(np.cumsum(passages) - passages, passages)) * STEP
    return found, text, start, padded[(begin[text] + start)[:, None] + np.arange(WORDS)]


def _known(texts: list[str | None], held: HeldOut):
    """The same without passages that have too few words of the held-out items' vocabulary."""
    found, text, start, block = _passages(texts, held)
    enough = (block >= 0).sum(axis=1) >= LEAST_SHARED
    return found, text[enough], start[enough], block[enough]


def _weighted(matrix, idf):
    """Rows of a matrix by term, weighted, and a row of zeros at the end, which -1 picks."""
    import numpy as np

    return np.vstack([matrix * idf[:, None], np.zeros((1, matrix.shape[1]))]).astype(np.float32)


def _product(block, weighted):
    """Product of the TF-IDF rows of passages with a weighted matrix: the sum of the rows of their terms."""
    import numpy as np

    out = np.zeros((len(block), weighted.shape[1]), np.float32)
    for k in range(block.shape[1]):
        out += weighted[block[:, k]]
    return out


def _add_back(total, block, product, idf) -> None:
    """Adds the product of the passages' TF-IDF rows, turned, with ``product`` to ``total``."""
    import numpy as np

    codes = block.ravel()
    order = np.argsort(codes, kind="stable")[np.count_nonzero(codes < 0) :]
    if len(order):
        met = codes[order]
        first = np.flatnonzero(np.append(True, met[1:] != met[:-1]))
        total[met[first]] += idf[met[first], None] * np.add.reduceat(product[order // block.shape[1]], first, axis=0)


def _frequencies(shared):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = shared.value
        counts, n = np.zeros(len(held.terms) + 1, np.int64), 0
        for batch in batches:
            _, _, _, block = _passages(batch.column(0).to_pylist(), held)
            n += len(block)
            ordered = np.sort(block, axis=1)
            new = np.ones(ordered.shape, bool)
            new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
            counts += np.bincount(ordered[new] + 1, minlength=len(counts))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts)) - 1), pa.array(np.append(n, counts[1:]))], ["term", "n"])

    return run


#: Rows of a sketch that are summed as one.
PART = 500


def _sketch(shared, space):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        one_thread()
        held, (idf, omega) = shared.value, space.value
        weighted = _weighted(omega, idf)
        total, n = np.zeros(omega.shape), 0
        for batch in batches:
            _, _, _, block = _known(batch.column(0).to_pylist(), held)
            n += len(block)
            for k in range(0, len(block), ROWS):
                _add_back(total, block[k : k + ROWS], _product(block[k : k + ROWS], weighted), idf)
        if n:
            parts = [*(total[k : k + PART].astype(np.float32) for k in range(0, len(total), PART)), np.array([n], np.float32)]
            for k, part in enumerate(parts):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([part.tobytes()], pa.binary())], ["part", "data"])

    return run


def _summed(table):
    import numpy as np
    import pyarrow as pa

    total = np.zeros(len(table["data"][0].as_py()) // 4)
    for data in table["data"]:
        total += np.frombuffer(data.as_buffer(), np.float32)
    return pa.table({"part": table["part"][:1], "data": pa.array([total.tobytes()], pa.binary())})


def latent_space(documents: DataFrame, shared, text: str = "text", seed: int = 11):
    """(idf, basis) of the latent space: terms by dimensions, from all passages of the corpus and those of the held-out items.

    ``shared`` is the broadcast :class:`HeldOut`. Both sides weigh the same. The driver gets one number per term and then a sketch of terms by LATENT + SURPLUS.
    """
    import numpy as np

    spark, held = documents.sparkSession, shared.value
    rows = documents.select(text).where(F.col(text).isNotNull())
    d = len(held.terms)
    table = rows.mapInArrow(_frequencies(shared), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(d + 1)
    if table.num_rows:
        counts[table["term"].to_numpy() + 1] = table["n"].to_numpy()
    idf = np.array([log((counts[0] + 2) / (c + 1)) + 0.1 for c in counts[1:]], np.float32)
    width = min(d, LATENT + SURPLUS)
    omega = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0].astype(np.float32)
    space = spark.sparkContext.broadcast((idf, omega))
    table = rows.mapInArrow(_sketch(shared, space), "part bigint, data binary").groupBy("part").applyInArrow(_summed, "part bigint, data binary").toArrow()
    sketch, n = np.zeros((d, width)), 0.0
    for k, data in zip(table["part"].to_pylist(), table["data"].to_pylist(), strict=True):
        part = np.frombuffer(data)
        if k * PART < d:
            sketch[k * PART : (k + 1) * PART] = part.reshape(-1, width)
        else:
            n = float(part[0])
    own, total = held.blocks(), np.zeros((d, width))
    weighted = _weighted(omega, idf)
    for k in range(0, len(own), ROWS):
        _add_back(total, own[k : k + ROWS], _product(own[k : k + ROWS], weighted), idf)
    sketch = sketch / max(n, 1.0) + total / max(len(own), 1)
    # Nyström: A'A is near Y (Ω'Y)^-1 Y', shifted a little so that the root exists.
    shift = np.finfo(float).eps ** 0.5 * max(np.linalg.norm(sketch), 1e-12)
    shifted = sketch + shift * omega
    core = omega.T @ shifted
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, shift))
    basis = np.linalg.svd(shifted @ root, full_matrices=False)[0][:, :LATENT]
    space.unpersist()
    return idf, basis.astype(np.float32)


def _unit(z):
    import numpy as np

    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
    return z


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by bits."""
    at: dict[str, int] = {}
    for k, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        met = row & at.get(w, 0)
        row = (row + met) | (row - met)
        row &= full
    return len(a) - row.bit_count()


def longest_run(found: list[str], item: list[str]) -> int:
    """Length of the longest run of words that both texts share."""
    places: dict[str, list[int]] = {}
    for k, w in enumerate(item):
        places.setdefault(w, []).append(k)
    best, before = 0, {}
    for w in found:
        now = {k: before.get(k - 1, 0) + 1 for k in places.get(w, ())}
        if now:
            best = max(best, max(now.values()))
        before = now
    return best


_OUT = "item_id bigint, cosine double, run bigint, common bigint, answers double, kind string"


def _search(shared, space, cosine: float):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        one_thread()
        held, (weighted, queries, order, bounds) = shared.value, space.value
        wide = max(1, CELLS // ROWS)
        parts = [0]  # items of a product, whole ones, with about as many passages as fit
        while parts[-1] < len(order):
            parts.append(max(parts[-1] + 1, int(np.searchsorted(bounds, bounds[parts[-1]] + wide, side="right")) - 1))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found, docs, starts, block = _known(texts, held)
            best: dict[tuple[int, int], list[tuple[float, int]]] = {}
            for k in range(0, len(docs), ROWS):
                z = _unit(_product(block[k : k + ROWS], weighted))
                for a, b in zip(parts, parts[1:], strict=False):
                    near = np.maximum.reduceat(z @ queries[:, bounds[a] : bounds[b]], bounds[a:b] - bounds[a], axis=1)
                    for r, c in np.argwhere(near >= cosine).tolist():
                        kept, one = best.setdefault((int(docs[k + r]), int(order[a + c])), []), (float(near[r, c]), int(starts[k + r]))
                        if one[0] >= NEAR:  # any of these may be the paraphrase
                            kept.append(one)
                        elif not kept or kept[0][0] < min(one[0], NEAR):
                            kept[:1] = [one]
            rows, before, whole = [], -1, set()
            for (d, item), passages in sorted(best.items()):
                if d != before:  # a document's candidates come one after the other
                    before, whole = d, held.shared_runs(found[d])
                checked = (_checked(held, found[d], d, item, cos, start, item in whole) for cos, start in sorted(passages, key=lambda p: (-p[0], p[1])))
                rows += list(islice(filter(None, checked), 1))  # of the nearest passage that passes
            columns = list(zip(*rows, strict=True)) or [[] for _ in range(7)]
            ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns[1:], (pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.string()), strict=True)]], ["id", "item_id", "cosine", "run", "common", "answers", "kind"])

    return run


def _checked(held: HeldOut, found: list[str], d: int, item: int, cosine: float, start: int, verbatim: bool):
    """The row of a candidate's passage if it is a verbatim leak or a paraphrase."""
    wanted = held.items[item]
    if not verbatim and cosine < NEAR:
        return None
    near = found[max(0, start - len(wanted)) : start + WORDS + len(wanted)]
    here = set(near)
    answers = held.answers[item]
    share = len(answers & here) / len(answers) if answers else 1.0
    # A paraphrase needs its answers, and a common subsequence can't be longer than the words that are there at all.
    if not verbatim and (share < ANSWERS or sum(w in here for w in wanted) < PARAPHRASE * len(wanted)):
        return None
    common = common_subsequence(wanted, near)
    if verbatim:
        return d, held.ids[item], cosine, longest_run(found, wanted), common, share, "verbatim"
    if common >= PARAPHRASE * len(wanted):
        return d, held.ids[item], cosine, longest_run(near, wanted), common, share, "paraphrase"
    return None


def leaks(documents: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", cosine: float = COSINE) -> DataFrame:
    """Documents that contain held-out items: id, item_id, cosine, run, common, answers, kind (verbatim or paraphrase).

    ``run`` is the longest run of shared words, ``common`` the length of the longest common subsequence around
    the passage, ``answers`` the share of the item's numbers and names found there. A verbatim leak shares at least RUN consecutive
    words. NULL and empty texts, and items without words, give no rows; a repeated document gives its rows
    again, and an item_id with several texts gives a row for each. Without items or documents the result is empty. Other columns are left out.
    """
    chosen = items.select(item_id, item_text).where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).distinct()
    kind = documents.schema[id].dataType.simpleString()
    rows = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    parts = []
    for held in blocks_of_items(((int(r[0]), r[1]) for r in chosen.toLocalIterator()), MOST_PASSAGES):
        if parts:  # several blocks are written one by one, so that no plan holds them all
            parts[-1] = written(parts[-1])
        parts.append(_leaks_of(rows, held, cosine, kind))
    if not parts:
        return documents.sparkSession.createDataFrame([], f"{id} {kind}, {_OUT}")
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("id", id)


def blocks_of_items(items: Iterable[tuple[int, str]], most: int) -> Iterator[HeldOut]:
    """Held-out items in blocks of at most ``most`` passages; blocks without a word are left out."""
    block, passages = [], 0
    for i, text in items:
        n = max(1, len(words(text)) - ITEM_WORDS + 1)
        if block and passages + n > most:
            yield HeldOut(block)
            block, passages = [], 0
        if words(text):
            block.append((i, text))
            passages += n
    if block:
        yield HeldOut(block)


def _leaks_of(rows: DataFrame, held: HeldOut, cosine: float, kind: str) -> DataFrame:
    """Leaks of one block of items in rows of id and text."""
    import numpy as np

    context = rows.sparkSession.sparkContext
    shared = context.broadcast(held)
    idf, basis = latent_space(rows, shared)
    weighted, own = _weighted(basis, idf), held.blocks()
    owners = np.array([i for i, _ in held.passages])  # passages of an item are neighbours
    first = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
    queries = np.concatenate([_unit(_product(own[k : k + ROWS], weighted)) for k in range(0, len(own), ROWS)]).T.copy()
    space = context.broadcast((weighted, queries, owners[first], np.append(first, len(owners))))
    return rows.mapInArrow(_search(shared, space, cosine), f"id {kind}, {_OUT}")


def reworded(text: Column) -> Column:
    """A text in other words, to measure the search with: of every eight words the third and the seventh become another one, or get one after them
    where they hold a digit or begin with a capital, and the fifth is left out unless it does; numbers and names stay, as a paraphrase keeps them.
    """
    parts = F.split(text, r"\s+")

    def changed(w: Column, i: Column) -> Column:
        keeps = w.rlike(r"[0-9]|^\p{Lu}")
        other = F.element_at(F.array(*[F.lit(x) for x in ("indeed", "roughly", "whereby", "perhaps", "namely")]), (i % 5 + 1).cast("int"))
        return F.when(i % 4 == 2, F.when(keeps, F.concat_ws(" ", w, other)).otherwise(other)).when((i % 8 == 4) & ~keeps, F.lit("")).otherwise(w)

    return F.array_join(F.transform(parts, changed), " ")
