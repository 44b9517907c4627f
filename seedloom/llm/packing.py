"""Filling containers of fixed capacity with items.

Method: a grouping genetic algorithm. An individual is a list of whole containers; crossover injects well-filled containers of
one parent into the other, removes the other's containers that would hold an item twice and puts the displaced items back by best
fit; mutation opens slack containers and refills each with the items that leave the least room. The items are cut at random into regions of bounded size, and each region is evolved on several islands, one task
each; after a round the islands' elites migrate to the next island of the region. The best individual of a region
counts. Its containers that stayed slack are opened, and their items are packed once more over regions of their own. An island
whose first individual needs no more containers than the total size asks for stops at once, as nothing can be better.
"""

from __future__ import annotations

import base64
import os
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from random import Random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.plans.lineage import written

#: Vocabulary of a public byte-level tokenizer; a parameter, never copied.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the public byte-level tokenizer cuts text before merging.
CUT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Items of a region; regions are drawn at random, so they have about as many.
REGION = 2000
ISLANDS, ROUNDS, POPULATION, GENERATIONS = 2, 2, 8, 20
#: Mutations of every child.
MUTATIONS = 4
#: A container filled less than this is opened once for the second pass.
SLACK = 0.98


def _lengths(vocabulary: str):
    def run(batches):
        import pyarrow as pa
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding(os.path.basename(vocabulary), pat_str=CUT, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            counts = [None if t is None else len(encoding.encode_ordinary(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["id", "size"])

    return run


def token_lengths(documents: DataFrame, id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """id and size, the number of tokens of each whole text; NULL for a NULL text."""
    kind = documents.schema[id].dataType.simpleString()
    return documents.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(_lengths(vocabulary), f"id {kind}, size bigint")


def _best_fit(order: list[int], sizes: list[int], capacity: int, bins: list[list[int]]) -> list[list[int]]:
    """Items in this order into the fullest container that has room, else a new one; ``bins`` is changed."""
    free = sorted((capacity - sum(sizes[i] for i in b), k) for k, b in enumerate(bins))
    for i in order:
        at = bisect_left(free, (sizes[i], -1))
        if at < len(free):
            room, k = free.pop(at)
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
        insort(free, (room - sizes[i], k))
    return bins


def _fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> float:
    return sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def _crossover(a: list[list[int]], b: list[list[int]], sizes: list[int], capacity: int, random: Random) -> list[list[int]]:
    """Well-filled containers of ``a`` injected into ``b``."""
    ranked = sorted(a, key=lambda x: sum(sizes[i] for i in x) * random.uniform(0.9, 1.0), reverse=True)
    injected = ranked[: max(1, int(len(a) * random.uniform(0.2, 0.6)))]
    held = {i for x in injected for i in x}
    child, displaced = [list(x) for x in injected], []
    for x in b:
        if held.isdisjoint(x):
            child.append(list(x))
        else:
            displaced.extend(i for i in x if i not in held)
    displaced.sort(key=sizes.__getitem__, reverse=True)
    return _best_fit(displaced, sizes, capacity, child)


def _refilled(loose: list[int], sizes: list[int], capacity: int) -> list[list[int]]:
    """Containers of loose items: the largest one left, then again and again the one or two that leave the least room."""
    left = sorted(((sizes[i], i) for i in loose))
    bins = []
    while left:
        room, first = left.pop()
        room, filled = capacity - room, [first]
        while left and left[0][0] <= room:
            best, pick = -1, ()
            top = bisect_left(left, (room + 1, -1))
            if top:
                best, pick = left[top - 1][0], (top - 1,)
            for k in range(top - 1, 0, -1):  # two that fit, the larger one at k
                if best == room or left[k][0] + left[k - 1][0] <= best:
                    break
                other = min(bisect_left(left, (room - left[k][0] + 1, -1)), k) - 1
                if other >= 0 and left[k][0] + left[other][0] > best:
                    best, pick = left[k][0] + left[other][0], (k, other)
            for k in pick:  # the larger place first
                room -= left[k][0]
                filled.append(left.pop(k)[1])
        bins.append(filled)
    return bins


def _mutated(bins: list[list[int]], sizes: list[int], capacity: int, random: Random) -> list[list[int]]:
    """The slackest containers, and a few others, are opened and their items put into others with as little room left as can be."""
    fills = [sum(sizes[i] for i in b) for b in bins]
    ranked = sorted(range(len(bins)), key=fills.__getitem__)
    few = 2 + len(bins) // 20
    slack = [k for k in ranked[: 3 * few] if fills[k] < capacity]
    opened = set(random.sample(slack, min(few, len(slack)))) | set(random.sample(range(len(bins)), min(len(bins), few)))
    loose = [i for k in sorted(opened) for i in bins[k]]
    again = _refilled(loose, sizes, capacity)
    if len(again) > len(opened):
        again = [bins[k] for k in opened]
    return [list(b) for k, b in enumerate(bins) if k not in opened] + again


def evolve(sizes: list[int], capacity: int, seed: int, elites: list[list[list[int]]], generations: int = GENERATIONS, population: int = POPULATION, keep: int = 2) -> list[list[list[int]]]:
    """The best ``keep`` individuals of an island after some generations, from elites that came in."""
    random = Random(seed)
    everything = range(len(sizes))
    least = max(1, -(-sum(sizes) // capacity))
    people = [[list(b) for b in e] for e in elites]
    if not people:
        people.append(_best_fit(sorted(everything, key=sizes.__getitem__, reverse=True), sizes, capacity, []))
    if min(map(len, people)) <= least:
        return [min(people, key=len)]
    while len(people) < population:
        factor = [random.uniform(0.7, 1.3) for _ in everything]
        people.append(_best_fit(sorted(everything, key=lambda i: sizes[i] * factor[i], reverse=True), sizes, capacity, []))
    ranked = sorted(((_fitness(p, sizes, capacity), k, p) for k, p in enumerate(people)), reverse=True)
    for _ in range(generations):
        children = []
        for _ in range(population // 2):
            a, b = (max(random.sample(ranked, 2))[2] for _ in range(2))
            child = _crossover(a, b, sizes, capacity, random)
            for _ in range(MUTATIONS):
                child = _mutated(child, sizes, capacity, random)
            children.append(child)
        ranked = sorted([*ranked, *((_fitness(c, sizes, capacity), -1 - k, c) for k, c in enumerate(children))], key=lambda x: x[0], reverse=True)[:population]
        ranked = [(f, k, p) for k, (f, _, p) in enumerate(ranked)]
        if len(ranked[0][2]) <= least:
            break
    return [p for _, _, p in ranked[:keep]]


def _labels(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


def _bins(labels: list[int]) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(max(labels, default=-1) + 1)]
    for i, k in enumerate(labels):
        out[k].append(i)
    return [b for b in out if b]


_STATE = "pack_id int, capacity bigint, region bigint, island int, sizes array<bigint>, elites array<array<int>>, done boolean"


def _island(turn: int, generations: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                incoming = [_bins(e) for e in [*(r["elites"] or []), *(r["migrants"] or [])]]
                if r["done"]:
                    best = incoming[:1]
                else:
                    seed = hash((r["pack_id"], r["region"], r["island"], turn))
                    best = evolve(r["sizes"], r["capacity"], seed, incoming, generations)
                least = max(1, -(-sum(r["sizes"]) // r["capacity"]))
                out.append({k: r[k] for k in ("pack_id", "capacity", "region", "island", "sizes")} | {"elites": [_labels(b, len(r["sizes"])) for b in best], "done": min(map(len, best)) <= least})
            fields = [("pack_id", pa.int32()), ("capacity", pa.int64()), ("region", pa.int64()), ("island", pa.int32()), ("sizes", pa.list_(pa.int64())), ("elites", pa.list_(pa.list_(pa.int32()))), ("done", pa.bool_())]
            yield pa.RecordBatch.from_pylist(out, pa.schema(fields))

    return run


def _pack(items: DataFrame, region_size: int, islands: int, rounds: int, generations: int) -> DataFrame:
    """items (pack_id, capacity, id, piece, size, draw) with region and bin; ``items`` is a written table."""
    regions = items.groupBy("pack_id").agg(F.greatest(F.lit(1), F.round(F.count("*") / region_size).cast("bigint")).alias("regions"))
    packs = {r.pack_id: r.regions for r in regions.collect()}  # one number per capacity
    if not packs:
        return items.withColumns({"region": F.lit(0).cast("bigint"), "bin": F.lit(0)}).drop("draw")
    number = F.create_map(*[x for p, n in packs.items() for x in (F.lit(p), F.lit(n))])
    drawn = items.withColumn("region", F.pmod(F.col("draw"), number[F.col("pack_id")]))
    grouped = drawn.groupBy("pack_id", "capacity", "region").agg(F.array_sort(F.collect_list(F.struct("draw", "id", "piece", "size"))).alias("members"))
    grouped = written(grouped)  # a row per region, of about region_size items
    lanes = grouped.select("pack_id", "capacity", "region", F.explode(F.array(*[F.lit(k) for k in range(islands)])).alias("island"), F.col("members.size").alias("sizes"))
    state = lanes.withColumns({"elites": F.lit(None).cast("array<array<int>>"), "done": F.lit(False), "migrants": F.lit(None).cast("array<array<int>>")})
    for turn in range(rounds):
        columns = ["pack_id", "capacity", "region", "island", "sizes", "elites", "migrants", "done"]
        spread = state.select(*columns).repartition("pack_id", "region", "island")  # one lane, not a whole file, is a task's unit
        state = written(spread.mapInArrow(_island(turn, generations), _STATE))
        if turn + 1 < rounds:
            moved = state.select("pack_id", "region", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), F.slice("elites", 1, 1).alias("migrants"))
            state = state.join(moved, ["pack_id", "region", "island"])
    bins = F.array_max(F.col("elites")[0])
    best = state.groupBy("pack_id", "region").agg(F.min(F.struct(bins.alias("bins"), "island", F.col("elites")[0].alias("labels"))).alias("best"))
    filled = grouped.join(best, ["pack_id", "region"])
    rows = filled.select("pack_id", "capacity", "region", F.explode(F.arrays_zip("members", F.col("best.labels").alias("labels"))).alias("m"))
    return rows.select("pack_id", "capacity", F.col("m.members.id").alias("id"), F.col("m.members.piece").alias("piece"), F.col("m.members.size").alias("size"), "region", F.col("m.labels").alias("bin"))


def containers(documents: DataFrame, packs: DataFrame, id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, measure: Callable[..., DataFrame] = token_lengths, region_size: int = REGION, islands: int = ISLANDS, rounds: int = ROUNDS, generations: int = GENERATIONS) -> DataFrame:
    """Assignment of every text to a container, for each capacity: pack_id, id, piece, n_tokens, container.

    A text longer than the capacity is cut into full pieces, each a container of its own, and a rest that is packed like a text;
    other texts have piece 0 only. NULL texts are left out, empty ones fill no room but have a place. Capacities that are NULL
    or below 1 are left out. A repeated id is packed as often as it is delivered. An empty table gives no rows. With 0 ``generations``
    the result is that of best fit alone.
    """
    lengths = written(measure(documents, id, text, vocabulary).where("size is not null"))
    sizes = packs.select(F.col("pack_id").cast("int").alias("pack_id"), F.col("capacity_tokens").cast("bigint").alias("capacity")).where("capacity > 0 and pack_id is not null").distinct().limit(1001).collect()
    if len(sizes) > 1000:
        raise ValueError("more than 1000 capacities")
    wanted = F.array(*[F.struct(F.lit(p.pack_id).alias("pack_id"), F.lit(p.capacity).alias("capacity")) for p in sizes]) if sizes else F.array().cast("array<struct<pack_id:int,capacity:bigint>>")
    # A row's place in the written table, not its id, draws the region: a repeated id can't make a region large.
    placed = lengths.withColumn("draw", F.xxhash64("_metadata.file_name", "_metadata.row_index"))
    items = placed.select("id", "size", "draw", F.inline(wanted))
    full = F.expr("cast(if(size > capacity, size div capacity, 0) as int)")
    items = items.withColumn("full", full).withColumn("rest", F.expr("if(size > capacity, size - full * capacity, size)"))
    cut = items.where("full > 0").select("pack_id", "id", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("piece"), "capacity", "draw")
    alone = cut.select("pack_id", "id", "piece", F.col("capacity").alias("n_tokens"), F.concat_ws("-", F.lit("full"), F.hex("draw"), "piece").alias("container"))
    open_items = written(items.where("rest > 0 or full = 0").select("pack_id", "capacity", "id", F.col("full").alias("piece"), F.col("rest").alias("size"), "draw"))
    parts = [alone]
    for level in ("a", "b"):
        packed = _pack(open_items, region_size, islands, rounds, generations)
        name = F.concat_ws("-", F.lit(level), "region", "bin").alias("container")
        if level == "a":
            packed = written(packed)
            fills = packed.groupBy("pack_id", "region", "bin").agg(F.sum("size").alias("filled"))
            packed = written(packed.join(fills, ["pack_id", "region", "bin"]).withColumn("slack", F.col("filled") < F.col("capacity") * SLACK), "slack")
            parts.append(packed.where("not slack").select("pack_id", "id", "piece", F.col("size").alias("n_tokens"), name))
            again = packed.where("slack").withColumn("draw", F.xxhash64("region", "bin", "id", "piece", "_metadata.row_index"))
            open_items = written(again.select("pack_id", "capacity", "id", "piece", "size", "draw"))
        else:
            parts.append(packed.select("pack_id", "id", "piece", F.col("size").alias("n_tokens"), name))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("pack_id", F.col("id").alias(id), "piece", "n_tokens", "container")
