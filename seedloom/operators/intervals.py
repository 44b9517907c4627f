"""Overlapping and gapped intervals by a sweep line.

Every interval gives a plus event at its start and a minus event after its end. Events are summed per key and point
before the shuffle, so a hot key shrinks to the number of its distinct points; a prefix sum over the points gives the
number of active intervals. Where it leaves zero a period begins, where it returns to zero a gap begins. If a key can
have very many points, ``bucket`` cuts the line: prefix sums run within (key, bucket) in parallel and the buckets'
totals, one row each, are carried over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A circle can't have more points than this, as a key's points on it are one task's work.
MOST_POINTS = 1_000_000


def boundary_events(df: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Summed events per key and point: keys, point, delta; intervals are closed and whole-numbered."""
    events = df.select(*keys, F.explode(F.array(F.struct(F.col(start).cast("bigint").alias("point"), F.lit(1).alias("d")), F.struct((F.col(end).cast("bigint") + 1).alias("point"), F.lit(-1).alias("d")))).alias("e"))
    return events.groupBy(*keys, F.col("e.point").alias("point")).agg(F.sum("e.d").alias("delta")).where("delta <> 0")


def _running(events: DataFrame, keys: list[str], bucket: int | None) -> DataFrame:
    if bucket is None:
        return events.withColumn("active", F.sum("delta").over(Window.partitionBy(*keys).orderBy("point")))
    events = events.withColumn("bucket", F.floor(F.col("point") / bucket))
    totals = events.groupBy(*keys, "bucket").agg(F.sum("delta").alias("total"))
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("carried", F.coalesce(F.sum("total").over(before), F.lit(0))).drop("total")
    inside = F.sum("delta").over(Window.partitionBy(*keys, "bucket").orderBy("point"))
    return events.withColumn("active", inside).join(totals, [*keys, "bucket"]).withColumn("active", F.col("active") + F.col("carried")).drop("carried")


def _next_point(turns: DataFrame, keys: list[str], bucket: int | None) -> DataFrame:
    if bucket is None:
        return turns.withColumn("next", F.lead("point").over(Window.partitionBy(*keys).orderBy("point")))
    firsts = turns.groupBy(*keys, "bucket").agg(F.min("point").alias("first"))
    firsts = firsts.withColumn("following", F.lead("first").over(Window.partitionBy(*keys).orderBy("bucket"))).drop("first")
    inside = F.lead("point").over(Window.partitionBy(*keys, "bucket").orderBy("point"))
    return turns.withColumn("next", inside).join(firsts, [*keys, "bucket"]).withColumn("next", F.coalesce("next", "following")).drop("following")


def periods_and_gaps(df: DataFrame, keys: list[str], start: str = "start", end: str = "end", bucket: int | None = None) -> DataFrame:
    """Continuous periods and the gaps between them on a line: keys, kind (period or gap), start, end.

    Intervals are closed and whole-numbered; neighbouring points are continuous. Intervals with a NULL bound or that end
    before they start are left out; rows with a NULL key form a group like any other. Repeated intervals
    change nothing. The line before the first and after the last period is no gap. An empty input gives no rows. Columns of
    ``df`` other than the keys and bounds are left out.
    """
    named = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)], F.col(start).alias("s"), F.col(end).alias("e")).where("s <= e")
    # NULL keys would not meet in the joins of the bucketed way: they are carried as (is null, value).
    if bucket is not None:
        rows = rows.select(*[F.struct(F.col(n).isNull().alias("n"), F.coalesce(F.col(n).cast("string"), F.lit("")).alias("v"), F.col(n).alias("x")).alias(n) for n in named], "s", "e")
        marks = [c for n in named for c in (f"{n}_n", f"{n}_v")]
        originals = rows.select(*[F.col(f"{n}.{p}").alias(f"{n}_{p}") for n in named for p in ("n", "v", "x")], "s", "e")
        turned = _sweep(originals.drop(*[f"{n}_x" for n in named]), marks, bucket)
        schema = dict(df.dtypes)
        return turned.select(*[F.when(~F.col(f"{n}_n"), F.col(f"{n}_v")).cast(schema[k]).alias(k) for k, n in zip(keys, named, strict=True)], "kind", "start", "end")
    return _sweep(rows, named, None).select(*[F.col(n).alias(k) for k, n in zip(keys, named, strict=True)], "kind", "start", "end")


def _sweep(rows: DataFrame, keys: list[str], bucket: int | None) -> DataFrame:
    return _swept(boundary_events(rows, keys, "s", "e"), keys, bucket)


def _swept(events: DataFrame, keys: list[str], bucket: int | None) -> DataFrame:
    active = _running(events, keys, bucket)
    opens, closes = (F.col("active") > 0) & (F.col("active") == F.col("delta")), F.col("active") == 0
    turns = _next_point(active.where(opens | closes), keys, bucket)
    return turns.where("next is not null").select(*keys, F.when(F.col("active") > 0, "period").otherwise("gap").alias("kind"), F.col("point").alias("start"), (F.col("next") - 1).alias("end"))


def circular_periods_and_gaps(df: DataFrame, keys: list[str], start: str, end: str, low: int, high: int) -> DataFrame:
    """Periods and gaps on the circle of the points ``low`` to ``high``: keys, kind, start, end.

    A window whose start is after its end runs over the turn. Windows with a NULL bound or one outside the circle are left
    out. A fully covered circle is one period from ``low`` to ``high``; a period or gap over the turn has a start
    after its end. NULL keys form a group like any other; an empty input gives no rows.
    """
    if not 0 <= high - low < MOST_POINTS:
        raise ValueError(f"a circle has 1 to {MOST_POINTS} points")
    n = high - low + 1
    named = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(k0) for k, k0 in zip(keys, named, strict=True)], F.col(start).cast("int").alias("s"), F.col(end).cast("int").alias("e")).where(f"s between {low} and {high} and e between {low} and {high}")
    # The circle is laid out three times on a line. What starts in the middle turn has all of its neighbours there; only what covers a whole
    # turn, which nothing else can, starts before it and goes on to the end. Events are repeated after they have been summed and shuffled.
    over = F.when(F.col("s") > F.col("e"), n).otherwise(0)
    events = boundary_events(rows.withColumn("e", F.col("e") + over), named, "s", "e").repartition(*named)
    turns = F.explode(F.transform(F.array(F.lit(0), F.lit(n), F.lit(2 * n)), lambda t: F.col("point") + t)).alias("point")
    events = events.select(*named, turns, "delta").groupBy(*named, "point").agg(F.sum("delta").alias("delta")).where("delta <> 0")
    line = _swept(events, named, None)
    whole = F.col("end") - F.col("start") + 1 >= n
    place = lambda c: (F.lit(low) + F.pmod(F.col(c) - low, F.lit(n))).cast("int")
    chosen = line.where(whole | F.col("start").between(low + n, low + 2 * n - 1))
    first, last = F.when(whole, low).otherwise(place("start")), F.when(whole, high).otherwise(place("end"))
    return chosen.select(*[F.col(k0).alias(k) for k, k0 in zip(keys, named, strict=True)], "kind", first.alias("start"), last.alias("end"))
