"""Reports and resolutions over evidence records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedloom.plans.lineage import cut


def coverage(df: DataFrame, metrics: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """Counts of metrics with their denominator: groups, metric, covered, denominator. One pass; NULL counts as not covered."""
    named = {name: F.count_if(c).alias(f"m{i}") for i, (name, c) in enumerate(metrics.items())}
    sums = df.groupBy(*(by or [])).agg(F.count("*").alias("denominator"), *named.values())
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("metric"), F.col(f"m{i}").alias("covered")) for i, name in enumerate(metrics)]))
    return sums.select(*(by or []), rows.alias("r"), "denominator").select(*(by or []), "r.metric", "r.covered", "denominator")


def coverage_of(items: DataFrame, marks: DataFrame, id: str) -> DataFrame:
    """How many of the distinct ``items`` each metric of ``marks`` (metric, id) covers: metric, covered, denominator. Marks of other ids or without a metric count nothing."""
    met = marks.where(F.col("metric").isNotNull()).distinct().join(items.select(id), id, "left_semi")
    return met.groupBy("metric").agg(F.count("*").alias("covered")).join(items.agg(F.count("*").alias("denominator")))  # the second is one row


def rule_details(rules: DataFrame, contexts: DataFrame, plants: DataFrame) -> DataFrame:
    """Rules with what their context and target say: id, action, contextId, growingSystem, propagation, target, kind, taxonId; ids of contexts and plants are unique."""
    there = contexts.select(F.col("id").alias("contextId"), "growingSystem", "propagation")
    taxa = plants.select(F.col("id").alias("plantConceptId"), "taxonId")
    kind = F.when(F.col("plantConceptId").isNotNull(), "plant-concept").when(F.col("cultivarId").isNotNull(), "cultivar")
    joined = rules.join(there, "contextId", "left").join(taxa, "plantConceptId", "left")
    return joined.select("id", "action", "contextId", "growingSystem", "propagation", F.coalesce("plantConceptId", "cultivarId").alias("target"), kind.alias("kind"), "taxonId")


def notices(evidence: DataFrame, used: DataFrame, sources: DataFrame) -> DataFrame:
    """A notice per source, release and licence: sourceId, name, publisher, homepage, release, licenceId, records (distinct ids of evidence that is used).

    ``evidence`` has id, sourceId, release, licenceId; ``used`` distinct ids; ``sources`` unique ids. Unused evidence and evidence without source make none.
    """
    counted = evidence.where("sourceId is not null").distinct().join(used, "id", "left_semi").groupBy("sourceId", "release", "licenceId").agg(F.count_distinct("id").alias("records"))
    named = counted.join(sources.select(F.col("id").alias("sourceId"), "name", "publisher", "homepage"), "sourceId", "left")
    return named.select("sourceId", "name", "publisher", "homepage", "release", "licenceId", "records")


def notice_line() -> Column:
    """A notice as a line of the attribution page."""
    part = lambda before, c: F.coalesce(F.concat(F.lit(before), F.col(c)), F.lit(""))
    return F.concat(
        F.coalesce("name", "sourceId"), part(", ", "publisher"), part(", release ", "release"), part(", ", "homepage"),
        F.lit(". Licence: "), F.coalesce("licenceId", F.lit("unknown")), F.lit(". Records: "), F.col("records").cast("string"),
    )


def attribution(df: DataFrame, by: list[str], record: str) -> DataFrame:
    """One notice per group with its distinct records in order: groups, included. Records that are NULL make no notice.

    Pairs are made distinct before they are listed, so repeated rows of a hot group shrink first.
    """
    pairs = df.select(*by, F.col(record).alias("__r")).where("__r is not null").distinct()
    return pairs.groupBy(*by).agg(F.array_sort(F.collect_list("__r")).alias("included"))


def contradictions(df: DataFrame, by: list[str], value: Column) -> DataFrame:
    """Groups that hold different values: groups, different. NULL values are none."""
    pairs = df.select(*by, value.alias("__v")).where("__v is not null").distinct()
    return pairs.groupBy(*by).agg(F.count("*").alias("different")).where("different > 1")


def more_than_one(df: DataFrame, by: list[str], flag: Column) -> DataFrame:
    """Groups in which a flag is set more than once: groups, n."""
    return df.groupBy(*by).agg(F.count_if(flag).alias("n")).where("n > 1")


def best_of(df: DataFrame, by: list[str], order: list[Column], keep: list[str]) -> DataFrame:
    """The least row of each group by ``order`` and then by ``keep``: groups and kept columns. Combines before the shuffle."""
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    best = df.groupBy(*by).agg(F.min(rank).alias("__best"))
    return best.select(*by, *[F.col(f"__best.k{i}").alias(c) for i, c in enumerate(keep)])


def name_fallback(subjects: DataFrame, names: DataFrame, wanted: str, subject: str = "subject", language: str = "language", value: str = "value", preferred: str = "preferred", scientific: str = "scientificName") -> DataFrame:
    """A name per subject: in the wanted language, else a preferred one of another, else the scientific name.

    Preferred names go first within a language; ties go by language and then by value. Columns: subject, name, language
    (NULL for the scientific name).
    """
    usable = names.where(F.col(value).isNotNull() & F.col(subject).isNotNull() & (F.col(language).eqNullSafe(F.lit(wanted)) | F.coalesce(F.col(preferred), F.lit(False))))
    flag = lambda c: F.when(F.coalesce(c, F.lit(False)), 0).otherwise(1)
    best = best_of(usable, [subject], [flag(F.col(language) == wanted), flag(F.col(preferred))], [language, value])
    return subjects.select(subject, scientific).join(best, subject, "left").select(subject, F.coalesce(value, scientific).alias("name"), F.col(language).alias("language"))


def latest(df: DataFrame, by: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """The row of each group that supersedes the others: the greatest by ``order`` and then by ``keep``; NULLs are least."""
    rank = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)])
    best = df.groupBy(*by).agg(F.max(rank).alias("__best"))
    return best.select(*by, *[F.col(f"__best.k{i}").alias(c) for i, c in enumerate(keep)])


def resolve_replacements(df: DataFrame, id: str = "id", replacement: str = "replacement") -> DataFrame:
    """What each record is finally replaced by: id, final, steps; final is NULL if the chain runs into a cycle.

    Ids are unique. Pointers are doubled, so a chain of n needs log2(n) joins; each round is checkpointed. A record
    without replacement is its own final one; a replacement that is no record ends the chain there. Records are in a cycle or lead
    to one if they have not ended after more steps than there are records.
    """
    rows = df.select(F.col(id).alias("id"), F.coalesce(F.col(replacement), F.col(id)).alias("to"))
    state = rows.select("id", "to", F.when(F.col("to") == F.col("id"), 0).otherwise(1).cast("bigint").alias("steps"))
    ends = rows.where("to = id").select(F.col("id").alias("end_id"))
    reached, records = 1, df.count()
    while True:
        ahead = state.select(F.col("id").alias("to"), F.col("to").alias("beyond"), F.col("steps").alias("more"))
        state = cut(state.join(ahead, "to", "left").select("id", F.coalesce("beyond", "to").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")))
        reached *= 2
        open_rows = state.join(ends, state["to"] == ends["end_id"], "left_anti").join(rows.select(F.col("id").alias("known")), F.col("to") == F.col("known"), "left_semi")
        if open_rows.isEmpty() or reached > 2 * records:
            break
    cyclic = open_rows.select(F.col("id").alias("cyclic_id"))
    out = state.join(cyclic, state["id"] == cyclic["cyclic_id"], "left")
    return out.select(F.col("id").alias(id), F.when(F.col("cyclic_id").isNull(), F.col("to")).alias("final"), F.when(F.col("cyclic_id").isNull(), F.col("steps")).alias("steps"))


def exclusions(df: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """Rows with the first reason, in the given order, that excludes them; NULL conditions exclude nothing."""
    picked = reduce(lambda c, r: c.when(F.coalesce(r[1], F.lit(False)), r[0]), reasons.items(), F)
    return df.withColumn("reason", picked).where("reason is not null")


def generic_facts(assertions: DataFrame, cultivars: DataFrame) -> DataFrame:
    """Predicates of plant concepts: plantConceptId, predicate, limitation.

    Facts of a cultivar never widen to its plant concept: where only cultivars have a predicate, the row says ``cultivar-only``
    instead of NULL. ``assertions`` has subjectType, subjectId, predicate; ``cultivars`` has id, plantConceptId.
    """
    own = assertions.where("subjectType = 'plant-concept'").select(F.col("subjectId").alias("plantConceptId"), "predicate", F.lit(0).alias("far"))
    below = assertions.where("subjectType = 'cultivar'").select(F.col("subjectId").alias("id"), "predicate").distinct()
    below = below.join(cultivars.select("id", "plantConceptId").distinct(), "id").select("plantConceptId", "predicate", F.lit(1).alias("far"))
    nearest = own.unionByName(below).where("plantConceptId is not null and predicate is not null").groupBy("plantConceptId", "predicate").agg(F.min("far").alias("far"))
    return nearest.select("plantConceptId", "predicate", F.when(F.col("far") == 1, "cultivar-only").alias("limitation"))


def normalised_units(df: DataFrame, value: str, unit: str, factors: dict[str, tuple[str, float]]) -> DataFrame:
    """Values in their base unit, with the original kept: adds base_value and base_unit; unknown units leave both NULL."""
    known = F.create_map(*[x for u, (base, factor) in factors.items() for x in (F.lit(u), F.struct(F.lit(base).alias("base"), F.lit(float(factor)).alias("factor")))])
    rule = known[F.lower(F.trim(F.col(unit)))]
    return df.withColumns({"base_value": F.col(value) * rule["factor"], "base_unit": rule["base"]})


def reconciled(names: DataFrame, registry: DataFrame, name: str, key: str, canonical: Column) -> tuple[DataFrame, DataFrame]:
    """Names matched to registry entries on a normalised form, and the names that match none or several (issues)."""
    known = registry.select(canonical.alias("__form"), F.col(key).alias("__key")).where("__form is not null").distinct()
    unique = known.groupBy("__form").agg(F.min("__key").alias(key), F.count("*").alias("__n"))
    joined = names.withColumn("__form", canonical).join(unique, "__form", "left")
    resolved = joined.where("__n = 1").drop("__form", "__n")
    issues = joined.where("__n is null or __n > 1").select(name, F.when(F.col("__n").isNull(), "unresolved").otherwise("ambiguous").alias("issue"))
    return resolved, issues


def ranked(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group, with rank; Spark keeps only ``n`` rows per group before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)
