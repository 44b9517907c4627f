"""Identity and references across tables.

The general operators work on any tables; :func:`dataset_issues` puts them together for a catalogue whose records are VARIANTs.
Repeated keys are found by an aggregate that combines before the shuffle and a join back, not by a window over a key, so that a
key with a third of all rows isn't one task's work; missing references are left anti joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Issue codes.
DUPLICATE_ID, MISSING_REFERENCE, INVALID_SCOPE, NOT_DISTINCT = "DUPLICATE_ID", "MISSING_REFERENCE", "INVALID_SCOPE", "CULTIVAR_RULES_NOT_DISTINCT"


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once: keys, occurrences. Keys with a NULL part are no keys."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(known).groupBy(*keys).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def repeated_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of ``df`` after the first of their key by ``order``, a unique column; n rows of a key give n - 1."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    firsts = df.where(known).groupBy(*keys).agg(F.min(order).alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    return df.join(firsts, keys).where(F.col(order) > F.col("__first")).drop("__first")


def missing_references(df: DataFrame, field: str, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose non-NULL ``field`` has no row in ``target``."""
    ids = target.select(F.col(key).alias("__id")).where("__id is not null")
    return df.where(F.col(field).isNotNull()).join(ids, F.col(field) == F.col("__id"), "left_anti")


def missing_list_references(df: DataFrame, field: str, target: DataFrame, key: str, element: str = "reference") -> DataFrame:
    """One row per element of a list column that has no row in ``target``: the columns of ``df``, place, and the element.

    Repeated elements give repeated rows; NULL elements and NULL lists none.
    """
    rows = df.select("*", F.posexplode(field).alias("place", element))
    return missing_references(rows, element, target, key)


def unresolved_scopes(df: DataFrame, kind: Column, field: str, targets: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows whose (kind, id) names no row of the kind's table; unlike a plain reference, a NULL or unknown kind or id is unresolved too."""
    ids = reduce(DataFrame.unionByName, [t.select(F.lit(name).alias("__kind"), F.col(key).cast("string").alias("__id")).where("__id is not null") for name, (t, key) in targets.items()])
    rows = df.withColumn("__of", kind)
    return rows.join(ids, (F.col("__of") == F.col("__kind")) & (F.col(field).cast("string") == F.col("__id")), "left_anti").drop("__of")


def not_exactly_one(df: DataFrame, one: str, other: str) -> DataFrame:
    """Rows in which both or neither of two fields are given."""
    return df.where(F.col(one).isNull() == F.col(other).isNull())


def not_distinct(df: DataFrame, value: Column) -> DataFrame:
    """One row (n, different) if there are several rows and their values aren't all different, else none; NULLs are equal values."""
    text = F.coalesce(value.cast("string"), F.lit("<undefined>"))
    return df.agg(F.count("*").alias("n"), F.count_distinct(text).alias("different")).where("n > 1 and different <> n")


def string_member(column: str, name: str) -> Column:
    """A member of a VARIANT if it is a string; NULL if it is absent or anything else."""
    path = f'$["{name}"]'
    member = F.try_variant_get(column, path, "variant")
    return F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(column, path, "string"))


def _or_missing(column: Column) -> Column:
    return F.coalesce(column, F.lit("<missing>"))


def _issues(df: DataFrame, phase: int, code: str, message: Column, place: Column | None = None) -> DataFrame:
    return df.select(F.lit(phase).alias("phase"), "line", (place if place is not None else F.lit(0)).cast("int").alias("place"), F.lit(code).alias("code"), _or_missing(F.col("id")).alias("recordId"), message.alias("message"))


def dataset_issues(dataset: dict[str, DataFrame], order_sensitive: bool = False) -> DataFrame:
    """Issues of a catalogue: phase, line, place, code, recordId, message; ordered by the first three they come in the order of the checks.

    ``dataset`` has the collections taxa, plantConcepts, cultivars, contexts, rules, assertions, evidence and reviews, each with
    ``v`` (VARIANT), ``line``, which is unique in its collection and sorts, and, for ``order_sensitive``, ``raw``; a collection that is left out is empty. Ids that are no strings
    are skipped; an empty string is an id. Cultivar rules are compared by canonical timing, or by the timing as written.
    """
    # Collections in the order of the checks.
    names = ["taxa", "plantConcepts", "cultivars", "contexts", "rules", "assertions", "evidence", "reviews"]
    some = next(iter(dataset.values()))
    tables = {n: dataset.get(n, some.limit(0)).select("v", "line").withColumn("id", string_member("v", "id")) for n in names}
    ids = {n: t.select("id") for n, t in tables.items()}
    parts = []
    for n in names:
        again = repeated_rows(tables[n], ["id"], "line")
        parts.append(_issues(again, names.index(n), DUPLICATE_ID, F.concat(F.lit(f"Duplicate {n} identifier "), F.col("id"))))
    at = len(names)
    cultivars = tables["cultivars"].withColumn("parent", string_member("v", "plantConceptId"))
    parts.append(_issues(missing_references(cultivars, "parent", ids["plantConcepts"], "id"), at, MISSING_REFERENCE, F.concat(F.lit("Cultivar references missing plant concept "), F.col("parent"))))

    assertions = tables["assertions"].withColumns({"subject": string_member("v", "subjectType"), "subjectId": string_member("v", "subjectId"), "reviewId": string_member("v", "reviewId")})
    kind = F.when(F.col("subject") == "plant-concept", "plantConcepts").when(F.col("subject") == "cultivar", "cultivars")
    lost = unresolved_scopes(assertions, kind, "subjectId", {k: (ids[k], "id") for k in ("plantConcepts", "cultivars")})
    parts.append(_issues(lost, at + 1, INVALID_SCOPE, F.concat(F.lit("Assertion subject "), _or_missing(F.col("subject")), F.lit("/"), _or_missing(F.col("subjectId")), F.lit(" is not in the dataset")), F.lit(-1)))
    named = F.transform(F.try_variant_get("v", "$.evidenceReferenceIds", "array<variant>"), lambda e: F.when(F.schema_of_variant(e) == "STRING", F.try_variant_get(e, "$", "string")))
    listed = assertions.withColumn("references", named)
    parts.append(_issues(missing_list_references(listed, "references", ids["evidence"], "id"), at + 1, MISSING_REFERENCE, F.concat(F.lit("References missing evidence record "), F.col("reference")), F.col("pos") if "pos" in listed.columns else F.col("place")))
    parts.append(_issues(missing_references(assertions, "reviewId", ids["reviews"], "id"), at + 1, MISSING_REFERENCE, F.concat(F.lit("Assertion references missing review "), F.col("reviewId")), F.lit(2**31 - 1)))

    rules = tables["rules"].withColumns({"plant": string_member("v", "plantConceptId"), "cultivar": string_member("v", "cultivarId")})
    parts.append(_issues(not_exactly_one(rules, "plant", "cultivar"), at + 2, INVALID_SCOPE, F.lit("Rule must target exactly one plant concept or cultivar")))
    timing = F.to_json(F.try_variant_get("v", "$.timing", "variant"))
    windows = rules.where("cultivar is not null")
    if order_sensitive and "rules" in dataset:
        raw = dataset["rules"].select("line", F.get_json_object("raw", "$.timing").alias("written"))
        windows, timing = windows.join(raw, "line"), F.col("written")
    alike = not_distinct(windows, timing).select(F.lit(None).cast(some.schema["line"].dataType).alias("line"), F.lit("dataset").alias("id"))
    parts.append(_issues(alike, at + 3, NOT_DISTINCT, F.lit("Cultivar validation rules must retain distinct reviewed parameters")))
    return reduce(DataFrame.unionByName, parts)
