"""Measured values: numbers with their unit, whatever shape they are said in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.operators.wide_table import _NUMBER, _SPAN, _UNIT, opened, spelling

_MEASURE = f"^\\\\s*({_NUMBER})({_UNIT})\\\\s*$"
_BOUNDS = f"^\\\\s*({_NUMBER}{_UNIT}){_SPAN}({_NUMBER}{_UNIT})\\\\s*$"


def _first_member(v: str, *names: str) -> str:
    return "coalesce(" + ", ".join(f"try_variant_get({v}, '{n}', 'string')" for n in names) + ")"


def measured_values(rows: DataFrame, registry: DataFrame, predicate: str = "predicate", value: str = "value", unit: str = "unit") -> DataFrame:
    """Rows with bound, number and said_unit for each number with a unit that their JSON text ``value`` states.

    Numbers may be plain, text (with decimal point or comma), the member ``value`` of an object, or JSON text inside a string.
    A range gives two rows: its bound is ``min`` or ``max``, else NULL. Its unit is the one written with the number, else the member ``unit``
    of its object, else the one with the other bound, else the row's ``unit``, else the unit that the registry has for the predicate. Ranges as
    text or list are read for the registry's ranges, and as text also where a unit is written. Values without any unit are no measures. An alias
    that names two predicates counts for each.
    """
    aliases = F.concat(F.array("predicate"), F.coalesce(F.col("aliases"), F.array().cast("array<string>")))
    names = registry.select(F.explode(F.array_distinct(F.transform(aliases, spelling))).alias("__key"), F.col("unit").alias("__registered"), (F.col("value_type") == "range").alias("__range")).distinct()
    keyed = rows.where(F.col(value).isNotNull()).withColumns({"__key": spelling(F.col(predicate)), "t": F.col(value)})
    seen = opened(keyed.join(F.broadcast(names), "__key", "left"))  # the registry is small
    seen = seen.withColumn("v2", F.expr("coalesce(try_variant_get(v1, '$.value', 'variant'), v1)"))
    seen = seen.withColumn("kind", F.expr("regexp_extract(schema_of_variant(v2), '^[A-Z]+', 0)"))
    seen = seen.withColumn("s", F.expr("if(kind in ('OBJECT', 'ARRAY', 'VOID', 'BOOLEAN'), null, trim(try_variant_get(v2, '$', 'string')))"))
    seen = seen.withColumn("__own", F.expr("nullif(trim(coalesce(try_variant_get(v2, '$.unit', 'string'), try_variant_get(v1, '$.unit', 'string'))), '')"))
    texts = {}
    for k, names_, at in (("min", ("$.min", "$.low", "$.lower", "$.from"), 0), ("max", ("$.max", "$.high", "$.upper", "$.to"), 1)):
        span = f"nullif(regexp_extract(s, '{_BOUNDS}', {at + 1}), '')"
        texts[k] = F.expr(f"case kind when 'OBJECT' then {_first_member('v2', *names_)} when 'ARRAY' then if(__range and cardinality(try_variant_get(v2, '$', 'array<variant>')) = 2, try_variant_get(v2, '$[{at}]', 'string'), null) when 'STRING' then {span} end")
    seen = seen.withColumns({"__one": F.col("s"), "__min": texts["min"], "__max": texts["max"]})
    parts = {k: (f"try_cast(replace(regexp_extract({k}, '{_MEASURE}', 1), ',', '.') as double)", f"nullif(trim(regexp_extract({k}, '{_MEASURE}', 2)), '')") for k in ("__one", "__min", "__max")}
    seen = seen.withColumns({f"{k}_{n}": F.expr(sql) for k, both in parts.items() for n, sql in zip("nu", both, strict=True)})
    # Two numbers with a dash between them are a range only if a unit or the registry says so: else it may be a day, a date or a page.
    seen = seen.withColumn("__spans", F.expr("coalesce(__range, false) or __own is not null or __min_u is not null or __max_u is not null"))
    said = lambda bound, k, other: F.struct(F.lit(bound).cast("string").alias("bound"), F.when(F.col("__spans") | F.lit(bound is None), F.col(f"{k}_n")).alias("number"), F.coalesce(f"{k}_u", "__own", other, unit, "__registered").alias("said_unit"))
    nothing = F.lit(None).cast("string")
    each = F.explode(F.array(said(None, "__one", nothing), said("min", "__min", F.col("__max_u")), said("max", "__max", F.col("__min_u"))))
    return seen.select(*rows.columns, each.alias("m")).select(*rows.columns, "m.*").where("number is not null and said_unit is not null")
