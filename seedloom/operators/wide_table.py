"""Entity, attribute, value rows into one wide table with typed columns.

Method: characteristic sets. The cells of an entity are reduced to one per attribute (with map-side combining, so a
hot entity shrinks before the shuffle), and the exact set of filled attributes becomes the entity's signature. The number of signatures can
grow with the data, at most to two to the power of the attributes, so signatures are merged by subset into a bounded
number of dense tables: with the attributes in order of their frequency, a signature belongs to the table of its rarest attribute, and
a table has that attribute's and all more frequent columns, of which each of its signatures is a subset. Entities are written once,
partitioned by table and sorted by signature (so that absent columns are runs of NULLs, which Parquet stores in no room); each dense
table then reads its own partition and its own columns only, and all of them are put together by
``unionByName(allowMissingColumns=True)``. Every entity is in exactly one dense table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.functions.json_text import pair_sql
from seedloom.plans.lineage import written

# Words that only say that nothing is known or recorded.
NOTHING = [
    "", "-", "--", "?", "??", "n/a", "na", "n.a.", "nan", "nil", "no data", "none given", "not available", "not given", "not known",
    "not recorded", "not stated", "null", "unknown", "unrecorded", "unspecified", "–", "—",
]
YES = ["true", "t", "yes", "y"]
NO = ["false", "f", "no", "n"]
#: Column type by value_type.
COLUMN_TYPES = {
    "number": "double", "integer": "bigint", "boolean": "boolean", "text": "string",
    "range": "struct<min:double,max:double>", "window": "struct<from:string,to:string>", "record": "string",
}
#: A wide table can't have more columns than this; a registry with more predicates is refused.
MOST_PREDICATES = 2000
#: The registry's spellings are sent to every task; a registry with more is refused.
MOST_SPELLINGS = 100_000
#: Dense tables that the signatures are merged into.
TABLES = 6

_NUMBER = r"[+\\-]?(?:\\d+(?:[.,]\\d*)?|[.,]\\d+)(?:[eE][+\\-]?\\d+)?"
_UNIT = r"(?:\\s*[%°µ\\p{L}][\\p{L}\\p{N}°%²³/.]*)?"
_SPAN = r"\\s*(?:-|–|—|~|\\.\\.+|to|bis|à|a|until)\\s*"
_DAY = r"(\\d{1,2})[-./](\\d{1,2})"


def spelling(predicate: Column) -> Column:
    """A predicate's name apart from letter case, blanks, hyphens and underscores."""
    return F.lower(F.regexp_replace(predicate, r"[\s _\-]+", ""))


def _spellings(registry: DataFrame) -> DataFrame:
    """column, value_type and key, each spelling of a predicate, as rows of the plan; a registry with too many to be sent to every task is refused."""
    aliases = F.concat(F.array("predicate"), F.coalesce(F.col("aliases"), F.array().cast("array<string>")))
    names = registry.select(F.col("predicate").alias("column"), F.col("value_type"), F.explode(F.array_distinct(F.transform(aliases, spelling))).alias("key")).where("key is not null")
    rows = names.limit(MOST_SPELLINGS + 1).collect()
    if len(rows) > MOST_SPELLINGS:
        raise ValueError(f"the registry has more than {MOST_SPELLINGS} spellings of predicates")
    return registry.sparkSession.createDataFrame(rows, "column string, value_type string, key string")


def _number_sql(text: str) -> str:
    return f"try_cast(replace(regexp_extract({text}, '^\\\\s*({_NUMBER}){_UNIT}\\\\s*$', 1), ',', '.') as double)"


def _member(v: str, *names: str) -> str:
    return "coalesce(" + ", ".join(f"try_variant_get({v}, '$.{n}', 'string')" for n in names) + ")"


def _month_day(month: str, day: str) -> str:
    return f"if({month} between 1 and 12 and {day} between 1 and 31, format_string('%02d-%02d', {month}, {day}), null)"


def _edge(v: str, *names: str) -> str:
    """MM-DD of a window's edge: text month-day, or an object with month and day."""
    parts = []
    for n in names:
        text = f"try_variant_get({v}, '$.{n}', 'string')"
        m, d = (f"try_cast(regexp_extract({text}, '^\\\\s*(?:\\\\d{{4}}-)?{_DAY}\\\\s*$', {k}) as int)" for k in (1, 2))
        parts.append(_month_day(m, d))
        parts.append(_month_day(f"try_variant_get({v}, '$.{n}.month', 'int')", f"try_variant_get({v}, '$.{n}.day', 'int')"))
    return f"coalesce({', '.join(parts)})"


def opened(rows: DataFrame) -> DataFrame:
    """``rows`` with ``v0``, the VARIANT of the JSON text in column t, and ``v1``, in which JSON text inside a JSON string is read too."""
    # The pair of a strictly parsed value is a column of its own, so that no lambda keeps these steps out of generated code.
    rows = rows.withColumn("pair", F.expr(pair_sql("t")))
    rows = rows.withColumn("v0", F.expr("if(size(pair) = 2, pair[0], null)")).drop("pair")
    text = "try_variant_get(v0, '$', 'string')"
    rows = rows.withColumn("text", F.expr(f"if(ltrim(t) like '\"%', {text}, null)"))
    rows = rows.withColumn("pair", F.expr(f"if(text rlike '^\\\\s*[\\\\[{{\"]', {pair_sql('text')}, null)"))
    return rows.withColumn("v1", F.expr("if(size(pair) = 2, pair[0], v0)")).drop("pair", "text")


def typed_cells(assertions: DataFrame, registry: DataFrame, subject: str = "subjectId", predicate: str = "predicate", value: str = "value", order: tuple[str, ...] = (), names: DataFrame | None = None) -> DataFrame:
    """Assertions with what they fill: subject, predicate (the registry's spelling), value_type, cell, rank.

    ``cell`` is a struct with one member per value type, all but the fitting one NULL; ``rank`` orders the cells of one
    subject and predicate (by ``order``, then the value's text). Rows without subject or value or with a predicate outside
    the registry are left out; blank and unreadable values and remarks fill nothing: their cell and rank are NULL. An alias that names two predicates
    counts for each. JSON nested more than 1,000 levels or with a string above 20 million characters counts as unreadable: the JVM's
    parser refuses it.
    """
    names = _spellings(registry) if names is None else names
    rank = F.struct(*[F.col(c).alias(f"r{i}") for i, c in enumerate(order)], F.col(value).alias("text"))
    rows = assertions.select(F.col(subject).cast("string").alias("subject"), spelling(F.col(predicate)).alias("key"), F.col(value).alias("t"), rank.alias("rank"))
    rows = rows.where("subject is not null and key is not null and t is not null")
    rows = rows.join(F.broadcast(names), "key").drop("key")  # at most MOST_SPELLINGS rows
    rows = opened(rows)
    rows = rows.withColumn("v2", F.expr("if(value_type <> 'record', coalesce(try_variant_get(v1, '$.value', 'variant'), v1), v1)"))
    rows = rows.withColumn("kind", F.expr("regexp_extract(schema_of_variant(v2), '^[A-Z]+', 0)"))
    rows = rows.withColumn("s", F.expr("if(kind in ('OBJECT', 'ARRAY', 'VOID'), null, trim(try_variant_get(v2, '$', 'string')))"))
    nothing = F.lower(F.col("s")).isin(NOTHING)
    number = F.expr(f"if(kind = 'BOOLEAN', null, {_number_sql('s')})")
    span = f"^\\\\s*({_NUMBER}){_UNIT}{_SPAN}({_NUMBER}){_UNIT}\\\\s*$"
    low = F.expr(f"case kind when 'OBJECT' then {_number_sql(_member('v2', 'min', 'low', 'lower', 'from'))} when 'ARRAY' then {_number_sql(_member('v2', '[0]').replace('$.[', '$['))} when 'STRING' then try_cast(replace(regexp_extract(s, '{span}', 1), ',', '.') as double) end")
    high = F.expr(f"case kind when 'OBJECT' then {_number_sql(_member('v2', 'max', 'high', 'upper', 'to'))} when 'ARRAY' then {_number_sql(_member('v2', '[1]').replace('$.[', '$['))} when 'STRING' then try_cast(replace(regexp_extract(s, '{span}', 2), ',', '.') as double) end")
    window = f"^\\\\s*{_DAY}\\\\s*(?:/|–|—|to|bis|-)\\\\s*{_DAY}\\\\s*$"
    part = [f"try_cast(regexp_extract(s, '{window}', {k}) as int)" for k in (1, 2, 3, 4)]
    begin = F.expr(f"case kind when 'OBJECT' then {_edge('v2', 'from', 'start')} when 'STRING' then {_month_day(part[0], part[1])} end")
    end = F.expr(f"case kind when 'OBJECT' then {_edge('v2', 'to', 'end')} when 'STRING' then {_month_day(part[2], part[3])} end")

    def bounds(one: str, low: Column, other: str, high: Column) -> Column:
        """A struct of two bounds unless both are NULL; each is computed once."""
        both = F.struct(low.alias(one), high.alias(other))
        return F.get(F.filter(F.array(both), lambda b: b[one].isNotNull() | b[other].isNotNull()), F.lit(0))

    is_a = lambda t: F.col("value_type") == t
    rows = rows.select(
        "subject", "column", "value_type", "rank",
        F.when(is_a("number") & ~nothing, number).alias("number"),
        F.when(is_a("integer") & ~nothing & (number == F.floor(number)), number.try_cast("bigint")).alias("integer"),
        F.when(is_a("boolean") & F.col("kind").isin("BOOLEAN", "STRING"), F.when(F.lower("s").isin(YES), True).when(F.lower("s").isin(NO), False)).alias("boolean"),
        F.when(is_a("text") & ~nothing & (F.col("kind") == "STRING"), F.col("s")).alias("text"),
        F.when(is_a("range"), bounds("min", low, "max", high)).alias("range"),
        F.when(is_a("window"), bounds("from", begin, "to", end)).alias("window"),
        F.when(is_a("record") & F.expr("(kind = 'OBJECT' and cardinality(try_variant_get(v1, '$', 'map<string,variant>')) > 0) or (kind = 'ARRAY' and cardinality(try_variant_get(v1, '$', 'array<variant>')) > 0)"), F.expr("to_json(v1)")).alias("record"),
    )
    filled = reduce(lambda a, b: a | b, [F.col(t).isNotNull() for t in COLUMN_TYPES])
    # No filter here: it would be pushed below the projections and all of them computed twice.
    return rows.select("subject", F.col("column").alias("predicate"), "value_type", F.when(filled, F.struct(*COLUMN_TYPES)).alias("cell"), F.when(filled, F.col("rank")).alias("rank"))


def registry_columns(registry: DataFrame) -> dict[str, str]:
    """Wide column and its value_type for every predicate of the registry, in order of the names."""
    rows = registry.select("predicate", "value_type").where("predicate is not null").distinct().limit(MOST_PREDICATES + 1).collect()
    if len(rows) > MOST_PREDICATES:
        raise ValueError(f"more than {MOST_PREDICATES} predicates can't become columns of one table")
    unknown = sorted({str(r.value_type) for r in rows} - COLUMN_TYPES.keys())
    if unknown:
        raise ValueError(f"unknown value types: {', '.join(unknown)}")
    columns = {r.predicate: r.value_type for r in sorted(rows, key=lambda r: r.predicate)}
    if len(columns) < len(rows):
        raise ValueError("a predicate has two value types")
    return columns


def characteristic_sets(cells: DataFrame) -> DataFrame:
    """One row per subject: subject, signature (sorted predicates, joined by line ends), cells (map by predicate)."""
    one = cells.groupBy("subject", "predicate").agg(F.min_by("cell", "rank").alias("cell")).where("cell is not null")
    sets = one.groupBy("subject").agg(F.map_from_entries(F.collect_list(F.struct("predicate", "cell"))).alias("cells"))  # at most one entry per predicate
    return sets.withColumn("signature", F.concat_ws("\n", F.array_sort(F.map_keys("cells"))))


def by_frequency(assertions: DataFrame, names: DataFrame, columns: list[str], predicate: str = "predicate") -> list[str]:
    """The registry's ``columns``, the rarest first, ties by name, from their spellings; the driver gets one number per predicate."""
    spelled = assertions.select(spelling(F.col(predicate)).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    counts = spelled.join(F.broadcast(names.select("column", "key")), "key").groupBy("column").agg(F.sum("n").alias("n")).collect()
    met = {r.column: r.n for r in counts}
    return sorted(columns, key=lambda c: (met.get(c, 0), c))


def wide_table(assertions: DataFrame, registry: DataFrame, subject: str = "subjectId", predicate: str = "predicate", value: str = "value", order: tuple[str, ...] = (), tables: int = TABLES) -> DataFrame:
    """One row per subject that has a filled cell, and one typed column per predicate of the registry.

    Of several assertions that fill the same cell the first by ``order``, then by the value's text, is taken; repeated
    rows change nothing. Subjects without a filled cell have no row; an empty input gives an empty table with all columns.
    ``tables`` is the number of dense tables that the signatures are merged into.
    """
    columns = registry_columns(registry)
    clash = {c.lower() for c in columns} & {subject.lower()}
    if clash or len({c.lower() for c in columns}) < len(columns):
        raise ValueError("two columns of the wide table would have the same name")
    if tables < 1:
        raise ValueError("there has to be a dense table")
    names = _spellings(registry)
    sets = characteristic_sets(typed_cells(assertions, registry, subject, predicate, value, order, names))
    ranked = by_frequency(assertions, names, list(columns), predicate)
    tables = max(1, min(tables, len(ranked)))
    first = [-(-k * len(ranked) // tables) for k in range(tables)]  # rank of the rarest attribute that a table has
    number = {c: max(k for k in range(tables) if first[k] <= r) for r, c in enumerate(ranked)}
    cell = lambda c: F.col("cells")[F.lit(c)][columns[c]].cast(COLUMN_TYPES[columns[c]])
    where = F.create_map(*[x for c, k in number.items() for x in (F.lit(c), F.lit(k))]) if number else F.create_map().cast("map<string,int>")
    stored = {c: f"c{i}" for i, c in enumerate(columns)}
    rows = sets.select("subject", "signature", F.array_min(F.transform(F.map_keys("cells"), lambda p: where[p])).alias("table"), *[cell(c).alias(k) for c, k in stored.items()])
    rows = written(rows.sortWithinPartitions("table", "signature"), "table")

    def dense(k: int) -> DataFrame:
        own = [c for c in columns if number[c] >= k]
        return rows.where(F.col("table") == k).select(F.col("subject").alias(subject), *[F.col(stored[c]).alias(c) for c in own])

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(dense, range(tables))).select(subject, *columns)


def filled_cells(wide: DataFrame, subject: str = "subjectId") -> DataFrame:
    """The filled cells of a wide table as rows subject, predicate."""
    names = [c for c in wide.columns if c != subject]
    cells = F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.lit(c)) for c in names])
    return wide.select(subject, F.explode(F.array_compact(cells)).alias("predicate"))


def typed_values(wide: DataFrame, registry: DataFrame, subject: str = "subjectId") -> DataFrame:
    """The filled cells of a wide table with their values: subject, predicate, and a column for each kind of value, all NULL but the fitting ones.

    number, whole, flag, said (text), low and high (range), begins and ends (window), members (of a record).
    """
    # The columns of each value type, from the cell.
    kinds = {
        "number": {"number": "{}"}, "integer": {"whole": "{}"}, "boolean": {"flag": "{}"}, "text": {"said": "{}"}, "range": {"low": "{}.min", "high": "{}.max"},
        "window": {"begins": "{}.from", "ends": "{}.to"}, "record": {"members": "cast(coalesce(json_array_length({0}), size(json_object_keys({0}))) as bigint)"},
    }
    types = {"number": "double", "whole": "bigint", "flag": "boolean", "said": "string", "low": "double", "high": "double", "begins": "string", "ends": "string", "members": "bigint"}

    def cell(column: str, kind: str) -> Column:
        said = kinds[kind]
        parts = [F.expr(said[n].format(f"`{column}`")).alias(n) if n in said else F.lit(None).cast(t).alias(n) for n, t in types.items()]
        return F.when(F.col(f"`{column}`").isNotNull(), F.struct(F.lit(column).alias("predicate"), *parts))

    columns = registry_columns(registry)
    cells = F.array_compact(F.array(*[cell(c, k) for c, k in columns.items()]))
    return wide.select(subject, F.inline(cells))
