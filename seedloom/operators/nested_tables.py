"""Deeply nested records into flat child tables.

Method: a higher-order SQL projection. A level is an array of nodes (path, position, parent path, value); the
next level is ``flatten(transform(...))`` over it, where nested ``transform`` calls attach the ancestor's path and
the position. One ``inline`` per target table turns the collected nodes into rows. No shuffle is needed,
and few rows leave the JVM: values nested deeper than :data:`LEVELS` are finished by :func:`_deeper`, and text that the JVM's parser may
refuse is walked there as a whole, so that depth is not bounded.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.decoder import scanstring
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.functions.json_text import pair_sql, strict_json

#: Levels of nesting that the JVM projection unrolls; a documented parameter, not a limit of the result.
LEVELS = 20

#: The JVM's parser refuses text nested more than 1,000 levels or with a string above 20 million characters; text that may is left to Python.
JVM_LEVELS, JVM_LENGTH = 900, 19_000_000

_SPACE = re.compile(r"[ \t\n\r]*")
_ATOM = re.compile(r"true|false|null|-?(?:0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?")
_WORDS = {"true": True, "false": False, "null": None}

_NODE = "named_struct('path', {path}, 'parent', {parent}, 'position', {position}, 'v', {v})"
_FOUND = "array<struct<path:string,parent_path:string,position:int,object:string>>"


def _next_level(nodes: str) -> str:
    """SQL for the nodes below ``nodes``; a node's parent is the nearest object above it."""
    element = _NODE.format(path="concat(x.path, '[', i, ']')", parent="x.parent", position="i", v="e")
    member = _NODE.format(path="concat(x.path, '.', m.key)", parent="x.path", position="cast(null as int)", v="m.value")
    inner = _NODE.format(path="x.path", parent="x.parent", position="x.position", v="p[0]")
    text = "try_variant_get(x.v, '$', 'string')"
    return (
        f"flatten(transform({nodes}, x -> coalesce("
        f"transform(try_variant_get(x.v, '$', 'array<variant>'), (e, i) -> {element}),"
        f"transform(map_entries(try_variant_get(x.v, '$', 'map<string,variant>')), m -> {member}),"
        f"if({text} rlike '^\\\\s*[\\\\[{{\"]', transform(filter(array({pair_sql(text)}), p -> size(p) = 2), p -> {inner}), null),"
        f"array())))"
    )


def _name(text: str, at: int, owner: dict) -> tuple[str, int]:
    """A member's name and the place after its colon."""
    at = _SPACE.match(text, at).end()
    if text[at : at + 1] != '"':
        raise ValueError("no member name")
    name, at = scanstring(text, at + 1, True)
    at = _SPACE.match(text, at).end()
    if name in owner or text[at : at + 1] != ":":
        raise ValueError("a repeated member name or no colon")
    return name, at + 1


def _parsed(text: str) -> Any:
    """The value of one JSON text, without recursion; refuses repeated member names."""
    open_: list[list] = []  # containers around the place, with the name of the member that is read
    at = 0
    while True:
        at = _SPACE.match(text, at).end()
        c = text[at : at + 1]
        if c == "[" or c == "{":
            value: Any = [] if c == "[" else {}
            at = _SPACE.match(text, at + 1).end()
            if text[at : at + 1] != ("]" if c == "[" else "}"):
                open_.append([value, None])
                if c == "{":
                    open_[-1][1], at = _name(text, at, value)
                continue
            at += 1
        elif c == '"':
            value, at = scanstring(text, at + 1, True)
        elif m := _ATOM.match(text, at):
            at = m.end()
            value = _WORDS[m[0]] if m[0] in _WORDS else float(m[0]) if m[1] or m[2] or len(m[0]) > 4000 else int(m[0])
        else:
            raise ValueError("no JSON value")
        while open_:
            owner, name = open_[-1]
            if name is None:
                owner.append(value)
            else:
                owner[name] = value
            at = _SPACE.match(text, at).end()
            c = text[at : at + 1]
            at += 1
            if c == ",":
                if name is not None:
                    open_[-1][1], at = _name(text, at, owner)
                break
            if c != ("]" if name is None else "}"):
                raise ValueError("a container isn't closed")
            value = open_.pop()[0]
        else:
            if _SPACE.match(text, at).end() < len(text):
                raise ValueError("text after the value")
            return value


def _text(value: Any) -> str:
    """JSON with sorted members and without blanks, without recursion."""
    out, todo = [], [value]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):  # a piece of text
            out.append(x[0])
        elif isinstance(x, dict):
            pieces = [p for n, k in enumerate(sorted(x)) for p in ((f"{',' if n else '{'}{json.dumps(k, ensure_ascii=False)}:",), x[k])]
            todo += [("}",), *reversed(pieces or [("{",)])]
        elif isinstance(x, list):
            pieces = [p for n, e in enumerate(x) for p in (("," if n else "[",), e)]
            todo += [("]",), *reversed(pieces or [("[",)])]
        else:
            out.append(json.dumps(x, ensure_ascii=False))
    return "".join(out)


def _walk(text: str, past: int, objects: bool = True) -> Iterator[tuple[str, str, int, str]]:
    """Objects in arrays below level ``past`` of one JSON text: path, parent path, position, JSON."""
    try:
        stack = [("value", None, None, _parsed(text), 0)]
    except ValueError:
        return
    while stack:
        path, parent, position, v, level = stack.pop()
        if isinstance(v, str) and v.lstrip()[:1] in ("[", "{", '"'):
            try:
                stack.append((path, parent, position, _parsed(v), level + 1))
            except ValueError:
                pass
        elif isinstance(v, dict):
            if position is not None and level > past:
                yield path, parent, position, _text(v) if objects else None
            stack.extend((f"{path}.{k}", path, None, x, level + 1) for k, x in v.items())
        elif isinstance(v, list):
            owner = parent
            stack.extend((f"{path}[{i}]", owner, i, x, level + 1) for i, x in enumerate(v))


def _deeper(levels: int, objects: bool):
    """Walks rows (id, text, whether the JVM took no part in it): what lies below ``levels``, or everything."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [(i, *node) for i, t, whole in zip(*(c.to_pylist() for c in batch.columns), strict=True) for node in _walk(t, -1 if whole else levels, objects)]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[k], t) for k, t in enumerate((pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()))],
                ["id", "path", "parent_path", "position", "object"],
            )

    return run


def nested_objects(df: DataFrame, id: str = "id", value: str = "value", levels: int = LEVELS, objects: bool = True) -> DataFrame:
    """Every object that is an element of an array anywhere in JSON text ``value``.

    Columns: id, path (``value.a[0].b[2]``), parent_path (of the nearest object above, NULL if there is none),
    position (from 0), object (canonical JSON; NULL without ``objects``). A JSON string that holds JSON counts as that JSON. NULL, blank and
    unreadable text, also text with repeated member names in one object, have no children. Repeated input rows give
    repeated output rows; other columns of ``df`` are left out, so that their names can't clash. An empty input
    gives no rows.
    """
    base = df.select(F.col(id).cast("string").alias("id"), F.col(value).alias("t")).where("(t like '%{%' and t like '%[%') or instr(t, '\\\\u') > 0")
    nodes = base.withColumn("v", strict_json("t"))
    # Every level costs one opening bracket or one JSON string within a JSON string. A bracket stands in the text or as an
    # escape, which always has its own "u00"; a string within a string either doubles the backslashes before its quote or is written
    # with such an escape. So no text is deeper than this.
    count = lambda what: f"length(t) - length(translate(t, '{what}', ''))"
    escapes = f"({count(chr(92) * 2)})"
    opening = F.expr(f"{count('[{')} + 2 + if({escapes} > 0, (length(t) - length(replace(t, 'u00', ''))) / 3 + log2({escapes} + 1), 0)")
    # What the JVM's parser may refuse for its depth or its length is walked as a whole in Python.
    beyond = (opening > JVM_LEVELS) | (F.length("t") > JVM_LENGTH)
    nodes = nodes.where(~beyond)
    nodes = nodes.withColumn("deep", opening > levels)
    root = _NODE.format(path="'value'", parent="cast(null as string)", position="cast(null as int)", v="v")
    state = nodes.select("id", "deep", F.expr(f"array({root})").alias("nodes"), F.array().cast(_FOUND).alias("found"))
    text = "to_json(n.v)" if objects else "cast(null as string)"
    met = f"transform(filter(nodes, n -> n.position is not null and try_variant_get(n.v, '$', 'map<string,variant>') is not null), n -> named_struct('path', n.path, 'parent_path', n.parent, 'position', n.position, 'object', {text}))"
    for _ in range(levels):  # only the level at hand and what was found are carried on
        state = state.select("id", "deep", F.expr(_next_level("nodes")).alias("nodes"), "found")
        state = state.select("id", "deep", "nodes", F.expr(f"concat(found, {met})").alias("found"))
    # Rows with nodes left must be among those that are walked below: the flag is carried along, and a row without it fails the job.
    state = state.withColumn("found", F.expr(f"if(not deep and size({_next_level('nodes')}) > 0, raise_error('a value is deeper than its text allows'), found)"))
    # The outer form: for the plain one a filter on the found rows is pushed down, and all levels are computed twice.
    flat = state.selectExpr("id", "inline_outer(found)").where("path is not null")
    # What may nest deeper is looked at once more.
    columns = "id string, path string, parent_path string, position int, object string"
    rest = base.where((opening > levels) | beyond).select("id", "t", beyond.alias("whole"))
    return flat.unionByName(rest.mapInArrow(_deeper(levels, objects), columns))


def list_elements(df: DataFrame, elements: str | Column, path: str, id: str = "id") -> DataFrame:
    """Non-null elements of a list column as rows id, path (``path[0]``), position, element; nulls keep their place."""
    column = F.col(elements) if isinstance(elements, str) else elements
    rows = F.filter(
        F.transform(column, lambda e, i: F.struct(F.concat(F.lit(f"{path}["), i.cast("string"), F.lit("]")).alias("path"), i.alias("position"), e.alias("element"))),
        lambda r: r["element"].isNotNull(),
    )
    return df.select(F.col(id).cast("string").alias("id"), rows.alias("rows")).select("id", F.inline_outer("rows")).where("path is not null")


def member_rows(df: DataFrame, member: str, id: str = "id") -> DataFrame:
    """A non-null member of a struct as rows id, path, element; one row per parent at most."""
    return df.select(F.col(id).cast("string").alias("id"), F.lit(member).alias("path"), F.col(member).alias("element")).where("element is not null")


def flat_tables(assertions: DataFrame, evidence: DataFrame, objects: bool = True) -> dict[str, DataFrame]:
    """The related flat tables of assertions and evidence references, each with the parent's id, a path and a position."""
    return {
        "assertion_objects": nested_objects(assertions, objects=objects),
        "assertion_geographic_contexts": list_elements(assertions, "context.geographicContextIds", "context.geographicContextIds"),
        "evidence_licences": member_rows(evidence, "rights.licenceId"),
    }


def flat_paths(assertions: DataFrame, evidence: DataFrame) -> DataFrame:
    """Distinct table_name, id, path over all flat tables: the index that links every child to its parent."""
    tables = flat_tables(assertions, evidence, objects=False)
    return (
        tables["assertion_objects"].select(F.lit("assertions").alias("table_name"), "id", "path")
        .unionByName(tables["assertion_geographic_contexts"].select(F.lit("assertions").alias("table_name"), "id", "path"))
        .unionByName(tables["evidence_licences"].select(F.lit("evidence_references").alias("table_name"), "id", "path"))
        .where("id is not null")
        .distinct()
    )
