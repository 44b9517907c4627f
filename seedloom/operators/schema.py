"""JSON Schema as column expressions over VARIANT.

A schema is compiled once, on the driver, to a tree of checks on paths of one root VARIANT. Every node that isn't below an
array is read by its whole path, so no expression nests in another; elements of arrays are checked in a ``transform``.
:meth:`Compiled.errors` lists all errors as a sorted array of structs, :meth:`Compiled.is_valid` is the cheap form for
filters. Unknown keywords fail the compilation.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.functions.canonical_json import canonical_bytes
from seedloom.functions.columns import pointer_member
from seedloom.sources.schema_files import SchemaCompileError, is_absolute_id, schema_documents

ERROR = "struct<instancePath:string,schemaPath:string,keyword:string,message:string>"
ERRORS = f"array<{ERROR}>"
# Error codes of the validation pipeline, and the keywords that are understood.
UNKNOWN_SCHEMA_ID, INVALID_SCHEMA_REGISTRY, VALIDATOR_EXECUTION_FAILED = "UNKNOWN_SCHEMA_ID", "INVALID_SCHEMA_REGISTRY", "VALIDATOR_EXECUTION_FAILED"
ANNOTATIONS = {"$comment", "$defs", "$id", "$schema", "default", "deprecated", "description", "examples", "title"}
CHECKS = {
    "$ref", "additionalProperties", "allOf", "anyOf", "const", "else", "enum", "exclusiveMaximum", "exclusiveMinimum", "if", "items", "maxItems", "maxLength",
    "maximum", "minItems", "minLength", "minimum", "multipleOf", "not", "oneOf", "pattern", "properties", "required", "then", "type", "uniqueItems",
}
_NUMERIC = ["BIGINT", "BYTE", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT"]
_KINDS = {"null": ["VOID"], "boolean": ["BOOLEAN"], "string": ["STRING"], "array": ["ARRAY"], "object": ["OBJECT"], "number": _NUMERIC}


class ValidationPipelineError(RuntimeError):
    """A fault of the pipeline, not of a record: ``code`` says which."""

    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


def _fact(value: Column, what: str) -> Column:
    """Kind (the type's name in capitals), text or number of a VARIANT."""
    if what == "kind":
        return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.try_variant_get(value, "$", "string" if what == "text" else "double")


class Facts:
    """Kinds, texts and numbers of the nodes of a record, computed once in a projection before the checks."""

    PREFIX = "__fact_"

    def __init__(self, root: Column):
        self.root, self.made, self._read = root, {}, {}
        self._numbers: dict[str, int] = {}

    def get(self, path: str, what: str) -> Column:
        name = f"{self.PREFIX}{what}{self._numbers.setdefault(path, len(self._numbers))}"
        if name not in self.made:
            value = self.root if path == "$" else F.try_variant_get(self.root, path, "variant")
            self.made[name] = _fact(value, what)
            self._read[name] = F.col(name)
        return self._read[name]


class ElementFacts:
    """The same for an element of an array, which carries its own facts; nodes below it are read from its value."""

    def __init__(self, element: Column):
        self.element, self._read = element, {}

    def get(self, path: str, what: str) -> Column:
        if (path, what) not in self._read:
            self._read[path, what] = self.element[what] if path == "$" else _fact(F.try_variant_get(self.element["v"], path, "variant"), what)
        return self._read[path, what]

    @staticmethod
    def carried(v: Column) -> list[Column]:
        return [v.alias("v"), *[_fact(v, what).alias(what) for what in ("kind", "text", "number")]]


@dataclass(frozen=True)
class Node:
    """A place in a record: a VARIANT root with a path below it, its JSON Pointer, and where its facts are."""

    root: Column
    path: str
    at: Column
    facts: Facts | ElementFacts

    def value(self) -> Column:
        return F.try_variant_get(self.root, self.path, "variant") if self.path != "$" else self.root

    def cast(self, kind: str) -> Column:
        return F.try_variant_get(self.root, self.path, kind)

    def text(self) -> Column:
        return self.facts.get(self.path, "text")

    def number(self) -> Column:
        return self.facts.get(self.path, "number")

    def is_there(self) -> Column:
        return self.facts.get(self.path, "kind").isNotNull()

    def is_a(self, name: str) -> Column:
        if name == "integer":
            return self.is_a("number") & (self.number() == F.floor(self.number()))
        return F.coalesce(self.facts.get(self.path, "kind").isin(_KINDS[name]), F.lit(False))

    def member(self, name: str) -> Node:
        quoted = name.replace("\\", "\\\\").replace('"', '\\"')
        return Node(self.root, f'{self.path}["{quoted}"]', F.concat(self.at, F.lit("/" + name.replace("~", "~0").replace("/", "~1"))), self.facts)


@dataclass
class Check:
    """What may fail: the condition, and the errors, an array that is empty if nothing fails.

    Both forms are kept apart, so that neither repeats the other: a filter needs the conditions only, a report the arrays only.
    """

    fails: Column
    errors: Column


@dataclass
class Compiled:
    """A compiled schema. Its checks read facts that :meth:`prepared` computes first."""

    schema_id: str
    build: Callable[[Node], list[Check]]
    _cache: dict = field(default_factory=dict)

    def _checks(self, column: str) -> tuple[Facts, list[Check]]:
        if column not in self._cache:
            facts = Facts(F.col(column))
            self._cache[column] = facts, self.build(Node(F.col(column), "$", F.lit(""), facts))
        return self._cache[column]

    def prepared(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with the facts that :meth:`errors` and :meth:`is_valid` of this column read."""
        facts, _ = self._checks(column)
        return df.withColumns(facts.made) if facts.made else df

    def tidied(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` without the facts."""
        return df.drop(*self._checks(column)[0].made)

    def errors(self, column: str) -> Column:
        """All errors of the VARIANT in ``column``, sorted by path, schema path, keyword and message; NULL for NULL."""
        return F.when(F.col(column).isNotNull(), F.array_sort(_joined(self._checks(column)[1])))

    def is_valid(self, column: str) -> Column:
        """Whether the VARIANT has no error; NULL for NULL."""
        return F.when(F.col(column).isNotNull(), ~_any(self._checks(column)[1]))


def _any(checks: Iterable[Check]) -> Column:
    return reduce(lambda a, b: a | b, (c.fails for c in checks), F.lit(False))


def _joined(checks: list[Check]) -> Column:
    return F.flatten(F.array(*[c.errors for c in checks])) if checks else _none()


def _none() -> Column:
    return F.array().cast(ERRORS)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _unless_fit(wrong: Callable[[Column], Column], error: Column) -> Callable[[Column], Column]:
    """From the branches' error lists: an error and all of theirs, if the number of branches without errors is wrong."""

    def use(lists: Column) -> Column:
        fitting = F.size(F.filter(lists, lambda e: F.size(e) == 0))
        return F.when(wrong(fitting), F.concat(error, F.flatten(lists))).otherwise(_none())

    return use


def _before(error: Column) -> Callable[[Column], Column]:
    """From a list of errors: an error before it, unless it is empty."""

    def use(errors: Column) -> Column:
        return F.when(F.size(errors) > 0, F.concat(error, errors)).otherwise(_none())

    return use


def _one(node: Node, schema_path: str, keyword: str, message: str | Column) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.array(F.struct(node.at.alias("instancePath"), F.lit(f"{schema_path}/{keyword}").alias("schemaPath"), F.lit(keyword).alias("keyword"), text.alias("message")))


def _pattern(pattern: str) -> str:
    """A pattern for Java: its end sign would match before a final line end too."""
    out, escaped, in_class = [], False, False
    for ch in pattern:
        if ch == "$" and not escaped and not in_class:
            out.append(r"\z")
            continue
        in_class = (ch == "[" or in_class) and not (ch == "]" and not escaped) if not escaped else in_class
        escaped = ch == "\\" and not escaped
        out.append(ch)
    return "".join(out)


def _literal(node: Node, value: Any) -> Column:
    """Whether a node equals a JSON value, without coercion."""
    if value is None:
        return node.is_a("null")
    if isinstance(value, bool):
        return node.is_a("boolean") & (node.cast("boolean") == value)
    if isinstance(value, str):
        return node.is_a("string") & (node.text() == value)
    if isinstance(value, int | float):
        return node.is_a("number") & (node.number() == float(value))
    return F.to_json(node.value()) == F.to_json(F.parse_json(F.lit(json.dumps(value))))


def _is_any_json(schema: Any, pointer: str) -> bool:
    """Whether a schema is the union of all six kinds, with itself for elements and members: it holds for every value."""
    if not isinstance(schema, dict) or set(schema) - ANNOTATIONS != {"oneOf"}:
        return False
    again = {"$ref": pointer}
    return sorted((json.dumps(x, sort_keys=True) for x in schema["oneOf"])) == sorted(
        json.dumps(x, sort_keys=True)
        for x in [{"type": "null"}, {"type": "boolean"}, {"type": "number"}, {"type": "string"}, {"type": "array", "items": again}, {"type": "object", "additionalProperties": again}]
    )


class SchemaSet:
    """Schema documents by id, compiled on demand."""

    def __init__(self, documents: Mapping[str, dict] | Iterable[dict]):
        listed = list(documents.values()) if isinstance(documents, Mapping) else list(documents)
        self.documents: dict[str, dict] = {}
        for document in listed:
            if not is_absolute_id(document):
                raise SchemaCompileError("a schema has no absolute $id")
            if document["$id"] in self.documents:
                raise SchemaCompileError(f"two schemas have the $id {document['$id']}")
            self.documents[document["$id"]] = document
        if not self.documents:
            raise ValidationPipelineError(INVALID_SCHEMA_REGISTRY, "there are no schemas")
        self._compiled: dict[str, Compiled] = {}

    @classmethod
    def from_folder(cls, folder: str) -> SchemaSet:
        return cls(schema_documents(folder))

    def compile_all(self) -> SchemaSet:
        """Compiles every document, so that faults show before any record is read."""
        for schema_id in self.documents:
            self.compile(schema_id)
        return self

    def fingerprint(self) -> str:
        """Digest of all documents, the same whatever the order or layout of their files."""
        return hashlib.sha256(canonical_bytes({k: self.documents[k] for k in sorted(self.documents)})).hexdigest()

    def compile(self, schema_id: str) -> Compiled:
        """The compiled schema of an id."""
        if schema_id not in self.documents:
            raise ValidationPipelineError(UNKNOWN_SCHEMA_ID, f"unknown schema {schema_id}")
        if schema_id not in self._compiled:
            document = self.documents[schema_id]
            self._inspect(document, schema_id, document, ())
            self._compiled[schema_id] = Compiled(schema_id, lambda node: self._checks(document, node, "#", document, ()))
        return self._compiled[schema_id]

    def _resolve(self, ref: str, document: dict) -> tuple[Any, dict, str]:
        base, _, fragment = ref.partition("#")
        home = document if not base else self.documents.get(base)
        if home is None:
            raise SchemaCompileError(f"{ref} names no schema")
        target: Any = home
        for part in [p.replace("~1", "/").replace("~0", "~") for p in fragment.split("/")[1:]] if fragment else []:
            if isinstance(target, list) and part.isdigit() and int(part) < len(target):
                target = target[int(part)]
            elif isinstance(target, dict) and part in target:
                target = target[part]
            else:
                raise SchemaCompileError(f"{ref} names no schema")
        return target, home, f"{home['$id']}#{fragment}"

    def _inspect(self, schema: Any, where: str, document: dict, above: tuple[str, ...]) -> None:
        """Fails on unknown keywords, references without target and recursion, without building expressions."""
        if isinstance(schema, bool):
            return
        if not isinstance(schema, dict):
            raise SchemaCompileError(f"{where} is not a schema")
        unknown = set(schema) - CHECKS - ANNOTATIONS
        if unknown:
            raise SchemaCompileError(f"{where} has unknown keywords: {', '.join(sorted(unknown))}")
        if "$ref" in schema:
            target, home, name = self._resolve(schema["$ref"], document)
            if not _is_any_json(target, "#" + name.partition("#")[2]):
                if name in above:
                    raise SchemaCompileError(f"{where} refers to itself by {schema['$ref']}")
                self._inspect(target, name, home, (*above, name))
        if _is_any_json(schema, "#" + where.partition("#")[2]):
            return
        for keyword in ("items", "if", "then", "else", "not", "additionalProperties"):
            if keyword in schema:
                self._inspect(schema[keyword], f"{where}/{keyword}", document, above)
        for keyword in ("allOf", "anyOf", "oneOf"):
            for i, part in enumerate(schema.get(keyword, ())):
                self._inspect(part, f"{where}/{keyword}/{i}", document, above)
        for keyword in ("properties", "$defs"):
            for name, part in schema.get(keyword, {}).items():
                if keyword == "properties" or not where.count("$defs"):
                    if keyword == "$defs" and _is_any_json(part, f"#/$defs/{name}"):
                        continue
                    self._inspect(part, f"{where}/{keyword}/{name}", document, above)

    def _checks(self, schema: Any, node: Node, path: str, document: dict, above: tuple[str, ...]) -> list[Check]:
        if schema is True:
            return []
        if schema is False:
            return [Check(F.lit(True), _one(node, path, "false schema", "boolean schema is false"))]
        below = lambda part, at, suffix: self._checks(part, at, f"{path}/{suffix}", document, above)
        out: list[Check] = []

        def fail(condition: Column, keyword: str, message: str | Column) -> None:
            fails = F.coalesce(condition, F.lit(False))
            out.append(Check(fails, F.when(fails, _one(node, path, keyword, message)).otherwise(_none())))

        if "$ref" in schema:
            target, home, name = self._resolve(schema["$ref"], document)
            if not _is_any_json(target, "#" + name.partition("#")[2]):
                out += self._checks(target, node, f"{path}/$ref", home, (*above, name))
        if "type" in schema:
            names = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
            fits = reduce(lambda a, b: a | b, [node.is_a(n) for n in names])
            fail(~fits, "type", f"must be {','.join(names)}")
        if "enum" in schema:
            if all(isinstance(v, str) for v in schema["enum"]):
                fits = node.is_a("string") & node.text().isin(schema["enum"])
            else:
                fits = reduce(lambda a, b: a | b, [F.coalesce(_literal(node, v), F.lit(False)) for v in schema["enum"]])
            fail(~F.coalesce(fits, F.lit(False)), "enum", "must be equal to one of the allowed values")
        if "const" in schema:
            fail(~F.coalesce(_literal(node, schema["const"]), F.lit(False)), "const", "must be equal to constant")
        if schema.keys() & {"minLength", "maxLength", "pattern"}:
            text, is_text = node.text(), node.is_a("string")
            if "minLength" in schema:
                fail(is_text & (F.length(text) < schema["minLength"]), "minLength", f"must NOT have fewer than {schema['minLength']} characters")
            if "maxLength" in schema:
                fail(is_text & (F.length(text) > schema["maxLength"]), "maxLength", f"must NOT have more than {schema['maxLength']} characters")
            if "pattern" in schema:
                fail(is_text & ~text.rlike(_pattern(schema["pattern"])), "pattern", f'must match pattern "{schema["pattern"]}"')
        number = node.number() if schema.keys() & {"minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"} else None
        is_number = node.is_a("number")
        for keyword, sign, fails in (
            ("minimum", ">=", lambda n: number < n), ("maximum", "<=", lambda n: number > n), ("exclusiveMinimum", ">", lambda n: number <= n), ("exclusiveMaximum", "<", lambda n: number >= n),
        ):
            if keyword in schema:
                fail(is_number & fails(float(schema[keyword])), keyword, f"must be {sign} {schema[keyword]}")
        if "multipleOf" in schema:
            share = number / float(schema["multipleOf"])
            fail(is_number & (share != F.floor(share)), "multipleOf", f"must be multiple of {schema['multipleOf']}")
        is_object = node.is_a("object")
        for name in schema.get("required", ()):
            fail(is_object & ~node.member(name).is_there(), "required", f"must have required property '{name}'")
        for name, part in schema.get("properties", {}).items():
            inner = node.member(name)
            present = is_object & inner.is_there()
            checks = below(part, inner, f"properties/{name}")
            if checks:
                out.append(Check(present & _any(checks), F.when(present, _joined(checks)).otherwise(_none())))
        extra = schema.get("additionalProperties", True)
        if extra is not True:
            known = F.array(*[F.lit(n) for n in schema.get("properties", {})]).cast("array<string>")
            members = node.cast("map<string,variant>")
            if extra is False:
                names = F.array_sort(F.array_except(F.map_keys(members), known))
                errors = F.transform(names, lambda n: F.struct(node.at.alias("instancePath"), F.lit(f"{path}/additionalProperties").alias("schemaPath"), F.lit("additionalProperties").alias("keyword"), F.lit("must NOT have additional properties").alias("message")))
                out.append(Check(F.coalesce(is_object & (F.size(names) > 0), F.lit(False)), F.when(is_object, errors).otherwise(_none())))
            else:
                entries = F.filter(F.map_entries(members), lambda e: ~F.array_contains(known, e["key"]))
                self._each(out, entries, is_object, lambda x: x["value"], lambda e, i, x: pointer_member(node.at, e["key"]), lambda n: below(extra, n, "additionalProperties"))
        is_list, elements = node.is_a("array"), node.cast("array<variant>")
        if "minItems" in schema:
            fail(is_list & (F.size(elements) < schema["minItems"]), "minItems", f"must NOT have fewer than {schema['minItems']} items")
        if "maxItems" in schema:
            fail(is_list & (F.size(elements) > schema["maxItems"]), "maxItems", f"must NOT have more than {schema['maxItems']} items")
        if schema.get("uniqueItems"):
            # Equal numbers are equal however they are written; within objects and arrays they are compared as written.
            texts = F.transform(elements, lambda e: F.when(F.regexp_extract(F.schema_of_variant(e), "^[A-Z]+", 0).isin(_NUMERIC), F.try_variant_get(e, "$", "double").cast("string")).otherwise(F.to_json(e)))
            fail(is_list & (F.size(F.array_distinct(texts)) < F.size(texts)), "uniqueItems", "must NOT have duplicate items")
        if "items" in schema:
            self._each(out, elements, is_list, lambda x: x, lambda e, i, x: F.concat(node.at, F.lit("/"), i.cast("string")), lambda n: below(schema["items"], n, "items"))
        for i, part in enumerate(schema.get("allOf", ())):
            out += below(part, node, f"allOf/{i}")
        for keyword in ("anyOf", "oneOf"):
            if keyword in schema:
                branches = [below(part, node, f"{keyword}/{i}") for i, part in enumerate(schema[keyword])]
                wrong = (lambda n: n != 1) if keyword == "oneOf" else (lambda n: n == 0)
                held = reduce(lambda a, b: a + b, [F.when(_any(b), 0).otherwise(1) for b in branches])
                error = _one(node, path, keyword, "must match exactly one schema in oneOf" if keyword == "oneOf" else "must match a schema in anyOf")
                listed = F.array(*[_joined(b) for b in branches])
                out.append(Check(wrong(held), _bound(listed, _unless_fit(wrong, error))))
        if "not" in schema:
            fail(~_any(below(schema["not"], node, "not")), "not", "must NOT be valid")
        if "if" in schema:
            met = ~_any(below(schema["if"], node, "if"))
            for keyword, when in (("then", met), ("else", ~met)):
                if keyword in schema:
                    checks = below(schema[keyword], node, keyword)
                    error = _one(node, path, "if", f'must match "{keyword}" schema')
                    errors = _bound(_joined(checks), _before(error))
                    out.append(Check(when & _any(checks), F.when(when, errors).otherwise(_none())))
        return out

    @staticmethod
    def _each(out: list[Check], array: Column, applies: Column, value: Callable[[Column], Column], at: Callable[..., Column], checks: Callable[[Node], list[Check]]) -> None:
        """Adds the checks of every element of an array (or member of an object), which carries its facts."""
        carried = F.transform(array, lambda e, i: F.struct(at(e, i, None).alias("at"), *ElementFacts.carried(value(e))))
        node = lambda e: Node(e["v"], "$", e["at"], ElementFacts(e))
        errors = F.flatten(F.transform(carried, lambda e: _joined(checks(node(e)))))
        fails = F.exists(carried, lambda e: _any(checks(node(e))))
        out.append(Check(F.coalesce(applies & fails, F.lit(False)), F.when(applies, errors).otherwise(_none())))


def with_validation(df: DataFrame, schema: Compiled, column: str = "v") -> DataFrame:
    """``df`` with ``errors`` and ``valid`` of the VARIANT in ``column``; both NULL where it is NULL."""
    if {"valid", "errors"} & set(df.columns):
        raise ValueError("the columns valid and errors exist already")
    checked = schema.prepared(df, column).withColumn("errors", schema.errors(column))
    return schema.tidied(checked, column).withColumn("valid", F.size("errors") == 0)


def listed_errors(df: DataFrame, schema: Compiled, column: str = "v") -> DataFrame:
    """One row per error of a record: the columns of ``df`` but ``column``, and the error's four fields.

    The outer form of the generator keeps the optimizer from copying the whole check into a filter below it.
    """
    checked = schema.prepared(df, column).withColumn("errors", schema.errors(column))
    kept = [c for c in df.columns if c != column]
    return checked.select(*kept, F.inline_outer("errors")).where("keyword is not null")


def with_validity(df: DataFrame, schema: Compiled, column: str = "v") -> DataFrame:
    """``df`` with ``valid`` only, without error lists: False where there is no VARIANT."""
    if "valid" in df.columns:
        raise ValueError("the column valid exists already")
    return schema.tidied(schema.prepared(df, column).withColumn("valid", F.coalesce(schema.is_valid(column), F.lit(False))), column)


def split(df: DataFrame, schema: Compiled, column: str = "v") -> tuple[DataFrame, DataFrame]:
    """Rows with a valid and rows with an invalid VARIANT; rows without one are invalid."""
    checked = with_validity(df, schema, column)
    return checked.where("valid").drop("valid"), checked.where("not valid").drop("valid")


def validate(spark, schemas: SchemaSet, schema_id: str, value: Any) -> dict:
    """One JSON value: {"valid": True} or {"valid": False, "errors": [...]}; unknown schemas raise."""
    compiled = schemas.compile(schema_id)
    try:
        row = with_validation(spark.createDataFrame([(json.dumps(value),)], "t string").select(F.parse_json("t").alias("v")), compiled).select("valid", "errors").first()
    except Exception as error:
        raise ValidationPipelineError(VALIDATOR_EXECUTION_FAILED, str(error)) from error
    return {"valid": True} if row.valid else {"valid": False, "errors": [e.asDict() for e in row.errors]}
