"""Manifests: datasets of several files, and suites of conformance cases."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from seedloom.functions.canonical_json import parse_strict
from seedloom.functions.json_text import strict_json
from seedloom.operators.schema import SchemaSet, with_validation
from seedloom.sources.jsonl import read_jsonl

# Fixed value: what a safe relative path looks like.
SAFE_PATH = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*(?:/[A-Za-z0-9][A-Za-z0-9._-]*)*")


def is_safe_path(path: object) -> bool:
    """Whether a path stays below its folder: relative, with segments that start with a letter or digit."""
    return isinstance(path, str) and SAFE_PATH.fullmatch(path) is not None


@dataclass(frozen=True)
class Dataset:
    """Collections of records by name, and the listed files that weren't there."""

    manifest: dict
    collections: dict[str, DataFrame]
    missing: list[str]


def load_dataset(spark: SparkSession, manifest: str | Path, strict: bool = True, line_numbers: bool = True) -> Dataset:
    """The JSON Lines files that a dataset's manifest lists, by file name without its ending.

    A listed file that isn't there fails if ``strict``, else it is reported and its collection is left out. Paths
    that leave the manifest's folder always fail.
    """
    home = Path(manifest)
    document = parse_strict(home.read_bytes())
    names = document.get("files", []) if isinstance(document, dict) else []
    unsafe = [n for n in names if not is_safe_path(n)]
    if unsafe:
        raise ValueError(f"unsafe paths: {', '.join(map(str, unsafe))}")
    missing = [n for n in names if not (home.parent / n).is_file()]
    if missing and strict:
        raise FileNotFoundError(f"listed but not there: {', '.join(missing)}")
    there = [n for n in names if n not in missing and ".jsonl" in n]
    return Dataset(document, {n.split("/")[-1].split(".jsonl")[0]: read_jsonl(spark, str(home.parent / n), line_numbers) for n in there}, missing)


@dataclass(frozen=True)
class Case:
    """A conformance case: a fixture's value is valid, has these (path, keyword) errors, or fails the pipeline with a code."""

    name: str
    schema_id: str
    fixture: Path
    valid: bool
    errors: tuple[tuple[str, str], ...] = ()
    pipeline_error: str | None = None

    def value(self):
        return json.loads(self.fixture.read_text(encoding="utf-8"))


def load_cases(manifest: str | Path) -> list[Case]:
    """Cases of a suite's manifest; repeated names, unsafe paths and unclear expectations fail."""
    home = Path(manifest)
    document = parse_strict(home.read_bytes())
    cases: list[Case] = []
    for entry in document["cases"]:
        name, expected = entry["id"], entry["expected"]
        if any(c.name == name for c in cases):
            raise ValueError(f"two cases are named {name}")
        if not is_safe_path(entry["fixture"]):
            raise ValueError(f"case {name} has an unsafe path")
        given = [k for k in ("valid", "pipelineError") if k in expected]
        if len(given) != 1:
            raise ValueError(f"case {name} has no clear expectation")
        errors = tuple((e["instancePath"], e["keyword"]) for e in expected.get("errors", ()))
        if bool(errors) != (expected.get("valid") is False):
            raise ValueError(f"case {name} has no clear expectation")
        cases.append(Case(name, entry.get("schemaId", document.get("schemaId")), home.parent / entry["fixture"], expected.get("valid") is True, errors, expected.get("pipelineError")))
    return cases


def run_cases(spark: SparkSession, schemas: SchemaSet, cases: list[Case]) -> DataFrame:
    """A row per case: name, schemaId, expected and actual (``valid``, the sorted path and keyword of every error, or the pipeline's code), passed.

    Expected errors have to be among the actual ones; a valid value has none. The values of one schema are checked together.
    """
    told, by_schema = {}, {}
    for case in cases:
        if case.schema_id in schemas.documents:
            by_schema.setdefault(case.schema_id, []).append(case)
        else:
            told[case.name] = ["UNKNOWN_SCHEMA_ID"]
    for schema_id, group in by_schema.items():
        rows = spark.createDataFrame([(c.name, json.dumps(c.value())) for c in group], "name string, t string")
        checked = with_validation(rows.select("name", strict_json("t").alias("v")), schemas.compile(schema_id))
        for r in checked.select("name", "errors").collect():
            told[r.name] = sorted({f"{e.instancePath} {e.keyword}" for e in r.errors}) or ["valid"]
    out = []
    for case in cases:
        wanted = [case.pipeline_error] if case.pipeline_error else ["valid"] if case.valid else sorted(f"{path} {keyword}" for path, keyword in case.errors)
        passed = set(wanted) <= set(told[case.name]) and (case.errors != () or told[case.name] == wanted)
        out.append((case.name, case.schema_id, wanted, told[case.name], passed))
    return spark.createDataFrame(out, "name string, schemaId string, expected array<string>, actual array<string>, passed boolean")
