"""Authored JSON Schema documents, read on the driver."""

from __future__ import annotations

import json
from pathlib import Path
from urllib.parse import urlsplit

SUFFIX = ".schema.json"


class SchemaCompileError(ValueError):
    """A schema document that can't be used."""


def is_absolute_id(document: object) -> bool:
    """Whether a document is an object whose ``$id`` is an absolute URI."""
    if not isinstance(document, dict) or not isinstance(document.get("$id"), str):
        return False
    try:
        parts = urlsplit(document["$id"])
    except ValueError:
        return False
    return bool(parts.scheme and document["$id"] != f"{parts.scheme}:")


def schema_files(folder: str | Path) -> list[Path]:
    """All schema files below a folder, by relative path."""
    root = Path(folder)
    return sorted((p for p in root.rglob(f"*{SUFFIX}") if p.is_file()), key=lambda p: p.relative_to(root).as_posix())


def schema_documents(folder: str | Path) -> dict[str, dict]:
    """Schema documents below a folder by ``$id``, in the order of the ids. Identity is the id, never the file's name."""
    found: dict[str, tuple[Path, dict]] = {}
    for path in schema_files(folder):
        try:
            document = json.loads(path.read_text(encoding="utf-8"))
        except ValueError as error:
            raise SchemaCompileError(f"{path} is not JSON: {error}") from None
        if not is_absolute_id(document):
            raise SchemaCompileError(f"{path} has no absolute $id")
        if document["$id"] in found:
            raise SchemaCompileError(f"{path} and {found[document['$id']][0]} have the same $id {document['$id']}")
        found[document["$id"]] = (path, document)
    return {k: found[k][1] for k in sorted(found)}
