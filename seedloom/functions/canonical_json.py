"""Canonical JSON: one byte sequence per JSON value.

Members are sorted by UTF-16 code units, blanks left out, numbers written as ECMAScript does. Values outside JSON, numbers
that aren't finite and lone surrogates are refused with a code and a JSON Pointer. The column functions have plain text written by
the JVM and look at the rest in Arrow batches.
"""

from __future__ import annotations

import json
import math
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Error codes.
INVALID_JSON, DUPLICATE_KEY, UNSUPPORTED_VALUE = "INVALID_JSON", "DUPLICATE_KEY", "UNSUPPORTED_VALUE"
#: Largest integer that a double holds exactly with all smaller ones.
SAFE_INTEGER = 2**53 - 1


class CanonicalJsonError(ValueError):
    """A value that has no canonical form: code, path (JSON Pointer) and message."""

    def __init__(self, code: str, message: str, path: str = ""):
        super().__init__(message)
        self.code, self.path = code, path


def pointer(path: str, member: str | int) -> str:
    """JSON Pointer of a member below ``path``."""
    return f"{path}/{str(member).replace('~', '~0').replace('/', '~1')}"


def number_text(x: int | float) -> str:
    """A number as ECMAScript writes it; ``-0`` is ``0``."""
    if isinstance(x, int) and abs(x) <= SAFE_INTEGER:
        return str(x)
    x = float(x)
    if x == 0:
        return "0"
    digits, _, power = f"{x!r}".replace("-", "", 1).partition("e") if x < 0 else repr(x).partition("e")
    whole, _, part = digits.partition(".")
    part = "" if part == "0" else part
    point = len(whole) + int(power or 0)
    figures = (whole + part).lstrip("0")
    point -= len(whole + part) - len(figures)
    figures = figures.rstrip("0")
    n = len(figures)
    if n <= point <= 21:
        out = figures + "0" * (point - n)
    elif 0 < point <= 21:
        out = f"{figures[:point]}.{figures[point:]}"
    elif -6 < point <= 0:
        out = "0." + "0" * -point + figures
    else:
        out = figures[0] + (f".{figures[1:]}" if n > 1 else "") + f"e{'+' if point > 0 else '-'}{abs(point - 1)}"
    return "-" + out if x < 0 else out


def _order(key: str) -> bytes:
    return key.encode("utf-16-be", "surrogatepass")


def canonical(value: Any, path: str = "", _above: tuple[int, ...] = ()) -> str:
    """Canonical text of a Python value made of None, bool, int, float, str, list and dict with text keys."""
    if value is None or value is True or value is False:
        return {None: "null", True: "true", False: "false"}[value]
    if type(value) is str:
        try:
            value.encode("utf-8")
        except UnicodeEncodeError:
            raise CanonicalJsonError(UNSUPPORTED_VALUE, "lone surrogate in a string", path) from None
        return json.dumps(value, ensure_ascii=False)
    if type(value) in (int, float):
        try:
            finite = math.isfinite(value)
        except OverflowError:
            finite = False
        if not finite:
            raise CanonicalJsonError(UNSUPPORTED_VALUE, "number is not finite", path)
        return number_text(value)
    if type(value) not in (list, dict):
        raise CanonicalJsonError(UNSUPPORTED_VALUE, f"{type(value).__name__} is not a JSON value", path)
    if id(value) in _above:
        raise CanonicalJsonError(UNSUPPORTED_VALUE, "value contains itself", path)
    above = (*_above, id(value))
    if type(value) is list:
        return f"[{','.join(canonical(x, pointer(path, i), above) for i, x in enumerate(value))}]"
    for key in value:
        if type(key) is not str:
            raise CanonicalJsonError(UNSUPPORTED_VALUE, "member name is not a string", path)
    return f"{{{','.join(f'{canonical(k, pointer(path, k))}:{canonical(value[k], pointer(path, k), above)}' for k in sorted(value, key=_order))}}}"


def canonical_bytes(value: Any) -> bytes:
    return canonical(value).encode()


class _Members(list):
    """Members of an object as read, with repetitions."""


def _built(node: Any, path: str) -> Any:
    """The value of a tree of members; the first repeated name in order of the text is refused."""
    if isinstance(node, _Members):
        out: dict[str, Any] = {}
        for key, value in node:
            if key in out:
                raise CanonicalJsonError(DUPLICATE_KEY, f"member {key} occurs twice", pointer(path, key))
            out[key] = _built(value, pointer(path, key))
        return out
    if isinstance(node, list):
        return [_built(x, pointer(path, i)) for i, x in enumerate(node)]
    return node


def _refused(text: str):
    raise ValueError(text)


def _integer(text: str) -> int | float:
    return int(text) if len(text) < 17 and abs(int(text)) <= SAFE_INTEGER else float(text)


def parse_strict(text: str | bytes) -> Any:
    """The value of one JSON text; refuses text that isn't JSON, bytes that aren't UTF-8, and repeated member names."""
    try:
        if isinstance(text, bytes):
            text = text.decode("utf-8-sig")
        tree = json.loads(text, object_pairs_hook=_Members, parse_int=_integer, parse_constant=_refused)
    except (ValueError, RecursionError) as error:
        raise CanonicalJsonError(INVALID_JSON, f"not JSON: {error}") from None
    return _built(tree, "")


CHECKED = "struct<text:string,code:string,path:string,message:string>"


def _checked(text: str | bytes | None) -> dict | None:
    if text is None:
        return None
    try:
        return {"text": canonical(parse_strict(text)), "code": None, "path": None, "message": None}
    except CanonicalJsonError as error:
        return {"text": None, "code": error.code, "path": error.path.encode("utf-8", "replace").decode(), "message": str(error).encode("utf-8", "replace").decode()}
    except RecursionError:
        return {"text": None, "code": INVALID_JSON, "path": "", "message": "nested too deeply"}


#: Text whose canonical form the JVM writes too: printable ASCII without escapes, and numbers that are short and written as they come out.
_PLAIN = r"^[ -\[\]-~]*$"
_NOT_PLAIN = r"[0-9][eE]|[0-9.]{16}|\.[0-9]{7}|\.[0-9]*0(?![0-9])"


def _checked_batch(column: Column) -> Column:
    kind = pa.struct([(n, pa.string()) for n in ("text", "code", "path", "message")])

    @F.arrow_udf(CHECKED)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([_checked(t) for t in texts.to_pylist()], kind)

    return run(column)


def _ways(column: Column | str) -> tuple[Column, Column, Column]:
    """(value, whether it is plain, what the JVM writes for it: NULL where it doesn't read as JSON)."""
    whole = F.col(column) if isinstance(column, str) else column
    text = whole.cast("string")  # bytes that aren't UTF-8 don't become plain
    plain = F.coalesce(text.rlike(_PLAIN) & ~text.rlike(_NOT_PLAIN), F.lit(False))
    pair = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit(",0]"))), "$", "array<variant>")
    return whole, plain, F.get(F.transform(F.array(pair), lambda p: F.when(F.size(p) == 2, F.to_json(F.get(p, F.lit(0))))), F.lit(0))


def checked_json(column: Column | str) -> Column:
    """Per JSON text (string or binary): canonical text, or code, path and message of what is wrong; NULL for NULL.

    Plain text that reads as JSON is written by the JVM; only the rest is looked at in Python.
    """
    whole, plain, written = _ways(column)
    none = F.lit(None).cast("string")
    good = F.struct(F.when(plain, written).alias("text"), none.alias("code"), none.alias("path"), none.alias("message"))
    checked = _checked_batch(F.when(F.when(plain, written).isNull(), whole))
    return F.coalesce(checked, F.when(whole.isNotNull(), good))


def canonical_json(column: Column | str) -> Column:
    """Canonical text of a JSON text; NULL where there is none. Plain text is written by the JVM, the rest in Python."""
    whole, plain, written = _ways(column)
    return F.when(plain, written).otherwise(_checked_batch(F.when(~plain, whole))["text"])
