"""JSON text as VARIANT, read strictly.

``try_parse_json`` alone accepts text after the first JSON value. Here the text is parsed as the first of
two elements of an array, so that anything but exactly one JSON value fails.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_sql(text: str) -> str:
    """SQL for the array that is ``[value, 0]`` if ``text`` is one JSON value; another size or NULL if not."""
    return f"try_variant_get(try_parse_json(concat('[', {text}, ',0]')), '$', 'array<variant>')"


def strict_json_sql(text: str) -> str:
    """SQL for the VARIANT of ``text``; NULL for NULL, blank or unreadable text and for repeated member names."""
    return f"get(transform(array({pair_sql(text)}), p -> if(size(p) = 2, p[0], null)), 0)"


def strict_json(text: str) -> Column:
    """VARIANT of the JSON text in column or SQL expression ``text``; NULL where it is not JSON."""
    return F.expr(strict_json_sql(text))


def canonical_text(text: str) -> Column:
    """JSON text with sorted members and without blanks; text that is not JSON stays as it is."""
    return F.coalesce(F.to_json(strict_json(text)), F.expr(text))
