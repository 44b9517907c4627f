"""Text that looks the same brought to one form.

Method: DuckDB runs inside the Arrow partitions; one embedded SQL expression composes accents (``nfc_normalize``), maps
compatibility forms, special blanks and look-alike letters (``translate``, and a map for forms of several characters) and
drops invisible characters (regular expression), then composes again. No row leaves its partition for it. Case,
punctuation marks, accents and ordinary white space stay as they are.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedloom.plans.lineage import written

# Letters that can't be told from Latin ones, by script.
LOOK_ALIKES = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S",
    "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i",
    "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ν": "v", "ο": "o", "ϲ": "c", "ϳ": "j",
    # Armenian, Latin extensions
    "օ": "o", "ո": "n", "ս": "u", "ɡ": "g", "ɑ": "a", "Օ": "O", "Ս": "U", "ᴄ": "c", "ᴏ": "o", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮓ": "Z", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ᏼ": "B",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
}

#: Compatibility forms that look like their ordinary ones; raised, lowered, circled and squared ones look different.
SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>")
#: Invisible characters, as a regular expression class; visible format characters (Arabic number signs) are kept.
INVISIBLE = r"[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{FFF9}-\x{FFFB}\x{E0000}-\x{E01EF}]"


@functools.cache
def tables() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that become one character, and those that become several; made from Unicode's data by rule."""
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        category = unicodedata.category(ch)
        if category in ("Cn", "Co", "Cs"):
            continue
        if category == "Zs" and code != 0x1680:
            single[ch] = " "
            continue
        to = ch
        rule = unicodedata.decomposition(ch).split()
        if rule and rule[0] in SAME_LOOK and ch != "ſ":
            to = unicodedata.normalize("NFKC", ch)
            if to.startswith(" ") and len(to) > 1:  # a free-standing accent
                to = ch
        parts = [LOOK_ALIKES.get(c, c) for c in unicodedata.normalize("NFD", to)]
        to = unicodedata.normalize("NFC", "".join(parts))
        if to == unicodedata.normalize("NFC", ch):
            continue
        (single if len(to) == 1 else several)[ch] = to
    return single, several


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _class(chars: list[str]) -> str:
    """A regular expression class of characters, with runs as ranges."""
    out, codes = [], sorted(map(ord, chars))
    start = last = codes[0]
    for code in [*codes[1:], -1]:
        if code != last + 1:
            out.append(rf"\x{{{start:X}}}" + (rf"-\x{{{last:X}}}" if last > start else ""))
            start = code
        last = code
    return "[" + "".join(out) + "]"


@functools.cache
def form_sql(column: str) -> str:
    """DuckDB SQL for the one form of a text column."""
    single, several = tables()
    blocks: dict[str, dict[str, str]] = {"wide": {}, "letters": {}, "other": {}}
    for ch, to in single.items():
        blocks["wide" if 0xFF00 <= ord(ch) < 0xFFF0 else "letters" if ord(ch) < 0x590 or unicodedata.category(ch) == "Zs" else "other"][ch] = to
    sql = f"nfc_normalize({column})"
    for table in blocks.values():  # each table is applied only to texts that need it
        sql = f"list_transform([{sql}], lambda s: CASE WHEN regexp_matches(s, {_literal(_class(list(table)))}) THEN translate(s, {_literal(''.join(table))}, {_literal(''.join(table.values()))}) ELSE s END)[1]"
    forms = f"MAP {{{', '.join(f'{_literal(k)}: {_literal(v)}' for k, v in several.items())}}}"
    sql = f"list_transform([{sql}], lambda s: CASE WHEN regexp_matches(s, {_literal(_class(list(several)))}) THEN array_to_string(list_transform(string_split(s, ''), lambda c: coalesce({forms}[c], c)), '') ELSE s END)[1]"
    return f"CASE WHEN regexp_full_match({column}, '[\\x00-\\x7F]*') THEN {column} ELSE nfc_normalize(regexp_replace({sql}, {_literal(INVISIBLE)}, '', 'g')) END"


def _form(batches):
    """Batches with their last column's form; DuckDB streams them through one query, which is parsed once a task."""
    import duckdb
    import pyarrow as pa

    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return
    schema = pa.schema([*first.schema, pa.field("form", pa.string())])
    rows = pa.RecordBatchReader.from_batches(first.schema, chain([first], batches))
    with duckdb.connect(config={"threads": 1}) as con:
        value = '"' + first.schema.names[-1].replace('"', '""') + '"'
        con.register("rows", rows)
        for batch in con.sql(f"SELECT *, {form_sql(value)} AS form FROM rows").to_arrow_reader(10_000):
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(batch.columns, schema.types, strict=True)], schema=schema)


def one_form(df: DataFrame, value: str, *keep: str) -> DataFrame:
    """Columns ``keep`` and ``value``, and ``form``: the value in its one form.

    NULL stays NULL, an empty text empty; a text of invisible characters only becomes empty. The form of a form is
    the form. Any number of repeated rows, an empty table and very long texts are handled; other columns are left out.
    """
    rows = df.select(*keep, value)
    if "form" in rows.columns:
        raise ValueError("the result has a column named form already")
    schema = T.StructType([*rows.schema.fields, T.StructField("form", T.StringType())])
    return rows.mapInArrow(_form, schema)


def _forms(df: DataFrame, id: str, subject: str, value: str) -> DataFrame:
    """id, subject, value and form of the records that have them, written once."""
    rows = df.select(F.col(id).cast("string").alias("id"), F.col(subject).cast("string").alias("subject"), F.col(value).alias("value")).where("id is not null and subject is not null and value is not null")
    return written(one_form(rows, "value", "id", "subject"))


def look_classes(df: DataFrame, id: str = "id", subject: str = "subjectId", value: str = "value") -> DataFrame:
    """One row per record that looks like another: id, class_id (the smallest id of those that look the same), links (ids of the class with other characters).

    Classes are counted, never listed, so a class may hold any share of the records. Rows with a NULL in id, subject or value take no
    part; a repeated row counts once, and an id with several values has a row for each class.
    """
    forms = _forms(df, id, subject, value).distinct()
    classes = forms.groupBy("subject", "form").agg(F.min("id").alias("class_id"), F.count("*").alias("members"), F.min("value").alias("least"), F.max("value").alias("most")).where("least <> most")
    alike = forms.groupBy("subject", "value").agg(F.count("*").alias("alike"))
    linked = forms.join(classes.drop("least", "most"), ["subject", "form"]).join(alike, ["subject", "value"])
    return linked.groupBy("id", "class_id").agg(F.max(F.col("members") - F.col("alike")).alias("links"))


def same_looking(df: DataFrame, id: str = "id", subject: str = "subjectId", value: str = "value") -> DataFrame:
    """Pairs of records of one subject whose values look the same but differ in their characters: id_a, id_b (id_a is smaller).

    As many rows as there are pairs, which is what is asked; :func:`look_classes` is the form for classes of any size. Records that are equal to the
    character form no pair. Rows with a NULL in id, subject or value take no part; repeated ids give one pair.
    """
    forms = _forms(df, id, subject, value)
    # Only forms that are written in more than one way can give pairs; least and greatest combine before the shuffle.
    several = forms.groupBy("subject", "form").agg(F.min("value").alias("least"), F.max("value").alias("most")).where("least <> most").select("subject", "form")
    forms = forms.join(several, ["subject", "form"], "left_semi")
    other = forms.select("subject", "form", F.col("value").alias("value_b"), F.col("id").alias("id_b"))
    return forms.join(other, ["subject", "form"]).where("id < id_b and value <> value_b").select(F.col("id").alias("id_a"), "id_b").distinct()
