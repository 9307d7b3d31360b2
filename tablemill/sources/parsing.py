"""Lines to typed records, with lines that do not fit kept aside as text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.sources.lines import FIRST_MISFITS
from tablemill.sources.records import REJECTED_LINE, RecordType

# Fixed: what the text of a number may be, without the suffixes and hexadecimal forms that a cast would take.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|nan|inf|infinity)\s*$"

#: The CSV parser takes lines of up to 20,480 fields.
PARSER_FIELDS = 20_000


def parse_lines(lines: DataFrame, record: RecordType) -> DataFrame:
    """One row per line of ``value``: the record's fields, and the line in ``rejected_line`` if it does not fit.

    A line fits if it has as many fields as the record and a number in each number field, and is not marked as a first
    line that should have been a header. Empty text stays empty text in accepted rows.

    The cut line goes through ``inline`` so that a later filter on its fields stays above the cut. As a plain column
    it would be cut again for every field that the filter looks at.
    """
    marked = [FIRST_MISFITS] if FIRST_MISFITS in lines.columns else []
    text = lines.select(F.coalesce("value", F.lit("")).alias("_line"), *marked)
    names = record.schema.names
    parts = text.withColumn("_parts", F.split("_line", re.escape(record.separator), len(names) + 1))
    fields = _plain_fields(names)
    if record.quoted:
        fields = F.when(_needs_csv_parser(record), _quoted_fields(record)).otherwise(fields)
    cut = parts.withColumn("_fields", fields)
    return _typed(cut.select("_line", *marked, F.inline(F.array("_fields"))), record)


def accepted(rows: DataFrame) -> DataFrame:
    """The rows whose line fitted, without the reject column."""
    return rows.where(F.col(REJECTED_LINE).isNull()).drop(REJECTED_LINE)


def rejected(rows: DataFrame) -> DataFrame:
    """The lines that did not fit, as one column ``value``."""
    return rows.where(F.col(REJECTED_LINE).isNotNull()).select(F.col(REJECTED_LINE).alias("value"))


def _plain_fields(names: list[str]) -> Column:
    """Takes what ``split`` has cut; a rest beyond the last field is in one piece, so it may hold any number of them."""
    misfit = F.when(F.size("_parts") != len(names), F.col("_line"))
    return F.struct(
        *(F.get("_parts", F.lit(i)).alias(name) for i, name in enumerate(names)), misfit.alias(REJECTED_LINE)
    )


def _needs_csv_parser(record: RecordType) -> Column:
    """A line with quotes in it does, unless it has so many separators that the parser might fail, and too many outside
    quoted fields: that is no record. Doubled quotes go first, which leaves quoted fields without quotes inside, and a
    pattern without repeated groups finds those."""
    line, separator = F.col("_line"), re.escape(record.separator)
    plain = F.regexp_replace(F.replace(line, F.lit('""'), F.lit("")), f'(^|{separator})"[^"]*"', "$1")
    few = _count(line, record.separator) < PARSER_FIELDS
    return F.contains(line, F.lit('"')) & (few | (_count(plain, record.separator) < len(record.schema.names)))


def _count(text: Column, part: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))


def _quoted_fields(record: RecordType) -> Column:
    options = {
        "sep": record.separator,
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": REJECTED_LINE,
    }
    return F.from_csv("_line", record.text_schema.toDDL(), options)


def _typed(rows: DataFrame, record: RecordType) -> DataFrame:
    """Converts the text fields to the record's types. The conversion goes through ``inline``, too, for the same reason
    as the cut."""
    fields = record.schema.fields
    is_text = {f.name: isinstance(f.dataType, T.StringType) for f in fields}
    converted = [(F.col(f.name) if is_text[f.name] else _number(f)).alias(f.name) for f in fields]
    marked = [FIRST_MISFITS] if FIRST_MISFITS in rows.columns else []
    typed = rows.select("_line", *marked, F.inline(F.array(F.struct(*converted, REJECTED_LINE))))

    misfit = F.col(REJECTED_LINE).isNotNull()
    for name in (*marked, *(f.name for f in fields if not is_text[f.name])):
        misfit = misfit | (F.col(name) if name == FIRST_MISFITS else F.col(name).isNull())
    checked = typed.select(*record.schema.names, F.when(misfit, F.col("_line")).alias(REJECTED_LINE))
    fits = F.col(REJECTED_LINE).isNull()
    filled = {
        name: F.when(fits, F.coalesce(name, F.lit(""))).otherwise(F.col(name)) for name in is_text if is_text[name]
    }
    return checked.withColumns(filled)


def _number(field: T.StructField) -> Column:
    """The field's text as a number; null if it is none."""
    text = F.col(field.name)
    return F.when(text.rlike(NUMBER), text.try_cast(field.dataType))
