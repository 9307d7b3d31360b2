"""Cleaning expressions on text columns. A null input gives null unless the docstring says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The defaults and masks the cleaned tables must show.
MISSING_ZIP_TEXT = "Null"
DEFAULT_ZIP = "9999"
STREET_SEPARATOR = ", "
DATE_SEPARATOR = "-"

# A word is a run of cased letters; everything else (digits, quotes, hyphens, marks) separates words.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"
# U+FDD0 is set aside by Unicode for use inside programs.
_WORD_MARK = "\ufdd0 "


def phone_mask_10(phone: Column, strict: bool = True) -> Column:
    """``1234567890`` -> ``(123)456-7890``.

    With ``strict`` a number that is not ten characters long gives null; without it the slices are taken as they
    come, so ``12345`` gives ``(123)45-``.
    """
    text = phone.cast("string")
    masked = F.concat(
        F.lit("("), F.substring(text, 1, 3), F.lit(")"), F.substring(text, 4, 3), F.lit("-"), F.substring(text, 7, 4)
    )
    return F.when(F.length(text) == 10, masked) if strict else masked


def phone_mask_7(phone: Column, strict: bool = True) -> Column:
    """``1234567`` -> ``123-4567``; ``strict`` as in :func:`phone_mask_10`, with seven characters."""
    text = phone.cast("string")
    masked = F.concat(F.substring(text, 1, 3), F.lit("-"), F.substring(text, 4, 4))
    return F.when(F.length(text) == 7, masked) if strict else masked


def zip_or_default(zip_code: Column, default: str = DEFAULT_ZIP) -> Column:
    """Replaces null and the text ``Null`` by ``default``."""
    return F.coalesce(F.nullif(zip_code.cast("string"), F.lit(MISSING_ZIP_TEXT)), F.lit(default))


def zero_pad(value: Column) -> Column:
    """Puts a ``0`` before one-character text. ``lpad`` would cut longer text, so it is not used."""
    text = value.cast("string")
    return F.when(F.length(text) == 1, F.concat(F.lit("0"), text)).otherwise(text)


def date_key(year: Column, month: Column, day: Column) -> Column:
    """``YYYY-MM-DD`` from three parts; null as soon as one part is null."""
    separator = F.lit(DATE_SEPARATOR)
    return F.concat(year.cast("string"), separator, zero_pad(month), separator, zero_pad(day))


def title_case(text: Column) -> Column:
    """Upper-cases the first letter of every word and lower-cases the others, with ``O'Brien`` and ``Mary-Jane``.

    ``initcap`` alone starts words at spaces only, so a marker that ends in a space goes before every word and is
    taken out again. Text that holds the marker by itself is cut into words and gaps instead.
    """
    marked = F.regexp_replace(text, f"([{_CASED}]+)", f"{_WORD_MARK}$1")
    by_mark = F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))
    pieces = F.regexp_extract_all(text, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(0))
    by_piece = F.array_join(F.transform(pieces, F.initcap), "")
    return F.when(F.contains(text, F.lit(_WORD_MARK)), by_piece).otherwise(by_mark)


def lower_case(text: Column) -> Column:
    return F.lower(text)


def safe_int(text: Column) -> Column:
    """32-bit integer; text that is no integer gives null instead of failing the job."""
    return text.try_cast("int")


def street_line(apartment: Column, street: Column) -> Column:
    """``APT, STREET``; null if either part is null."""
    return F.concat(apartment.cast("string"), F.lit(STREET_SEPARATOR), street.cast("string"))
