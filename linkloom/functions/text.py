"""Column expressions over single lines of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.fixed_values import FIELD_SEPARATOR, HEADER_MARK, WHITESPACE


def strip(text: Column) -> Column:
    """Remove Unicode whitespace from both ends.

    Nearly every text starts and ends with a printable ASCII character. Those are returned as
    they are; trimming by a set of characters costs several times as much as the look.
    """
    plain = _is_plain(text) & _is_plain(text.substr(-1, 1))
    return F.when(plain, text).otherwise(_trim(text))


def _trim(text: Column) -> Column:
    """The trim of :func:`strip` without the look, whose code is long: for rare texts."""
    return F.btrim(text, F.lit(WHITESPACE))


def _is_plain(text: Column) -> Column:
    """Whether the first character is printable ASCII other than the space."""
    return F.ascii(text).between(33, 126)


def line_kind(line: Column) -> Column:
    """``mark`` for a line with # in column 0, ``blank``, or ``text``."""
    return (
        F.when(line.startswith(HEADER_MARK), F.lit("mark"))
        .when(_is_plain(line), F.lit("text"))
        .when(_trim(line) == "", F.lit("blank"))
        .otherwise(F.lit("text"))
    )


def header_key(line: Column) -> Column:
    """Key of a ``#KEY: value`` line, upper-cased; NULL when there is no colon."""
    entry = _trim(F.substring(line, 2, 2_147_483_647))
    colon = F.instr(entry, ":")
    return F.when(colon > 0, F.upper(_trim(entry.substr(F.lit(1), colon - 1))))


def header_value(line: Column) -> Column:
    """Value after the first colon of a ``#KEY: value`` line; NULL when absent or blank."""
    entry = F.substring(line, 2, 2_147_483_647)
    colon = F.instr(entry, ":")
    value = _trim(entry.substr(colon + 1, F.length(entry)))
    return F.when(colon > 0, F.nullif(value, F.lit("")))


def fields(line: Column, count: int) -> Column:
    """The first ``count`` fields of a line as an array, unstripped; shorter if there are fewer.

    Splitting stops one field later, so a line with thousands of fields costs no more than
    its first few.
    """
    return F.split(line, "\\" + FIELD_SEPARATOR, count + 1)


def all_fields(line: Column) -> Column:
    """Every field of a line, unstripped and uncapped."""
    return F.split(line, "\\" + FIELD_SEPARATOR, -1)
