"""Column expressions over authority-file ids and entity types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.fixed_values import (
    AUTHORITY_ISIL_PREFIX,
    AUTHORITY_URI_PREFIX,
    OTHER_TYPE,
    TYPE_PRIORITY,
)


def bare_id(identifier: Column) -> Column:
    """Strip the authority URI and then the ``(DE-588)`` style prefix, each at most once.

    Most ids carry neither, so a cheap look at the first characters comes before the two
    regular expressions.
    """
    stripped = F.regexp_replace(
        F.regexp_replace(identifier, AUTHORITY_URI_PREFIX, ""), AUTHORITY_ISIL_PREFIX, ""
    )
    prefixed = identifier.startswith("http") | identifier.startswith("(")
    return F.when(prefixed, stripped).otherwise(identifier)


def entity_type(types: Column) -> Column:
    """First type of the priority order that is in the list; NULL or no hit gives ``Other``."""
    ladder = reduce(
        lambda case, name: case.when(F.array_contains(types, name), F.lit(name)),
        TYPE_PRIORITY[1:],
        F.when(F.array_contains(types, TYPE_PRIORITY[0]), F.lit(TYPE_PRIORITY[0])),
    )
    return ladder.otherwise(F.lit(OTHER_TYPE))
