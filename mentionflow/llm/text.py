"""Column functions on text that the operators share."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space as the contracts list it: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def whole(text: Column) -> Column:
    """A text, null as the empty one."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. A text with as many bytes as characters is ASCII, where the faster function agrees."""
    exact = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(exact)


def packed(frame: DataFrame) -> Column:
    """All columns as one struct `row`, so that an operator's own columns cannot clash with them."""
    return F.struct(*[F.col(f"`{name}`") for name in frame.columns]).alias("row")


def carried(frame: DataFrame, changed: Mapping[str, Column] | None = None, without: Sequence[str] = ()) -> list[Column]:
    """The columns out of such a struct again, some changed, some left out."""
    names = [name for name in frame.columns if name not in without]
    return [(changed or {}).get(name, F.col(f"row.`{name}`")).alias(name) for name in names]
