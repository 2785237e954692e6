"""Turning raw text into typed values; whatever does not parse becomes NULL."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.model import NA_TOKENS, RUN_FORMAT, RUN_PATTERN

# A plain decimal number between blanks. Spark's own cast, which ignores blanks too, also takes '1d',
# DuckDB's also takes '1_000'.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly expression that later filters and projections share.

    As the single element of an exploded array it is computed once per row. A plain column would be
    copied into each filter pushed below it and computed again there.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def na_to_null(text: Column) -> Column:
    """NULL where the raw text is one of the missing-value tokens."""
    return F.when(~text.isin(*NA_TOKENS), text)


def nan_to_null(value: Column) -> Column:
    """NULL for NaN, which Spark would otherwise order above every number."""
    return F.when(~F.isnan(value), value)


def strict_double(text: Column) -> Column:
    """A double from plain decimal text, surrounded by blanks at most."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def strict_date(text: Column) -> Column:
    """A date from exactly ``yyyy-MM-dd``; a time part or another order gives NULL."""
    return F.try_to_date(text, "yyyy-MM-dd")


def _decimal(kind: str) -> tuple[int, int] | None:
    found = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    return (int(found[1]), int(found[2])) if found else None


def fits(name: str, kind: str) -> Column:
    """False where a present double cannot be stored as ``kind`` ("decimal(p,s)" or "int").

    A range test: the first value too large is the one that rounds up to the next power of ten.
    """
    shape = _decimal(kind)
    limit = f"{10 ** (shape[0] - shape[1]) - 1}.{'9' * shape[1]}5D" if shape else "2147483647.5D"
    return F.expr(f"{name} IS NULL OR abs({name}) < {limit}")


def store_as(name: str, kind: str) -> Column:
    """The double as ``kind``, NULL where it does not fit. Decimals round half away from zero."""
    value = F.col(name) if _decimal(kind) else F.rint(name)
    return F.when(fits(name, kind), value).cast(kind)


def run_of(moment: Column) -> Column:
    """The run identifier of a timestamp."""
    return F.date_format(moment, RUN_FORMAT)


def run_time(run_ts: Column) -> Column:
    """The timestamp (without zone) of a run identifier, NULL if it is none.

    The identifier is rewritten as ISO text, so that no time zone takes part.
    """
    parts = r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})$"
    iso = F.regexp_replace(run_ts, parts, "$1-$2-$3 $4:$5:$6")
    return F.when(run_ts.rlike(parts), iso.try_cast("timestamp_ntz"))


def run_in(path: Column) -> Column:
    """The run identifier inside a file name or directory, NULL if there is none."""
    found = F.regexp_extract(path, RUN_PATTERN, 1)
    return F.when(found != "", found)
