"""Type inference and typed casts of text columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: accepted date formats in order of preference
DATE_FORMATS = (
    "MMM d yyyy H:m:s",
    "d MMM yyyy H:m:s",
    "d/M/yyyy H:m:s",
    "d-M-yyyy H:m:s",
    "M-d-yyyy H:m:s",
    "M/d/yyyy H:m:s",
    "yyyy-d-M H:m:s",
    "yyyy/d/M H:m:s",
    "yyyy-M-d H:m:s",
    "yyyy/M/d H:m:s",
    "d M yyyy H:m:s",
    "M d yyyy H:m:s",
    "yyyy d M H:m:s",
    "yyyy M d H:m:s",
    "d.M.yyyy H:m:s",
    "M.d.yyyy H:m:s",
    "yyyy.d.M H:m:s",
    "yyyy.M.d H:m:s",
    "d MMM yyyy",
    "d/M/yyyy",
    "d-M-yyyy",
    "M-d-yyyy",
    "M/d/yyyy",
    "yyyy-d-M",
    "yyyy/d/M",
    "yyyy-M-d",
    "yyyy/M/d",
    "d M yyyy",
    "M d yyyy",
    "yyyy d M",
    "yyyy M d",
    "d.M.yyyy",
    "M.d.yyyy",
    "yyyy.d.M",
    "yyyy.M.d",
)
# fixed values: texts of a yes/no column and texts that mean "no value"
TRUE_WORDS = ("oui", "yes", "true", "o", "y", "1", "t")
FALSE_WORDS = ("non", "no", "false", "n", "0", "f")
NULL_WORDS = ("nc", "na", "n")

NUMBER = r"^[+-]?(\d+([.,]\d*)?|[.,]\d+)([eE][+-]?\d+)?$"
INTEGER = r"^[+-]?\d+$"
CODE = r"^0\d"  # a leading zero marks a code, not a number

SPARK_TYPE = {
    "text": "string",
    "bigint": "bigint",
    "numeric": "decimal(38,10)",
    "date": "date",
    "timestamp": "timestamp",
    "boolean": "boolean",
}


def _filled(name: str) -> Column:
    """The value, NULL when empty, so that ``bool_and`` skips it."""
    c = F.col(f"`{name}`").cast("string")
    return F.when(F.length(c) > 0, c)


def shape(fmt: str) -> str:
    """Pattern of the texts a format can read."""
    part = {"MMM": r"\p{L}+\.?", "yyyy": r"\d{4}", "d": r"\d{1,2}", "M": r"\d{1,2}", ".": r"\."}
    part |= {c: r"\d{1,2}" for c in "Hms"}
    return "^" + "".join(part.get(x, x) for x in re.findall(r"MMM|yyyy|.", fmt)) + "$"


def _parses(v: Column, fmt: str) -> Column:
    # failed parses are slow, so only texts of the right shape are tried
    parsed = F.try_to_timestamp(v, F.lit(fmt)).isNotNull()
    return F.when(v.rlike(shape(fmt)), parsed).otherwise(F.lit(False))


def _tests(name: str) -> dict[str, Column]:
    v = _filled(name)

    def every(test: Column) -> Column:
        return F.bool_and(F.when(v.isNotNull(), test))

    number = v.rlike(NUMBER) & ~v.rlike(CODE)
    return {
        "boolean": every(F.lower(v).isin(*TRUE_WORDS, *FALSE_WORDS)),
        "bigint": every(v.rlike(INTEGER) & ~v.rlike(CODE) & v.try_cast("bigint").isNotNull()),
        "numeric": every(number),
        **{f"date:{i}": every(_parses(v, f)) for i, f in enumerate(DATE_FORMATS)},
    }


def infer_types(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """First of boolean, date, bigint, numeric that fits every non-empty value; else text.

    One aggregate over all columns returns one row of flags.
    """
    tests = {c: _tests(c) for c in cols}
    flags = df.agg(
        *[t.alias(f"{i}|{k}") for i, c in enumerate(cols) for k, t in tests[c].items()]
    ).first()

    def verdict(i: int, c: str) -> str:
        if flags[f"{i}|boolean"]:
            return "boolean"
        if any(flags[f"{i}|{k}"] for k in tests[c] if k.startswith("date:")):
            return "date"
        return next((t for t in ("bigint", "numeric") if flags[f"{i}|{t}"]), "text")

    return {c: verdict(i, c) for i, c in enumerate(cols)}


def best_date_format(df: DataFrame, col: str) -> str | None:
    """First format that parses every non-empty value of the column."""
    v = _filled(col)
    flags = (
        df.agg(
            *[
                F.bool_and(F.when(v.isNotNull(), _parses(v, f))).alias(str(i))
                for i, f in enumerate(DATE_FORMATS)
            ]
        )
        .first()
    )
    return next((f for i, f in enumerate(DATE_FORMATS) if flags[str(i)]), None)


def to_timestamp_day(col: Column, fmt: str) -> Column:
    """Midnight of the parsed day."""
    return F.try_to_timestamp(col, F.lit(fmt)).cast("date").cast("timestamp")


def typed(col: Column, kind: str, fmt: str | None = None) -> Column:
    """Text column in its inferred type; empty and unreadable values are NULL."""
    v = F.when(F.length(col) > 0, col)
    if kind == "text":
        return v
    if kind == "boolean":
        low = F.lower(v)
        return F.when(low.isin(*TRUE_WORDS), True).when(low.isin(*FALSE_WORDS), False)
    v = F.when(~F.lower(v).isin(*NULL_WORDS), v)
    if kind == "numeric":
        v = F.replace(v, F.lit(","), F.lit("."))
    if kind in ("bigint", "numeric"):
        return v.try_cast(SPARK_TYPE[kind])
    day = F.try_to_timestamp(v, F.lit(fmt or "yyyy-M-d")).cast("date")
    return day.cast("timestamp") if kind == "timestamp" else day


def cast_typed(df: DataFrame, col: str, kind: str, fmt: str | None = None) -> DataFrame:
    if kind in ("date", "timestamp") and fmt is None:
        fmt = best_date_format(df, col)
    return df.withColumn(col, typed(F.col(f"`{col}`"), kind, fmt))
