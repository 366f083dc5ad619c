"""Aggregation modes of an areal statistics relation.

``stats`` has one row per (cell, date, dissolved value) with ``inter``, ``cell_prop``,
``var_prop``, ``density``, ``cellvalue_density``, ``value_num`` and ``value_str``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plain(v: Column) -> Column:
    """Number as text without a trailing ``.0``."""
    whole = (v == F.floor(v)) & (F.abs(v) < 1e15)
    return F.when(whole, v.cast("bigint").cast("string")).otherwise(v.cast("string"))


def _rounded_text(v: Column) -> Column:
    return F.coalesce(F.round(v.cast("double"), 4).cast("string"), F.lit(""))


class Rows:
    """The rows an aggregate reads: all, or those for which ``only`` holds."""

    def __init__(self, only: Column | None = None):
        self.only = only

    def of(self, value: Column) -> Column:
        """``value`` on these rows, NULL, which aggregates pass over, on others."""
        return value if self.only is None else F.when(self.only, value)

    def __call__(self, name: str) -> Column:
        return self.of(F.col(name))


def _plus_stats(rows: Rows) -> Column:
    v = rows("value_num")
    return F.to_json(
        F.struct(
            _rounded_text(F.avg(v)).alias("avg_value"),
            _rounded_text(F.min(v)).alias("min_value"),
            _rounded_text(F.max(v)).alias("max_value"),
            _rounded_text(F.stddev_samp(v)).alias("stddev_value"),
            _rounded_text(F.median(v)).alias("median_value"),
            F.count(v).cast("string").alias("count"),
        )
    )


def quoted(v: Column) -> Column:
    """Element of an array literal: quoted where the bare text would be ambiguous."""
    special = v.rlike(r'^$|[,{}"\\\s]') | (F.lower(v) == "null")
    escaped = F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.when(special, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(v)


def _array_text(items: Column, has_null: Column) -> Column:
    inner = F.array_join(items, ",")
    tail = F.when(has_null, F.when(F.size(items) > 0, F.lit(",NULL")).otherwise(F.lit("NULL")))
    return F.concat(F.lit("{"), inner, F.coalesce(tail, F.lit("")), F.lit("}"))


def _distinct_list(rows: Rows, v: Column, text: Callable[[Column], Column]) -> Column:
    """Sorted distinct values as text; a NULL among them comes last."""
    items = F.transform(F.array_sort(F.collect_set(rows.of(v))), text)
    return _array_text(items, F.max(rows.of(v.isNull())))


def _json_list(rows: Rows, fields: Sequence[str]) -> Column:
    def as_text(name: str) -> Column:
        c = F.col(name)
        return F.coalesce(c if name == "value_str" else plain(c), F.lit("")).alias(name)

    item = F.to_json(F.struct(*[as_text(f) for f in fields]))
    return _array_text(F.transform(F.array_sort(F.collect_set(rows.of(item))), quoted), F.lit(False))


def _largest_share(rows: Rows) -> Column:
    """Text of the piece with the largest share of the cell; equal shares give the first text."""
    return F.min_by("value_str", rows.of(F.struct(-F.col("cell_prop"), F.col("value_str"))))


_V = "value_num"

MODES: dict[str, Callable[[Rows], Column]] = {
    "intersect": lambda r: F.sum(r("inter")),
    "intersect/1000": lambda r: F.sum(r("inter")) / 1000,
    "prop_surf": lambda r: F.sum(r("cell_prop")),
    "prop_len": lambda r: F.sum(r("cell_prop")),
    "md_prop": lambda r: F.sum(r(_V) * r("cell_prop")),
    "md_prop_norm": lambda r: F.try_divide(F.sum(r(_V) * r("cell_prop")), F.sum(r("cell_prop"))),
    "tot_dens": lambda r: F.sum(r("cellvalue_density")),
    "val_sum": lambda r: F.sum(r(_V)),
    "val_min": lambda r: F.min(r(_V)),
    "val_max": lambda r: F.max(r(_V)),
    "val_avg": lambda r: F.avg(r(_V)),
    "val_stddev": lambda r: F.stddev_samp(r(_V)),
    "val_median": lambda r: F.median(r(_V)),
    "plus_stats": _plus_stats,
    "value_str_mode_inter": _largest_share,
    "ct_elt": lambda r: F.count(r.of(F.lit(1))),
    "ct_elt_num": lambda r: F.count_distinct(r(_V)),
    "ct_elt_str": lambda r: F.count_distinct(r("value_str")),
    "value_full": lambda r: _json_list(r, ["value_num", "value_str", "cell_prop", "cellvalue_density"]),
    "value_str_full": lambda r: _json_list(r, ["value_str", "cell_prop"]),
    "value_num_agg": lambda r: _distinct_list(r, F.col(_V), plain),
    "value_str_agg": lambda r: _distinct_list(r, F.col("value_str"), quoted),
}

# modes that read a share of the cell or of the feature; points have neither
SHARE_MODES = {
    "intersect",
    "intersect/1000",
    "prop_surf",
    "prop_len",
    "md_prop",
    "md_prop_norm",
    "tot_dens",
    "value_str_mode_inter",
    "value_full",
    "value_str_full",
}


def mode_column(mode: str | None, dtype: str, only: Column | None = None) -> Column:
    """Aggregate expression of a mode, over the rows for which ``only`` holds; an empty mode is a NULL column."""
    if not mode:
        return F.lit(None).cast(dtype)
    if mode not in MODES:
        raise ValueError(f"unknown aggregation mode: {mode!r}")
    return MODES[mode](Rows(only)).cast(dtype)


def areal_aggregate(
    stats: DataFrame,
    num_mode: str | None = None,
    str_mode: str | None = None,
    keys: Sequence[str] = ("id_cell", "date_result"),
) -> DataFrame:
    """One row per key with ``value_num`` and ``value_str``."""
    return stats.groupBy(*keys).agg(
        mode_column(num_mode, "double").alias("value_num"),
        mode_column(str_mode, "string").alias("value_str"),
    )
