"""Checks and repairs of the fact and its sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.functions.measures import clamp_unit

CRITICAL_COLUMNS = ("order_key", "customer_key", "product_key", "order_date", "order_quantity")
POSITIVE_COLUMNS = ("order_quantity", "unit_price", "order_value")
UNIT_SCORES = ("delivery_performance_score", "stock_out_risk_score")

# What stands for a missing measure.
FILL_VALUES: dict[str, int | Decimal] = {
    "delivery_time_days": 0,
    "shipping_cost": Decimal("0.0"),
    "current_stock_level": 0,
    "stock_out_risk_score": Decimal("0.5"),
    "delivery_performance_score": Decimal("1.0"),
    "quality_rating": Decimal("3.0"),
}


def null_counts(columns: Sequence[str] = CRITICAL_COLUMNS) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def null_profile(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """Number of NULLs of each column, in one pass; one row per column."""
    counts = df.agg(*null_counts(columns))
    return counts.unpivot([], list(columns), "column_name", "null_count")


def valid_lines(df: DataFrame) -> DataFrame:
    """Keep lines whose quantity, price and value are positive; NULL is not."""
    return df.filter(" AND ".join(f"{c} > 0" for c in POSITIVE_COLUMNS))


def fill_defaults(
    df: DataFrame, values: Mapping[str, int | Decimal] = FILL_VALUES
) -> DataFrame:
    types = dict(df.dtypes)
    filled = {
        c: f"coalesce({c}, CAST({v} AS {types[c]})) AS {c}"
        for c, v in values.items()
        if c in types
    }
    return df.selectExpr(*[filled.get(c, c) for c in df.columns])


def clamp_scores(df: DataFrame, columns: Sequence[str] = UNIT_SCORES) -> DataFrame:
    return df.withColumns(
        {c: clamp_unit(F.col(c)).cast(df.schema[c].dataType) for c in columns}
    )


def clean_fact(df: DataFrame) -> DataFrame:
    """The cleaning step. It comes after histories and risk score, which see the raw lines."""
    return df.transform(valid_lines).transform(fill_defaults).transform(clamp_scores)


def key_violations(df: DataFrame, source: str, keys: Sequence[str]) -> DataFrame:
    """Key values, as JSON, that are NULL or not unique, with their number of rows."""
    broken = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys], F.lit(False))
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter((F.col("row_count") > 1) | broken)
        .select(
            F.lit(source).alias("source_name"),
            F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("key_value"),
            "row_count",
        )
    )


def orphan_keys(
    child: DataFrame, column: str, parent: DataFrame, parent_key: str, rule: str
) -> DataFrame:
    """Foreign key values without a parent, with their number of child rows.

    Children are counted per value before the join, so a frequent value is one row of it.
    """
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(F.col(parent_key).alias("key_value"))
    return used.join(known, "key_value", "left_anti").select(
        F.lit(rule).alias("rule"), F.col("key_value").cast("bigint"), "row_count"
    )


def length_violations(df: DataFrame, source: str, limits: Mapping[str, int]) -> DataFrame:
    """One row per column and over-long value, found in one pass over ``df``."""
    checks = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("value"),
                F.lit(n).alias("max_length"),
            )
            for c, n in limits.items()
        ]
    )
    return (
        df.select(F.inline(checks))
        .filter("length(value) > max_length")
        .select(F.lit(source).alias("source_name"), "column_name", "value", "max_length")
    )
