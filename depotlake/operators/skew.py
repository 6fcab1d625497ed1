"""Joins that stay balanced when a few keys hold a large part of the rows.

Adaptive execution splits skewed join partitions by itself, but not where a later join relies on
the same partitioning, and not on the right side of a left join. For those, keys with many rows
are found beforehand and their rows spread over several sub-keys.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlake.operators.staging import stage


@dataclass(frozen=True)
class SkewPolicy:
    """``key_rows`` is what a task may read of one key, ``task_rows`` of one sorted range.

    A join side is broadcast up to ``broadcast_bytes``, by its counted rows and declared columns.
    None of these changes a result.
    """

    key_rows: int = 2_000_000
    task_rows: int = 2_000_000
    broadcast_bytes: int = 16_000_000


#: What a string column is taken to need in a broadcast.
STRING_BYTES = 40


def broadcast_size(df: DataFrame, rows: int) -> int:
    """Bytes that ``rows`` rows of ``df`` need in a hashed broadcast, at a rough estimate."""
    widths = [STRING_BYTES if isinstance(f.dataType, T.StringType) else 8 for f in df.schema]
    return rows * (sum(widths) + 40)


@dataclass(frozen=True)
class HeavyKeys:
    """Keys with more rows than a task should read, and the number of ways to spread each.

    They are a stored table, one row per key and no more than rows / ``key_rows`` of them.
    """

    columns: tuple[str, ...]
    found: DataFrame | None = None

    def __bool__(self) -> bool:
        return self.found is not None

    def mark(self, df: DataFrame, name: str) -> DataFrame:
        """Add column ``name``: the number of ways of the row's key, 1 for ordinary keys."""
        if self.found is None:
            return df.withColumn(name, F.lit(1))
        marks = self.found.toDF(*[f"__k{i}" for i in range(len(self.columns))], "__ways")
        same = reduce(
            Column.__and__,
            [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(self.columns)],
        )
        return df.join(marks, same, "left").select(
            *df.columns, F.coalesce("__ways", F.lit(1)).alias(name)
        )


#: Hash values that keys are sieved by, for each heavy key there may be; and the most in all.
HASHES_PER_HEAVY_KEY = 8
MOST_HASHES = 100_000


def heavy_keys(
    df: DataFrame, columns: list[str], policy: SkewPolicy, total: int | None = None
) -> HeavyKeys:
    """Find the keys with more than ``key_rows`` rows; ``total`` is the row count, if it is known.

    Counts are exact and combined in each task before the shuffle. With ``total``, keys are counted
    only where enough rows share a hash value, so a task need not hold every key that it reads.
    """
    if total is not None and total <= policy.key_rows:
        return HeavyKeys(tuple(columns))
    hashes = None if total is None else HASHES_PER_HEAVY_KEY * -(-total // policy.key_rows)
    if hashes is not None and hashes <= MOST_HASHES:
        hashed = df.withColumn("__hash", F.pmod(F.xxhash64(*columns), F.lit(hashes)))
        shared = hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__rows"))
        shared = stage(shared.filter(F.col("__rows") > policy.key_rows).select("__hash"), "hashes")
        if shared.isEmpty():
            return HeavyKeys(tuple(columns))
        df = hashed.join(F.broadcast(shared), "__hash", "left_semi")  # at most total / key_rows
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__rows"))
    many = counted.filter(F.col("__rows") > policy.key_rows)
    ways = (F.ceil(F.col("__rows") / policy.key_rows) + 1).cast("int").alias("__ways")
    found = stage(many.select(*columns, ways), "heavy_keys")
    return HeavyKeys(tuple(columns), None if found.isEmpty() else found)


def numbered(df: DataFrame, name: str, heavy: Callable[[], HeavyKeys]) -> DataFrame:
    """``df``, stored with a number for each row where ``heavy`` is found, so that even copies of
    a row differ and can be spread, and a task that is run again spreads them the same way.
    """
    if not heavy():
        return df
    return stage(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def spread_over(df: DataFrame, ways: str) -> Column:
    """A sub-key of the row in [0, ways), by all its columns, the same on every evaluation."""
    return F.pmod(F.xxhash64(*df.columns), F.col(ways)).cast("int")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    left_heavy: HeavyKeys | None = None,
    right_heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Equi-join on the shared columns ``on``; ``how`` is inner or left.

    The rows of a heavy key are spread over sub-keys on the side where the key is heavy, and the
    matching rows of the other side are repeated once per sub-key, so every pair meets exactly
    once. Left rows are repeated only for sub-keys that the right side has, so none of them comes
    out unmatched besides. The left's heavy keys may be given on a subset of ``on``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if not left_heavy and not right_heavy:
        return left.join(right, on, how)
    columns = [*on, *[c for c in left.columns if c not in on]]
    columns += [c for c in right.columns if c not in on]
    left_heavy = left_heavy or HeavyKeys(tuple(on))
    right_heavy = right_heavy or HeavyKeys(tuple(on))
    if right_heavy.columns != tuple(on):
        raise ValueError(f"heavy keys of the right side must be on {on}")

    left_rows = left_heavy.mark(left, "__lw").withColumn("__l", spread_over(left, "__lw"))
    marked = right_heavy.mark(right, "__rw").withColumn("__r", spread_over(right, "__rw"))
    every = F.explode(F.sequence(F.lit(0), F.col("__lw") - 1)).alias("__l")
    right_rows = left_heavy.mark(marked, "__lw").select(*right.columns, "__r", every)
    if right_heavy:
        # at most ways sub-keys for each heavy key
        there = marked.filter("__rw > 1").groupBy(*on).agg(F.collect_set("__r").alias("__there"))
        left_rows = left_rows.join(there, on, "left")
        sub_keys = F.explode(F.coalesce("__there", F.array(F.lit(0)))).alias("__r")
        left_rows = left_rows.select(*left.columns, "__l", sub_keys)
    else:
        left_rows = left_rows.withColumn("__r", F.lit(0))
    return left_rows.join(right_rows, [*on, "__l", "__r"], how).select(*columns)


def look_up(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    right_rows: int,
    policy: SkewPolicy,
    how: str = "inner",
    left_heavy: Callable[[], HeavyKeys] | None = None,
    right_heavy: Callable[[], HeavyKeys] | None = None,
) -> DataFrame:
    """Join a side whose rows have been counted: broadcast if they are small enough for every
    executor, else merged after a shuffle, with the heavy keys spread.

    Without the hint the planner would go by file sizes, which say little about the rows of a
    compressed file, and less about rows derived from it.
    """
    if broadcast_size(right, right_rows) <= policy.broadcast_bytes:
        return left.join(F.broadcast(right), on, how)
    return skew_join(
        left,
        right.hint("merge"),
        on,
        how,
        left_heavy=left_heavy() if left_heavy else None,
        right_heavy=right_heavy() if right_heavy else None,
    )
