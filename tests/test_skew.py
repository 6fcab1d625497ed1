"""Joins and numbering of skewed keys against plain joins and windows."""

import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from depotlake.operators import running, skew
from depotlake.operators.running import (
    CUSTOMER,
    PRODUCT,
    SUPPLIER,
    stored_lines,
    with_histories,
)
from depotlake.operators.skew import (
    SkewPolicy,
    broadcast_size,
    heavy_keys,
    look_up,
    numbered,
    skew_join,
    spread_over,
)
from depotlake.operators.staging import stage

EAGER = SkewPolicy(key_rows=3, task_rows=20, broadcast_bytes=0)


def rows_of(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def sides(spark):
    pick = random.Random(5)
    keys = [1] * 60 + [2] * 20 + [None] * 15 + list(range(3, 40))
    left = spark.createDataFrame(
        [(k, pick.randrange(4), n) for n, k in enumerate(keys)], "k int, m int, a int"
    )
    keys = [1] * 5 + [50] * 30 + [7] * 40 + [None] * 20 + list(range(2, 30))
    right = spark.createDataFrame(
        [(k, pick.randrange(4), n) for n, k in enumerate(keys)], "k int, m int, b int"
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("on", [["k"], ["k", "m"]])
@pytest.mark.parametrize("heavy", ["left", "right", "both"])
def test_skew_join_equals_join(sides, how, on, heavy):
    left, right = sides
    if "m" not in on:
        left = left.drop("m")
    left_heavy = heavy_keys(left, ["k"], EAGER) if heavy != "right" else None
    right_heavy = heavy_keys(right, on, EAGER) if heavy != "left" else None
    assert left_heavy or right_heavy
    result = skew_join(left, right, on, how, left_heavy, right_heavy)
    assert rows_of(result) == rows_of(left.join(right, on, how))
    if how == "left":
        assert rows_of(
            look_up(left, right, on, 10, EAGER, how, lambda: left_heavy, lambda: right_heavy)
        ) == rows_of(left.join(right, on, how))


def test_copies_of_a_row_are_spread(spark, sides):
    """Copies differ by the number they are stored with, so they get several sub-keys."""
    copies = spark.createDataFrame([(1, 5)] * 60, "k int, b int")
    heavy = heavy_keys(copies, ["k"], EAGER)
    stored = numbered(copies, "__n", lambda: heavy)
    marked = heavy.mark(stored, "__w").withColumn("__s", spread_over(stored, "__w"))
    counts = [r["count"] for r in marked.groupBy("__s").count().collect()]
    assert len(counts) > 5 and max(counts) < 15
    left = spark.createDataFrame([(1, n) for n in range(4)] + [(2, 9)], "k int, a int")
    result = skew_join(left, stored, ["k"], "left", right_heavy=heavy).drop("__n")
    assert rows_of(result) == rows_of(left.join(copies, ["k"], "left"))


def test_left_rows_are_read_once(spark):
    left = spark.range(97).selectExpr("id % 7 AS k", "id AS a")
    right = spark.range(53).selectExpr("id % 5 AS k", "id AS b")
    heavy = heavy_keys(right, ["k"], EAGER)
    joined = skew_join(left, right, ["k"], "left", right_heavy=heavy)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 97") == 1 and "Union" not in plan
    assert rows_of(joined) == rows_of(left.join(right, ["k"], "left"))


def test_heavy_keys_are_a_table_of_exact_counts(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    found = heavy_keys(df, ["k"], SkewPolicy(key_rows=300))
    assert [tuple(r) for r in found.found.collect()] == [(0, 5)]
    assert not heavy_keys(df, ["k"], SkewPolicy())
    assert not heavy_keys(df, ["k"], SkewPolicy(key_rows=300), total=300)


def test_keys_are_counted_only_where_rows_share_a_hash(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(skew, "stage", lambda df, label: stored.append((label, stage(df, label))) or stored[-1][1])
    even = spark.range(3000).selectExpr("id % 1000 AS k", "id % 7 AS m")
    assert not heavy_keys(even, ["k", "m"], SkewPolicy(key_rows=700), total=3000)
    assert [label for label, _ in stored] == ["hashes"]  # no task has held a row for each key
    crowded = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 5).otherwise(F.col("id"))
    df = spark.range(3000).select(crowded.alias("k"))
    for key_rows in (300, 1000, 1001, 1):  # 1001 rows have key 5; with 1, hash values tell all keys apart
        policy = SkewPolicy(key_rows=key_rows)
        known, plain = heavy_keys(df, ["k"], policy, total=3000), heavy_keys(df, ["k"], policy)
        assert bool(known) == bool(plain) == (key_rows < 1001)
        assert not known or rows_of(known.found) == rows_of(plain.found)
    monkeypatch.setattr(skew, "MOST_HASHES", 10)
    assert rows_of(heavy_keys(df, ["k"], SkewPolicy(key_rows=300), total=3000).found) == Counter(
        {(5, 5): 1, (5, None): 1}
    )


def test_broadcast_goes_by_bytes(spark):
    narrow, wide = spark.range(1), spark.range(1).selectExpr("id", *[f"'x' AS c{n}" for n in range(50)])
    assert broadcast_size(wide, 1000) > 20 * broadcast_size(narrow, 1000)


def test_outer_join_needs_full_key(sides):
    left, right = sides
    with pytest.raises(ValueError):
        skew_join(left, right, ["k", "m"], "left", right_heavy=heavy_keys(right, ["k"], EAGER))


LINES = (
    "order_key bigint, product_key bigint, line_number int, order_quantity int,"
    " unit_price decimal(10,2), order_value decimal(21,2), customer_key bigint,"
    " supplier_key bigint, order_date date, delivery_time_days int, is_late_delivery boolean"
)


@pytest.fixture(scope="module")
def lines(spark):
    """One customer and one day hold a third of all lines; dates and measures may be missing."""
    pick = random.Random(11)
    rows = []
    for n in range(900):
        crowded = n % 3 == 0
        day = None if n % 50 == 1 else date(2024, 1, 1) + timedelta(pick.randrange(20))
        quantity = pick.randrange(1, 9)
        rows.append(
            (
                n // 4,
                pick.randrange(12),
                n % 4,
                None if n % 70 == 2 else quantity,
                Decimal(pick.randrange(100, 999)) / 100,
                None if n % 90 == 3 else Decimal(quantity),
                0 if crowded else pick.randrange(30),
                pick.randrange(5),
                date(2024, 1, 7) if crowded else day,
                None if n % 40 == 4 else pick.randrange(6),
                None if n % 60 == 5 else pick.random() < 0.3,
            )
        )
    return spark.createDataFrame(rows, LINES)


SHORT = SkewPolicy(task_rows=7)
ONE_RANGE = SkewPolicy()


@pytest.fixture(scope="module")
def stored(lines):
    return stored_lines(lines)


@pytest.mark.parametrize("history", [CUSTOMER, SUPPLIER, PRODUCT], ids=lambda h: h.key)
def test_numbers_do_not_depend_on_ranges(stored, history):
    """Sequences and all: short ranges cut every key, the default cuts none."""
    short = with_histories(stored, history, policy=SHORT)
    assert rows_of(short) == rows_of(with_histories(stored, history, policy=ONE_RANGE))


def test_short_ranges_share_a_task(stored, monkeypatch):
    placed = []
    monkeypatch.setattr(running, "stage", lambda df, label: placed.append(stage(df, label)) or placed[-1])
    short = with_histories(stored, CUSTOMER, policy=SHORT)
    tasks = placed[0].select(F.shiftright("__at", 33)).distinct().count()
    assert tasks <= 4  # the shuffle partitions; a task for each range would make 129
    plan = short._jdf.queryExecution().optimizedPlan().toString()
    assert "% 7" in plan  # ranges are as short as the policy says


def test_numbers_are_those_of_a_plain_window(stored):
    ties = ["order_key", "line_number", "product_key", "order_quantity", "unit_price", "line_id"]
    plain = Window.partitionBy("customer_key").orderBy("order_date", *ties)
    number = F.row_number().over(plain).cast("bigint").alias("customer_order_sequence")
    found = with_histories(stored, CUSTOMER, policy=SHORT)
    found = found.select("line_id", "customer_order_sequence")
    assert rows_of(found) == rows_of(stored.select("line_id", number))


def test_reversed_input_gives_equal_numbers(spark):
    """Two shipments and two stock records of one line: their own numbers order them."""
    schema = LINES + ", shipment_id bigint, inventory_id bigint"
    line = (1, 2, 3, 4, Decimal("1.00"), Decimal(4), 9, 1, date(2024, 1, 7), 2, True)
    rows = [(*line, s, i) for s in (5, 6) for i in (7, 8)] + [(*line, None, None)]
    found = [
        rows_of(
            with_histories(
                stored_lines(spark.createDataFrame(given, schema).coalesce(1)), CUSTOMER, policy=SHORT
            ).drop("line_id")
        )
        for given in (rows, rows[::-1])
    ]
    assert found[0] == found[1] and len(found[0]) == 5


def test_copies_of_a_line_are_spread(spark):
    """A third of all lines are one line, over and over; no range takes them all."""
    line = (1, 2, 3, 4, Decimal("1.00"), Decimal(4), 9, 1, date(2024, 1, 7), 2, True)
    rows = [line] * 200 + [
        (n, n % 7, 1, 1, Decimal(n), Decimal(n), 9, 1, date(2024, 1, 1 + n % 12), 1, False)
        for n in range(400)
    ]
    df = stored_lines(spark.createDataFrame(rows, LINES))
    found = with_histories(df, CUSTOMER, policy=SkewPolicy(task_rows=20)).collect()
    found = sorted(found, key=lambda r: r.customer_order_sequence)
    assert [r.customer_order_sequence for r in found] == list(range(1, 601))
    assert [r.order_date for r in found] == sorted(r.order_date for r in found)


def test_even_keys_stay_below_the_bound(spark):
    """2,500 keys of equal size, none of which stands out: ranges are short all the same."""
    rows = spark.range(50_000).selectExpr(
        "id AS order_key", "id AS product_key", "1 AS line_number", "1 AS order_quantity",
        "CAST(1 AS decimal(10,2)) AS unit_price", "CAST(1 AS decimal(21,2)) AS order_value",
        "id % 2500 AS customer_key", "id % 2500 AS supplier_key", "date'2024-01-01' AS order_date",
        "1 AS delivery_time_days", "false AS is_late_delivery",
    )
    df = stored_lines(rows)
    order = ["customer_key", "order_date", "order_key", "line_id"]
    ranges = df.repartitionByRange(50_000 // 1000, *order).groupBy(F.spark_partition_id()).count()
    assert ranges.agg(F.max("count")).first()[0] <= 3 * 1000
    found = with_histories(df, CUSTOMER, policy=SkewPolicy(task_rows=1000))
    assert found.agg(F.max("customer_order_sequence"), F.count("*")).first() == (20, 50_000)


def test_all_histories_at_once(stored):
    short = with_histories(stored, CUSTOMER, SUPPLIER, PRODUCT, policy=SHORT)
    plain = with_histories(stored, CUSTOMER, SUPPLIER, PRODUCT, policy=ONE_RANGE)
    assert short.columns == plain.columns
    assert rows_of(short) == rows_of(plain)


def test_history_against_plain_python(stored):
    result = with_histories(stored, CUSTOMER, policy=SHORT).collect()
    first = date(1, 1, 1)
    for row in result:
        mine = [r for r in result if r.customer_key == row.customer_key]
        day = row.order_date or first
        before = [r for r in mine if (r.order_date or first) < day]
        reached = [r for r in mine if (r.order_date or first) <= day]
        assert row.customer_total_orders == len(before) + 1
        assert row.customer_cumulative_value == sum(r.order_value or 0 for r in reached)
        assert len(before) < row.customer_order_sequence <= len(reached)


def test_windows_hold_a_row_for_each_day(stored):
    """No window reads lines: only days, and the parts that ranges hold of a key."""
    plan = with_histories(stored, CUSTOMER, policy=SHORT)._jdf.queryExecution().optimizedPlan()
    windows = [x for x in plan.toString().splitlines() if "Window [" in x]
    assert windows and not any("line_id" in x or "order_key" in x for x in windows)


def test_lines_and_entries_stay_where_they_are_stored(spark, stored):
    """Only outputs are shuffled, and rows for each range: neither the full lines nor the entries again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = with_histories(stored, CUSTOMER, SUPPLIER, PRODUCT, policy=SHORT)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: false" not in plan and plan.count("Bucketed: true") >= 2
        assert plan.count("Exchange hashpartitioning(shiftright(line_id") == 1
        assert "Exchange hashpartitioning(line_id" not in plan
        plain = with_histories(stored, CUSTOMER, SUPPLIER, PRODUCT, policy=ONE_RANGE)
        assert rows_of(found) == rows_of(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_missing_lines_are_an_error(stored):
    """Outputs are found by a line's place in its block, so none may be left out."""
    with pytest.raises(Exception, match="stored lines are missing"):
        with_histories(stored.filter("customer_key <> 0"), CUSTOMER, policy=SHORT).collect()
