from decimal import Decimal

import pytest
from retail import ROWS, sources

from depotlake.operators import quality
from depotlake.sources import preview, source_counts, with_defaults
from depotlake.sources.registry import Sources


def test_invalid_lines_are_dropped(spark):
    rows = [(2, "1.00", "2.00"), (0, "1.00", "0.00"), (-1, "1.00", "-1.00"), (None, "1.00", None), (1, "0.00", "0.00")]
    df = spark.createDataFrame(rows, "order_quantity int, unit_price string, order_value string")
    df = df.selectExpr(
        "order_quantity",
        "CAST(unit_price AS decimal(10,2)) unit_price",
        "CAST(order_value AS decimal(21,2)) order_value",
    )
    assert [r.order_quantity for r in quality.valid_lines(df).collect()] == [2]


def test_clamp_keeps_null(spark):
    values = ["-0.10", "0.00", "0.50", "1.00", "1.06", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    df = df.selectExpr("CAST(v AS decimal(3,2)) AS v")
    clamped = [r.v for r in quality.clamp_scores(df, ["v"]).collect()]
    assert clamped == [0, 0, Decimal("0.50"), 1, 1, None]
    assert quality.clamp_scores(df, ["v"]).dtypes == df.dtypes


def test_fill_defaults(spark):
    df = spark.createDataFrame(
        [(None, None)], "stock_out_risk_score decimal(3,2), quality_rating double"
    )
    row = quality.fill_defaults(df).first()
    assert (row.stock_out_risk_score, row.quality_rating) == (Decimal("0.50"), 3.0)


def test_null_profile_is_one_row_per_column(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, 5)], "a int, b int")
    profile = {r.column_name: r.null_count for r in quality.null_profile(df, ["a", "b"]).collect()}
    assert profile == {"a": 1, "b": 2}


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 3)], "a int, b int")
    found = {r.key_value: r.row_count for r in quality.key_violations(df, "t", ["a", "b"]).collect()}
    assert found == {'{"a":1,"b":1}': 2, '{"a":null,"b":3}': 1}


def test_key_texts_are_told_apart(spark):
    rows = [(None, "1"), ("1", None), ("a|b", "c"), ("a|b", "c"), ("a", "b|c"), ("a", "b|c")]
    df = spark.createDataFrame(rows, "a string, b string")
    found = [r.key_value for r in quality.key_violations(df, "t", ["a", "b"]).collect()]
    assert len(set(found)) == len(found) == 4


def test_declared_defaults_stand_from_loading(spark):
    from datetime import date, datetime

    s, now = sources(spark), datetime(2024, 5, 1, 12)
    gaps = s["inventory"].selectExpr("*", "CAST(NULL AS int) AS record_version", "now() AS x",
                                     "CAST(NULL AS timestamp) AS created_timestamp",
                                     "CAST(NULL AS date) AS effective_end_date")
    row = Sources({**s, "inventory": gaps}, load_time=now)["inventory"].first()
    assert row.record_version == 1 and row.created_timestamp == now
    assert row.effective_end_date == date(9999, 12, 31) and not hasattr(row, "x")


def test_known_counts_are_not_taken_again(spark):
    s = sources(spark)
    told = Sources(dict(s), row_counts={"orders": 77})
    assert told.rows("orders", "customers") == {"orders": 77, "customers": 2}


def test_orphans(spark):
    s = sources(spark, orders=[*ROWS["orders"], (13, 77, None), (14, 77, None), (15, None, None)])
    found = quality.orphan_keys(s["orders"], "customer_id", s["customers"], "customer_id", "r")
    assert [tuple(r) for r in found.collect()] == [("r", 77, 2)]


def test_length_violations(spark):
    df = spark.createDataFrame([("abcd", "x"), ("ab", None)], "a string, b string")
    found = quality.length_violations(df, "t", {"a": 3, "b": 3}).collect()
    assert [tuple(r) for r in found] == [("t", "a", "abcd", 3)]


def test_sources_are_counted_once_and_previewed(spark):
    s = sources(spark)
    assert s.rows("orders", "customers") == {"orders": 3, "customers": 2}
    assert {r.source_name: r.row_count for r in source_counts(s).collect()}["inventory"] == 2
    assert preview(s["orders"], 2).count() == 2
    with pytest.raises(ValueError):
        Sources({"orders": s["orders"]})


def test_current_versions_only(spark):
    s = sources(spark)
    given = {n: s[n] for n in s}
    given["warehouses"] = s["warehouses"].selectExpr("*", "false AS is_current")
    assert Sources(given)["warehouses"].count() == 1
    assert Sources(given, current_only=True)["warehouses"].count() == 0


def test_load_time_defaults(spark):
    from datetime import datetime

    now = datetime(2024, 5, 1, 12)
    df = spark.createDataFrame([(1, None, None)], "shipment_id int, is_late boolean, created_timestamp timestamp")
    row = with_defaults(df, "shipments", now).first()
    assert row.is_late is False
    assert row.created_timestamp is not None
