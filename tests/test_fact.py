from decimal import Decimal

from pyspark.sql import functions as F
from retail import DAY, ROWS, sources

from depotlake.operators.fact import fact_base, order_lines, with_derived
from depotlake.plans.warehouse import enhanced_fact, plain_fact
from depotlake.schemas import TABLES, columns, to_table
from depotlake.sources import adapter


def lines_of(spark, **changed):
    lines = order_lines(sources(spark, **changed)).transform(fact_base).transform(with_derived)
    return sorted(lines.collect(), key=lambda r: (r.order_key, r.line_number))


def test_order_without_shipment_gets_defaults(spark):
    lines = lines_of(spark)
    line = lines[1]
    assert (line.order_key, line.warehouse_key) == (11, None)
    assert (line.warehouse_name, line.warehouse_region) == ("Unknown", "Unknown")
    assert (line.stock_status, line.movement_velocity) == ("UNKNOWN", "UNKNOWN")
    assert (line.delivery_time_days, line.is_late_delivery) == (0, False)
    assert (line.delivery_performance_score, line.quality_rating) == (1, 5)
    assert line.inventory_turnover_category == "UNKNOWN_TURNOVER"


def test_two_shipments_double_the_line(spark):
    again = (3, *ROWS["shipments"][0][1:])
    lines = lines_of(spark, shipments=[*ROWS["shipments"], again])
    assert [r.order_key for r in lines] == [10, 10, 11, 12]


def test_two_stock_records_double_the_line(spark):
    again = (3, *ROWS["inventory"][0][1:])
    lines = lines_of(spark, inventory=[*ROWS["inventory"], again])
    assert [r.order_key for r in lines] == [10, 10, 11, 12]


def test_unknown_warehouse_finds_no_stock(spark):
    gone = (1, 10, 7, 6, *ROWS["shipments"][0][4:])
    lines = lines_of(
        spark,
        shipments=[gone],
        inventory=[(1, 6, 100, 40, 10, "HEALTHY", 9, Decimal("0.85"), "FAST")],
    )
    assert lines[0].warehouse_key is None
    assert lines[0].stock_status == "UNKNOWN"
    assert lines[0].delivery_time_days == 5


def test_item_of_unknown_product_vanishes(spark):
    lost = (10, 999, 1, Decimal("1.00"), 2)
    lines = lines_of(spark, order_items=[*ROWS["order_items"], lost])
    assert len(lines) == 3


def test_risk_cut(spark):
    """Late at 0.85 is exactly 0.7, late at 0.87 is above, on time stays below."""
    late = [(n, n, 7, 5, DAY, DAY, DAY, Decimal(1), 5, n < 12, Decimal(4), Decimal(1)) for n in (10, 11, 12)]
    stock = [
        (1, 5, 100, 1, 1, "LOW", 1, Decimal("0.85"), "FAST"),
        (2, 5, 101, 1, 1, "LOW", 1, Decimal("0.87"), "FAST"),
        (3, 5, 102, 1, 1, "LOW", 1, Decimal("1.00"), "FAST"),
    ]
    items = [(10, 100, 1, Decimal(1), 1), (11, 101, 1, Decimal(1), 1), (12, 102, 1, Decimal(1), 1)]
    products = [(100, "a", 1, 7), (101, "b", 1, 7), (102, "c", 1, 7)]
    lines = lines_of(
        spark, shipments=late, inventory=stock, order_items=items, products=products
    )
    scores = [r.supply_chain_risk_score for r in lines]
    assert scores == [Decimal("0.700"), Decimal("0.708"), Decimal("0.400")]


def test_date_tie(spark):
    """Two orders of one customer on one day: equal rank and total, different numbers."""
    lines = {r.order_key: r for r in enhanced_fact(sources(spark)).collect()}
    first, second = lines[10], lines[11]
    assert {first.customer_order_sequence, second.customer_order_sequence} == {1, 2}
    assert first.customer_total_orders == second.customer_total_orders == 1
    assert first.customer_cumulative_value == second.customer_cumulative_value == 30


def test_invalid_lines_keep_their_numbers(spark):
    """Cleaning drops the line after the numbering, which leaves a gap."""
    items = [
        (10, 100, 0, Decimal("10.00"), 1),
        (11, 100, None, Decimal("10.00"), 1),
        (12, 100, 3, Decimal("5.50"), 1),
    ]
    s = sources(spark, order_items=items)
    from depotlake.plans.warehouse import full_fact

    (line,) = full_fact(s).collect()
    assert line.product_order_sequence == 3
    assert plain_fact(s).count() == 1


def test_contract_columns_and_types(spark):
    fact = to_table(enhanced_fact(sources(spark)), "supply_chain_fact")
    assert fact.dtypes == columns(TABLES["supply_chain_fact"])
    assert len(fact.columns) == 44


def test_unlisted_part_type_keeps_its_lines(spark, tmp_path):
    """Categories come from the data, so a new one is numbered like the others."""
    import shutil

    from depotlake.sources import retail_sources

    given = "/root/testdata/sf0.001"
    for name in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        shutil.copy(f"{given}/{name}.parquet", tmp_path)
    part = spark.read.parquet(f"{given}/part.parquet")
    changed = part.selectExpr(
        *[c if c != "p_type" else "IF(p_partkey % 4 = 0, 'NOVELTY', p_type) AS p_type" for c in part.columns]
    )
    changed.write.parquet(str(tmp_path / "part.parquet"))
    s = retail_sources(spark, str(tmp_path))
    assert order_lines(s).count() == retail_sources(spark, given)["order_items"].count()
    names = [r.category_name for r in s["categories"].orderBy("category_id").collect()]
    assert names == sorted(names) and "NOVELTY" in names


def test_stock_records_are_made_by_many_tasks(spark, monkeypatch):
    """One task reads all the parts, with a missing and a repeated key among them."""
    part = spark.createDataFrame([(n,) for n in [None, 3, 3, *range(40)]], "p_partkey bigint").coalesce(1)

    def made():
        stock = adapter._inventory(part, 25, 43)
        rows = sorted(tuple(r) for r in stock.collect())
        return rows, stock.select(F.spark_partition_id()).distinct().count()

    rows, tasks = made()
    assert tasks == 1 and len(rows) == 40 * 25 * 9 // 10 + 2 * 23
    monkeypatch.setattr(adapter, "TASK_ROWS", 100)
    spread, tasks = made()
    assert spread == rows and tasks > 5
