from datetime import date, datetime

import pytest
from retail import sources

from depotlake.plans import reports, tables, views
from depotlake.plans.warehouse import build_warehouse, enhanced_fact, full_fact, plain_fact
from depotlake.schemas import TABLES, columns, exact_fact, to_table
from depotlake.sources import jdbc

RUN = (date(2024, 6, 1), datetime(2024, 6, 1, 8))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("depot"))
    for _ in range(2):  # a second run replaces the first
        warehouse = build_warehouse(spark, sources(spark), root, *RUN, database="depot_a")
    return root, warehouse


@pytest.mark.parametrize("table", TABLES)
def test_written_tables_keep_the_contract(spark, built, table):
    root, warehouse = built
    assert warehouse.tables[table].dtypes == columns(TABLES[table])
    registered = spark.table(f"depot_a.{table}")
    assert sorted(registered.dtypes) == sorted(columns(TABLES[table]))
    assert registered.count() == warehouse.tables[table].count() > 0


def test_fact_survives_the_round_trip(spark, built):
    _, warehouse = built
    expected = full_fact(sources(spark))
    written = warehouse.fact.select(expected.columns)
    shown = [c for c, t in expected.dtypes if t == dict(written.dtypes)[c]]
    assert {"order_value", "supply_chain_risk_score", "shipping_cost"} <= set(shown)
    assert written.select(shown).exceptAll(expected.select(shown)).count() == 0
    assert written.count() == expected.count()


def test_indicators_and_counts(built):
    _, warehouse = built
    assert warehouse.perfect_order_rate.first().total_orders == 3
    assert warehouse.summary.first().total_records == 3
    counts = {r.table_name: r.row_count for r in warehouse.counts.collect()}
    assert counts["supply_chain_fact"] == 3 and counts["customer_dim"] == 2
    assert warehouse.inventory_turnover.count() == 1


def test_reports_prune_by_year(spark, built):
    plan = (
        built[1]
        .tables["supply_chain_team_metrics"]
        .filter("order_year = 2024")
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "PartitionFilters: [isnotnull(order_year" in plan


def test_risk_filter_reaches_the_scan(built):
    report = reports.high_risk_raw(built[1].tables["supply_chain_fact"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(supply_chain_risk_score,0.7)" in plan
    assert "TakeOrderedAndProject" in plan
    assert "customer_name" not in plan


def test_build_without_catalog(spark, tmp_path):
    build_warehouse(spark, sources(spark), str(tmp_path), *RUN)
    assert tables.read_table(spark, str(tmp_path), "supplier_scorecard").count() == 2


def test_declared_tables_show_written_files(spark, built):
    root, _ = built
    tables.declare_tables(spark, root, "depot_b")
    tables.declare_tables(spark, root, "depot_b")
    names = {r.tableName for r in tables.list_tables(spark, "depot_b").collect()}
    assert set(TABLES) <= names
    assert spark.table("depot_b.supply_chain_fact").count() == 3
    tables.drop_table(spark, "customer_dim", "depot_b")
    assert not spark.catalog.tableExists("depot_b.customer_dim")
    assert tables.read_table(spark, root, "customer_dim").count() == 2


def test_insert_overwrite_by_name(spark, tmp_path):
    tables.declare_tables(spark, str(tmp_path), "depot_c", ["supplier_dim", "supply_chain_fact"])
    fact = to_table(enhanced_fact(sources(spark)), "supply_chain_fact")
    for _ in range(2):
        tables.insert_overwrite(fact, "supply_chain_fact", "depot_c")
    stored = spark.table("depot_c.supply_chain_fact")
    assert stored.count() == 3
    assert {r.order_year for r in stored.collect()} == {2024}
    assert tables.temp_view(fact, "supply_chain_fact") == "temp_supply_chain_fact"
    assert spark.table("temp_supply_chain_fact").count() == 3


def test_views_are_in_the_catalog(spark, built):
    other = spark.newSession()
    months = other.table("depot_a.monthly_supply_chain_performance").orderBy("order_month")
    assert [r.total_orders for r in months.collect()] == [2, 1]
    expected = views.monthly_performance(built[1].fact).collect()
    assert [tuple(r) for r in months.collect()] == [tuple(r) for r in expected]
    assert other.table("depot_a.supplier_performance_trends").count() == 2


def test_build_reports_quality(built):
    quality = built[1].quality
    assert {r.null_count for r in quality["null_profile"].collect()} == {0}
    assert quality["key_violations"].isEmpty() and quality["length_violations"].isEmpty()
    assert quality["orphan_keys"].isEmpty()


def test_few_files_for_each_month(spark, built):
    files = [f.split("fact_table/run=")[1].split("/", 1)[1] for f in built[1].tables["supply_chain_fact"].inputFiles()]
    assert sorted(f.rsplit("/", 1)[0] for f in files) == [
        "order_year=2024/order_month=1", "order_year=2024/order_month=2",
    ]


def test_second_build_adds_versions(spark, tmp_path):
    """A renamed customer, on the second day, on the same day again, and an earlier day."""
    root = str(tmp_path)
    renamed = [(1, "Anna", "ann@example.com"), (2, "Bob", "bob@example.com")]
    later = (date(2024, 7, 1), datetime(2024, 7, 1, 8))
    build_warehouse(spark, sources(spark), root, *RUN)

    def versions():
        rows = tables.read_table(spark, root, "customer_dim").collect()
        return sorted((r.customer_id, r.record_version, r.customer_name, r.is_current) for r in rows)

    wanted = [(1, 1, "Ann", False), (1, 2, "Anna", True), (2, 1, "Bob", True)]
    for _ in range(2):
        build_warehouse(spark, sources(spark, customers=renamed), root, *later)
        assert versions() == wanted
    build_warehouse(spark, sources(spark), root, *later)
    assert versions() == [(1, 1, "Ann", True), (2, 1, "Bob", True)]
    with pytest.raises(ValueError):
        build_warehouse(spark, sources(spark, customers=renamed), root, date(2024, 6, 15), RUN[1])
        build_warehouse(spark, sources(spark), root, date(2024, 6, 1), RUN[1])


def test_session_views(spark, built):
    views.register_views(exact_fact(built[1].tables["supply_chain_fact"]))
    months = spark.sql("SELECT * FROM monthly_supply_chain_performance ORDER BY order_month")
    assert [r.total_orders for r in months.collect()] == [2, 1]
    assert spark.table("supplier_performance_trends").count() == 2


class _Reader:
    """Stands in for ``spark.read``: keeps the options and answers with a given frame."""

    def __init__(self, rows, bounds, seen, options=()):
        self.rows, self.bounds, self.seen, self.set = rows, bounds, seen, dict(options)

    def format(self, name):
        return self.option("format", name)

    def option(self, key, value):
        return self.options(**{key: value})

    def options(self, **options):
        return _Reader(self.rows, self.bounds, self.seen, {**self.set, **options})

    def load(self):
        self.seen.append(self.set)
        return self.bounds if "query" in self.set else self.rows


def test_jdbc_scan_is_divided_by_the_key(spark):
    """The options only: no database is started for the tests."""
    seen = []
    rows = spark.range(5, 50).toDF("order_id")

    class Session:
        read = _Reader(rows, spark.createDataFrame([(5, 49)], "low int, high int"), seen)

    given = {"url": "jdbc:x", "driver": "d"}
    assert jdbc.read_jdbc(Session, given, "Orders", "order_id").count() == 45
    common = {"format": "jdbc", "fetchsize": "10000", **given}
    bounds = "SELECT MIN(order_id) AS low, MAX(order_id) AS high FROM Orders"
    assert seen[0] == {**common, "query": bounds}
    assert seen[1] == {
        **common,
        "dbtable": "Orders",
        "partitionColumn": "order_id",
        "lowerBound": "5",
        "upperBound": "49",
        "numPartitions": "8",
    }
    jdbc.read_jdbc(Session, given, "Orders")
    assert seen[2] == {**common, "dbtable": "Orders"}


def test_jdbc_sources_are_copied_once(spark, monkeypatch):
    given = sources(spark)
    asked = []

    def scan(session, options, table, column, partitions):
        asked.append(table)
        (name,) = [n for n, (t, _) in jdbc.SOURCE_TABLES.items() if t == table]
        frame = given[name].drop("line_number") if name == "order_items" else given[name]
        return frame.toDF(*[c.upper() for c in frame.columns])

    monkeypatch.setattr(jdbc, "read_jdbc", scan)
    copied = jdbc.jdbc_sources(spark, {"url": "jdbc:x"})
    assert {n: r for n, r in copied.rows(*copied).items()} == given.rows(*given)
    assert plain_fact(copied).count() == 3
    assert len(asked) == 9
