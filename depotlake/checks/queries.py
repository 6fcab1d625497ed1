"""Named queries: each runs one operator of the library over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlake.operators import fact, history, kpis, marts, quality, running, skew
from depotlake.operators.staging import scratch_folder, stage
from depotlake.plans import reports, views, warehouse
from depotlake.plans.dimensions import next_dimension
from depotlake.plans.published import NextRun
from depotlake.plans.tables import read_table
from depotlake.schemas import FOREIGN_KEYS, PRIMARY_KEYS
from depotlake.sources import Sources, retail_sources, source_counts, with_defaults

Query = Callable[[SparkSession, str], DataFrame]

REPORT_YEAR, REPORT_MONTH = 1998, 1
FIRST_LOAD = (date(2024, 1, 1), datetime(2024, 1, 1, 6, 0))
SECOND_LOAD = (date(2024, 3, 1), datetime(2024, 3, 1, 6, 0))
LOOK_UP_DAY = date(2024, 2, 1)
# The second run of a published fact begins in the month of LATER; the first saw no day from LATEST on.
LATER, LATEST = date(1997, 3, 14), date(1998, 5, 1)

# Sends whole tables the way of skewed data: a key with a few rows is spread already, ranges are
# short, and nothing is broadcast.
SPREAD = skew.SkewPolicy(key_rows=4, task_rows=2_000, broadcast_bytes=0)

LINE = ["order_key", "product_key", "line_number", "order_quantity", "unit_price"]


def shown(df: DataFrame) -> DataFrame:
    """Plain column types that any engine compares alike: decimals as doubles, times as text."""

    def plain(field: T.StructField) -> str:
        name = field.name
        if isinstance(field.dataType, T.DecimalType):
            return f"CAST({name} AS double) AS {name}"
        if isinstance(field.dataType, (T.DateType, T.TimestampType)):
            return f"CAST({name} AS string) AS {name}"
        return name

    return df.selectExpr(*[plain(f) for f in df.schema.fields])


def _on_sources(make: Callable[[Sources], DataFrame]) -> Query:
    return lambda spark, folder: shown(make(retail_sources(spark, folder)))


def _on_base(make: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_sources(lambda s: make(warehouse.base_lines(s)))


def _on_fact(make: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_sources(lambda s: make(warehouse.plain_fact(s)))


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------- sources, joins


def _supplier_defaults(s: Sources) -> DataFrame:
    gaps = s["suppliers"].selectExpr(
        "supplier_id",
        "supplier_name",
        "IF(supplier_id % 3 = 0, NULL, 'INACTIVE') AS supplier_status",
        "IF(supplier_id % 4 = 0, NULL, supplier_rating) AS supplier_rating",
    )
    return with_defaults(gaps, "suppliers")


def _warehouse_defaults(s: Sources) -> DataFrame:
    gaps = s["warehouses"].selectExpr(
        "warehouse_id",
        "IF(warehouse_id % 2 = 0, NULL, true) AS climate_controlled",
        "IF(warehouse_id % 3 = 0, NULL, date'2020-05-01') AS effective_start_date",
        "CAST(NULL AS date) AS effective_end_date",
        "IF(warehouse_id % 4 = 0, NULL, false) AS is_current",
        "IF(warehouse_id % 5 = 0, NULL, 7) AS record_version",
    )
    return with_defaults(gaps, "warehouses")


def _shipment_defaults(s: Sources) -> DataFrame:
    gaps = s["shipments"].selectExpr(
        "shipment_id", "IF(shipment_id % 5 = 0, NULL, is_late) AS is_late"
    )
    return with_defaults(gaps, "shipments")


def _inventory_defaults(s: Sources) -> DataFrame:
    """Defaults as they stand for gaps from the moment a source is loaded."""
    gaps = s["inventory"].selectExpr(
        "*",
        "IF(product_id % 3 = 0, NULL, date'2020-05-01') AS effective_start_date",
        "CAST(NULL AS date) AS effective_end_date",
        "IF(product_id % 4 = 0, NULL, false) AS is_current",
        "IF(warehouse_id % 5 = 0, NULL, 7) AS record_version",
        "IF(warehouse_id % 2 = 0, NULL, timestamp'2020-05-01 12:00:00') AS created_timestamp",
        "CAST(NULL AS timestamp) AS updated_timestamp",
    )
    loaded = Sources({**s, "inventory": gaps}, load_time=FIRST_LOAD[1])
    return loaded["inventory"].select(
        "inventory_id",
        "effective_start_date",
        "effective_end_date",
        "is_current",
        "record_version",
        "created_timestamp",
        "updated_timestamp",
    )


def _join_items(s: Sources) -> DataFrame:
    return fact.items_with_orders(s).select(
        "order_id", "customer_id", "order_date", "product_id", "line_number", "quantity", "price"
    )


def _join_products(s: Sources) -> DataFrame:
    return fact.items_with_products(s).select(
        "order_id", "line_number", "quantity", "product_id", "product_name", "supplier_id"
    )


def _join_inventory(s: Sources) -> DataFrame:
    return fact.order_lines(s).select(
        "order_id",
        "product_id",
        "line_number",
        "quantity",
        "price",
        "warehouse_key",
        "inventory_id",
        "current_stock",
        "stock_status",
    )


SOURCE_QUERIES: dict[str, Query] = {
    "source_counts": _on_sources(source_counts),
    "source_defaults": _on_sources(_supplier_defaults),
    "source_defaults_warehouses": _on_sources(_warehouse_defaults),
    "source_defaults_shipments": _on_sources(_shipment_defaults),
    "source_defaults_inventory": _on_sources(_inventory_defaults),
    "join_customers": _on_sources(
        lambda s: fact.orders_with_customers(s).select(
            "order_id", "order_date", "customer_id", "customer_name"
        )
    ),
    "join_items": _on_sources(_join_items),
    "join_products": _on_sources(_join_products),
    "join_categories": _on_sources(fact.products_with_categories),
    "join_suppliers": _on_sources(fact.products_with_suppliers),
    "join_shipments": _on_sources(fact.orders_with_shipments),
    "join_warehouses": _on_sources(fact.shipments_with_warehouses),
    "join_inventory": _on_sources(_join_inventory),
}

# ------------------------------------------------------------ projections

PROJECTION_QUERIES: dict[str, Query] = {
    "fact_base": _on_base(lambda b: b),
    "fact_base_spread": _on_sources(lambda s: warehouse.base_lines(s, SPREAD)),
    "supply_chain_risk": _on_base(
        lambda b: fact.with_risk_score(b).select(
            *LINE, "stock_out_risk_score", "is_late_delivery", "supply_chain_risk_score"
        )
    ),
    "turnover_category": _on_base(
        lambda b: fact.with_turnover_category(b).select(
            *LINE, "movement_velocity", "inventory_turnover_category"
        )
    ),
    "landed_cost": _on_base(
        lambda b: fact.with_landed_cost(b).select(
            *LINE, "order_value", "shipping_cost", "total_supply_chain_cost"
        )
    ),
    "order_calendar": _on_base(
        lambda b: fact.with_calendar(b).select(
            *LINE, "order_date", "order_year", "order_month", "order_day"
        )
    ),
}

# ---------------------------------------------------------------- quality

# Damage done to the good lines, so that the checks have something to find.
DAMAGE: dict[str, str] = {
    "customer_key": "IF(order_key % 13 = 0, NULL, customer_key)",
    "order_date": "IF(order_key % 37 = 0, NULL, order_date)",
    "order_quantity": (
        "CASE WHEN line_number = 7 THEN 0 WHEN line_number = 6 AND order_key % 5 = 0 THEN NULL"
        " WHEN line_number = 5 AND order_key % 5 = 1 THEN -order_quantity"
        " ELSE order_quantity END"
    ),
    "unit_price": "IF(product_key % 41 = 0, CAST(0 AS DECIMAL(10,2)), unit_price)",
    "delivery_time_days": "IF(order_key % 17 = 0, NULL, delivery_time_days)",
    "shipping_cost": "IF(order_key % 19 = 0, NULL, shipping_cost)",
    "current_stock_level": "IF(order_key % 23 = 0, NULL, current_stock_level)",
    "stock_out_risk_score": (
        "CASE WHEN order_key % 7 = 0 THEN NULL WHEN order_key % 7 = 1 THEN -stock_out_risk_score"
        " ELSE stock_out_risk_score END"
    ),
    "delivery_performance_score": (
        "IF(order_key % 29 = 0, NULL, delivery_performance_score)"
    ),
    "quality_rating": "IF(order_key % 31 = 0, NULL, quality_rating)",
}


def damaged_lines(base: DataFrame) -> DataFrame:
    damaged = base.select(
        *[F.expr(DAMAGE[c]).alias(c) if c in DAMAGE else F.col(c) for c in base.columns]
    )
    return damaged.withColumn("order_value", F.expr("order_quantity * unit_price"))


MEASURES = list(quality.FILL_VALUES)


def _key_violations(s: Sources) -> DataFrame:
    checked = {**PRIMARY_KEYS, "order_items": ["order_id", "line_number"]}
    return _union(quality.key_violations(s[n], n, keys) for n, keys in checked.items())


def _orphans(s: Sources) -> DataFrame:
    lost = s.replace(
        shipments=s["shipments"].withColumn("warehouse_id", F.expr("int(order_id % 27)")),
        order_items=s["order_items"].withColumn(
            "product_id",
            F.expr("IF(line_number = 5 AND order_id % 9 = 0, -1 - product_id, product_id)"),
        ),
    )
    return _union(
        quality.orphan_keys(lost[c], column, lost[p], key, f"{c}.{column}")
        for c, column, p, key in FOREIGN_KEYS
    )


# Tighter than the declared lengths, which the given names all keep.
TIGHT_LIMITS: dict[str, dict[str, int]] = {
    "products": {"product_name": 9},
    "warehouses": {"warehouse_name": 8, "warehouse_type": 11, "region": 6, "city": 8},
    "inventory": {"stock_status": 7, "movement_velocity": 5},
}


def _length_violations(s: Sources) -> DataFrame:
    found = (
        quality.length_violations(s[name], name, limits) for name, limits in TIGHT_LIMITS.items()
    )
    return _counted(found)


def _counted(found) -> DataFrame:
    return _union(found).groupBy("source_name", "column_name", "value", "max_length").agg(
        F.count(F.lit(1)).alias("row_count")
    )


# Names of any length up to a little over the declared ones.
LONG_NAMES: dict[str, dict[str, str]] = {
    "suppliers": {
        "supplier_name": "repeat('S', int(95 + supplier_id % 10))",
        "supplier_email": "repeat('e', int(97 + supplier_id % 7))",
        "contact_person": "repeat('c', int(99 + supplier_id % 3))",
        "phone": "repeat('1', int(18 + supplier_id % 5))",
    },
    "warehouses": {
        "state": "repeat('s', int(49 + warehouse_id % 3))",
        "country": "repeat('c', int(48 + warehouse_id % 4))",
        "manager_name": "repeat('m', int(98 + warehouse_id % 5))",
        "phone": "repeat('1', int(19 + warehouse_id % 3))",
        "email": "repeat('e', int(99 + warehouse_id % 4))",
        "automation_level": "repeat('a', int(17 + warehouse_id % 6))",
    },
    "shipments": {
        "shipment_status": "repeat('s', int(18 + order_id % 4))",
        "tracking_number": "repeat('t', int(47 + order_id % 6))",
        "carrier_name": "repeat('c', int(98 + order_id % 5))",
        "delay_reason": "repeat('d', int(196 + order_id % 7))",
    },
}


def _declared_lengths(s: Sources) -> DataFrame:
    named = s.replace(
        **{
            name: s[name].withColumns({c: F.expr(sql) for c, sql in made.items()})
            for name, made in LONG_NAMES.items()
        }
    )
    return _counted([warehouse.source_checks(named)["length_violations"]])


QUALITY_QUERIES: dict[str, Query] = {
    "dq_null_profile": _on_base(lambda b: quality.null_profile(damaged_lines(b))),
    "dq_valid_lines": _on_base(
        lambda b: quality.valid_lines(damaged_lines(b)).select(*LINE, "order_value")
    ),
    "dq_fill_defaults": _on_base(
        lambda b: quality.fill_defaults(damaged_lines(b)).select(*LINE, *MEASURES)
    ),
    "dq_clamp_scores": _on_base(
        lambda b: quality.clamp_scores(damaged_lines(b)).select(*LINE, *quality.UNIT_SCORES)
    ),
    "fact_clean": _on_base(
        lambda b: damaged_lines(b)
        .transform(fact.with_derived)
        .transform(quality.clean_fact)
        .select(
            *LINE,
            "order_value",
            *MEASURES,
            "supply_chain_risk_score",
            "inventory_turnover_category",
            "total_supply_chain_cost",
            "order_year",
            "order_month",
            "order_day",
        )
    ),
    "dq_pk_violations": _on_sources(_key_violations),
    "dq_fk_orphans": _on_sources(_orphans),
    "dq_length_violations": _on_sources(_length_violations),
    "dq_declared_lengths": _on_sources(_declared_lengths),
}

# ---------------------------------------------------------------- windows


def _history(
    key: str, needs: str | None = None, policy: skew.SkewPolicy = warehouse.POLICY, **outputs
) -> Query:
    followed = running.History(key, **outputs)
    shown = dict.fromkeys([*LINE, key, "order_date", *([needs] if needs else [])])
    named = [n for n in (followed.sequence, followed.rank) if n]
    named += [*followed.sums, *followed.means, *followed.shares]
    needed = [*shown, "shipment_id", "inventory_id"]
    return _on_sources(
        lambda s: warehouse.lines_with_histories(s, followed, policy=policy, needed=needed).select(
            *shown, *named
        )
    )


def fanned_out(s: Sources) -> Sources:
    """A third of the orders shipped twice, a quarter of the items stocked twice in a place."""
    again = s["shipments"].filter("order_id % 3 = 0")
    second = again.withColumns(
        {
            "shipment_id": F.expr("shipment_id + 1000000000"),
            "delivery_time_days": F.expr("delivery_time_days + 1"),
        }
    )
    stock = s["inventory"].filter("product_id % 4 = 0")
    other = stock.withColumns(
        {
            "inventory_id": F.expr("inventory_id + 1000000000"),
            "current_stock": F.expr("current_stock + 1"),
        }
    )
    return s.replace(
        shipments=s["shipments"].unionByName(second), inventory=s["inventory"].unionByName(other)
    )


def with_copies(s: Sources) -> Sources:
    """Each item of some orders forty times over."""
    times = F.expr("IF(order_id % 50 = 0, 40, 1)")
    copied = s["order_items"].withColumn("__n", F.explode(F.sequence(F.lit(1), times)))
    return s.replace(order_items=copied.drop("__n"))


def _published_fact(s: Sources) -> DataFrame:
    """A first run lacks later months and some orders of an old one; a second goes on from there."""
    spark = s["orders"].sparkSession
    root = scratch_folder(spark, "published")
    early = f"order_date < date'{LATER}'"
    known = s["orders"].filter(f"{early} OR order_date < date'{LATEST}' AND order_id % 5 <> 0")
    warehouse.build_warehouse(spark, s.replace(orders=known), root, *FIRST_LOAD)
    warehouse.build_warehouse(spark, s, root, *SECOND_LOAD, since=LATER)
    return read_table(spark, root, "supply_chain_fact")


WINDOW_QUERIES: dict[str, Query] = {
    "win_customer_sequence": _history(
        "customer_key", sequence="customer_order_sequence"
    ),
    "win_customer_rank": _history(
        "customer_key", rank="customer_total_orders"
    ),
    "win_customer_running_value": _history(
        "customer_key",
        "order_value",
        sums={"customer_cumulative_value": "order_value"},
    ),
    "win_supplier_sequence": _history(
        "supplier_key", sequence="supplier_order_sequence"
    ),
    "win_supplier_running_delivery": _history(
        "supplier_key",
        "delivery_time_days",
        means={"supplier_avg_delivery_time": "delivery_time_days"},
    ),
    "win_supplier_running_late_rate": _history(
        "supplier_key",
        "is_late_delivery",
        shares={"supplier_late_delivery_rate": "is_late_delivery"},
    ),
    "win_product_sequence": _history(
        "product_key", sequence="product_order_sequence"
    ),
    "win_product_running_demand": _history(
        "product_key",
        "order_quantity",
        sums={"product_demand_trend": "order_quantity"},
    ),
    "fact_enhanced": _on_sources(warehouse.enhanced_fact),
    "fact_enhanced_spread": _on_sources(lambda s: warehouse.enhanced_fact(s, SPREAD)),
    "fact_full": _on_sources(warehouse.full_fact),
    "fact_published": _on_sources(_published_fact),
    "fact_fanout": _on_sources(lambda s: warehouse.enhanced_fact(fanned_out(s), SPREAD)),
    "fact_copies": _on_sources(lambda s: warehouse.enhanced_fact(with_copies(s), SPREAD)),
}

# ------------------------------------------------------------- marts, KPIs

TEAM = ["supplier_key", "supplier_name", "warehouse_region", "order_year", "order_month"]
STORE = [
    "product_key",
    "product_name",
    "category_name",
    "warehouse_key",
    "warehouse_name",
    "order_year",
    "order_month",
]
FINANCE = ["supplier_key", "supplier_name", "category_name", "order_year", "order_month"]


def _mart_columns(mart: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return _on_fact(lambda f: mart(f).select(*columns))


def _table_counts(s: Sources) -> DataFrame:
    lines = stage(warehouse.plain_fact(s), "plain_fact")
    made: Mapping[str, DataFrame] = {
        **{f"{n}_dim": d for n, d in warehouse.dimensions(s, *FIRST_LOAD).items()},
        **warehouse.business_marts(lines),
        **warehouse.indicators(lines),
    }
    return kpis.table_counts({"supply_chain_fact": lines, **made})


MART_QUERIES: dict[str, Query] = {
    "mart_supply_chain_team": _on_fact(marts.supply_chain_team_mart),
    "mart_store_manager": _on_fact(marts.store_manager_mart),
    "mart_finance_team": _on_fact(marts.finance_team_mart),
    "supplier_scorecard": _on_fact(kpis.supplier_scorecard),
    "inventory_turnover": _on_fact(kpis.inventory_turnover),
    "perfect_order_rate": _on_fact(kpis.perfect_order_rate),
    "run_summary": _on_fact(kpis.run_summary),
    "table_counts": _on_sources(_table_counts),
    "band_performance": _mart_columns(
        marts.supply_chain_team_mart, *TEAM, "avg_delivery_performance", "performance_category"
    ),
    "band_stock_health": _mart_columns(
        marts.store_manager_mart, *STORE, "avg_stock_out_risk", "stock_health_status"
    ),
    "band_velocity": _mart_columns(
        marts.store_manager_mart, *STORE, "total_demand", "product_velocity_classification"
    ),
    "band_spend_tier": _mart_columns(
        marts.finance_team_mart, *FINANCE, "total_purchase_value", "supplier_spend_tier"
    ),
    "band_supplier_grade": _on_fact(
        lambda f: kpis.supplier_scorecard(f).select(
            "supplier_key", "overall_supplier_score", reports.supplier_grade()
        )
    ),
    "cost_efficiency": _mart_columns(
        marts.finance_team_mart,
        *FINANCE,
        "total_purchase_value",
        "total_supply_chain_cost",
        "cost_efficiency_ratio",
    ),
}

# ---------------------------------------------------------- reports, views

REPORT_QUERIES: dict[str, Query] = {
    "report_delivery_by_supplier": _on_fact(
        lambda f: reports.delivery_by_supplier(marts.supply_chain_team_mart(f), REPORT_YEAR)
    ),
    "report_inventory_movement": _on_fact(
        lambda f: reports.inventory_movement(marts.store_manager_mart(f), REPORT_YEAR)
    ),
    "report_supplier_payment": _on_fact(
        lambda f: reports.supplier_payment(marts.finance_team_mart(f), REPORT_YEAR)
    ),
    "report_scorecard_raw": _on_fact(
        lambda f: reports.scorecard_raw(kpis.supplier_scorecard(f))
    ),
    "report_high_risk_raw": _on_fact(reports.high_risk_raw),
    "report_supplier_performance": _on_fact(
        lambda f: reports.supplier_performance(
            marts.supply_chain_team_mart(f), REPORT_YEAR, REPORT_MONTH
        )
    ),
    "report_stock_health": _on_fact(
        lambda f: reports.stock_health(marts.store_manager_mart(f), REPORT_YEAR, REPORT_MONTH)
    ),
    "report_supplier_spend": _on_fact(
        lambda f: reports.supplier_spend(marts.finance_team_mart(f), REPORT_YEAR, REPORT_MONTH)
    ),
    "report_scorecard": _on_fact(
        lambda f: reports.scorecard_graded(kpis.supplier_scorecard(f))
    ),
    "report_high_risk": _on_fact(reports.high_risk),
    "report_monthly_trend": _on_fact(views.monthly_trend),
    "view_monthly_performance": _on_fact(views.monthly_performance),
    "view_supplier_trends": _on_fact(views.supplier_trends),
}

# ------------------------------------------------------------- dimensions


def _initial(name: str) -> Query:
    def make(s: Sources) -> DataFrame:
        d = history.DIMENSIONS[name]
        return history.initial_load(s[d.source], d.keys, d.tracked, *FIRST_LOAD)

    return _on_sources(make)


def later_customers(customers: DataFrame) -> DataFrame:
    """A second snapshot: renamed, cleared, vanished and additional customers."""
    changed = customers.filter("customer_id % 17 <> 5").selectExpr(
        "customer_id",
        "IF(customer_id % 10 = 3, concat(customer_name, ' Ltd'), customer_name) AS customer_name",
        "IF(customer_id % 23 = 4, NULL, customer_email) AS customer_email",
    )
    added = customers.filter("customer_id % 50 = 7").selectExpr(
        "customer_id + 1000000000 AS customer_id", "customer_name", "customer_email"
    )
    return changed.unionByName(added)


def _merged_customers(s: Sources) -> DataFrame:
    d = history.DIMENSIONS["customer"]
    first = history.initial_load(s["customers"], d.keys, d.tracked, *FIRST_LOAD)
    return history.merge_snapshot(
        first, later_customers(s["customers"]), d.keys, d.tracked, *SECOND_LOAD
    )


def _published_customers(s: Sources) -> DataFrame:
    """Both snapshots as published runs, the second written by its changes only."""
    spark = s["customers"].sparkSession
    root = scratch_folder(spark, "published")
    snapshots = (s["customers"], later_customers(s["customers"]))
    for (day, now), snapshot in zip((FIRST_LOAD, SECOND_LOAD), snapshots):
        run = NextRun(spark, root, day, warehouse.FOLDERS)
        next_dimension(run, history.DIMENSIONS["customer"], snapshot, now)
        run.publish()
    return read_table(spark, root, "customer_dim")


DIMENSION_QUERIES: dict[str, Query] = {
    "scd2_initial_customer": _initial("customer"),
    "scd2_initial_supplier": _initial("supplier"),
    "scd2_initial_warehouse": _initial("warehouse"),
    "scd2_merge": _on_sources(_merged_customers),
    "scd2_published": _on_sources(_published_customers),
    "scd2_as_of": _on_sources(lambda s: history.as_of(_merged_customers(s), LOOK_UP_DAY)),
    "scd2_current": _on_sources(lambda s: history.current_rows(_merged_customers(s))),
}

QUERIES: dict[str, Query] = {
    **SOURCE_QUERIES,
    **PROJECTION_QUERIES,
    **QUALITY_QUERIES,
    **WINDOW_QUERIES,
    **MART_QUERIES,
    **REPORT_QUERIES,
    **DIMENSION_QUERIES,
}
