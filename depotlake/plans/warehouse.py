"""Building the warehouse: sources to fact, dimensions, marts and indicators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlake.operators.fact import fact_base, order_lines, with_derived
from depotlake.operators.history import DIMENSIONS, initial_load
from depotlake.operators.kpis import (
    inventory_turnover,
    perfect_order_rate,
    run_summary,
    summary_measures,
    supplier_scorecard,
    table_counts,
)
from depotlake.operators.marts import finance_team_mart, store_manager_mart, supply_chain_team_mart
from depotlake.operators.quality import (
    CRITICAL_COLUMNS,
    clean_fact,
    key_violations,
    length_violations,
    null_counts,
    orphan_keys,
)
from depotlake.operators.running import (
    HISTORIES,
    LINE_ID,
    History,
    carried_totals,
    stored_lines,
    totals_by_month,
    with_histories,
)
from depotlake.operators.skew import SkewPolicy
from depotlake.plans.dimensions import next_dimension
from depotlake.plans.published import NextRun, Published, period_folders
from depotlake.plans.tables import PARTITIONED_BY, check_periods, read_table, show_publication
from depotlake.plans.views import create_views
from depotlake.schemas import (
    FOREIGN_KEYS,
    LENGTH_LIMITS,
    PRIMARY_KEYS,
    TABLE_FOLDERS,
    TABLES,
    columns,
    exact_fact,
    to_table,
)
from depotlake.sources.registry import Sources

POLICY = SkewPolicy()


def base_lines(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    return order_lines(sources, policy).transform(fact_base)


def plain_fact(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    """The clean fact without the running columns; one lazy plan, nothing is written."""
    return base_lines(sources, policy).transform(with_derived).transform(clean_fact)


def lines_with_histories(
    sources: Sources,
    *histories: History,
    policy: SkewPolicy = POLICY,
    needed: Sequence[str] = ("*",),
) -> DataFrame:
    """The joined lines, cut to the ``needed`` columns, with their histories.

    The lines are written to the staging folder at once: the joins run once, the histories read
    the files.
    """
    lines = stored_lines(base_lines(sources, policy).select(*needed))
    return with_histories(lines, *histories, policy=policy).drop(LINE_ID)


def enhanced_fact(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    """The fact with all 44 columns before cleaning, in contract order, types still exact."""
    return _with_all_columns(stored_lines(base_lines(sources, policy)), policy)


def _with_all_columns(
    lines: DataFrame, policy: SkewPolicy, carried: DataFrame | None = None
) -> DataFrame:
    followed = with_histories(lines, *HISTORIES, policy=policy, carried=carried)
    names = [name for name, _ in columns(TABLES["supply_chain_fact"])]
    return followed.transform(with_derived).select(*names)


def full_fact(sources: Sources, policy: SkewPolicy = POLICY) -> DataFrame:
    return enhanced_fact(sources, policy).transform(clean_fact)


def business_marts(fact: DataFrame) -> dict[str, DataFrame]:
    return {
        "supply_chain_team_metrics": supply_chain_team_mart(fact),
        "store_manager_metrics": store_manager_mart(fact),
        "finance_team_metrics": finance_team_mart(fact),
    }


def indicators(fact: DataFrame) -> dict[str, DataFrame]:
    return {
        "perfect_order_rate": perfect_order_rate(fact),
        "inventory_turnover": inventory_turnover(fact),
        "supplier_scorecard": supplier_scorecard(fact),
    }


def dimensions(
    sources: Sources, run_date: date, run_time: datetime
) -> dict[str, DataFrame]:
    return {
        name: initial_load(sources[d.source], d.keys, d.tracked, run_date, run_time)
        for name, d in DIMENSIONS.items()
    }


def source_checks(sources: Sources) -> dict[str, DataFrame]:
    """Rows that break the declared keys, references and lengths of the sources."""
    checked = [
        (name, {c: n for c, n in limits.items() if c in sources[name].columns})
        for name, limits in LENGTH_LIMITS.items()
    ]
    return {
        "key_violations": reduce(
            DataFrame.unionByName,
            [key_violations(sources[n], n, keys) for n, keys in PRIMARY_KEYS.items()],
        ),
        "orphan_keys": reduce(
            DataFrame.unionByName,
            [
                orphan_keys(sources[c], column, sources[p], key, f"{c}.{column}")
                for c, column, p, key in FOREIGN_KEYS
            ],
        ),
        "length_violations": reduce(
            DataFrame.unionByName,
            [length_violations(sources[name], name, limits) for name, limits in checked if limits],
        ),
    }


#: What each key of each history has added up in each month, so that a later run can go on from there.
STATE = "history_totals"
STATE_KEYS = ["order_year", "order_month"]
STATE_COLUMNS = (
    "__history string, __key bigint, __lines bigint, __sum_order_value decimal(31,2),"
    " __sum_delivery_time_days bigint, __sum_order_quantity bigint, __num_delivery_time_days bigint,"
    " __hit_is_late_delivery bigint, order_year int, order_month int"
)
#: Folders of everything a publication has.
FOLDERS = {**TABLE_FOLDERS, STATE: STATE}


@dataclass(frozen=True)
class Warehouse:
    """The published tables, and the indicators that are computed from them on demand.

    Where the run wrote all lines, ``summary`` and the null profile were measured while it wrote.
    """

    tables: dict[str, DataFrame]
    perfect_order_rate: DataFrame
    inventory_turnover: DataFrame
    summary: DataFrame
    counts: DataFrame
    quality: dict[str, DataFrame]
    published: Published

    @property
    def fact(self) -> DataFrame:
        """The fact with its exact types, as the reports and views expect it."""
        return exact_fact(self.tables["supply_chain_fact"])


def build_warehouse(
    spark: SparkSession,
    sources: Sources,
    root: str,
    run_date: date,
    run_time: datetime,
    database: str | None = None,
    policy: SkewPolicy = POLICY,
    since: date | None = None,
) -> Warehouse:
    """Write the eight tables under ``root`` and publish them together (see ``published``).

    Readers see the last publication until all tables of this one are there; a build that fails
    leaves it as it was. The fact is computed once. Marts and indicators read the columns they need
    back from it. Dimensions take in the sources as their next snapshot and write the changes only; a
    second run on a day replaces the first, and a day before the last run is an error. With a
    database, its tables and both views show the new publication afterwards. ``quality`` has the null
    profile of the lines, and what breaks the declared keys, references and lengths.

    ``since`` says that orders changed from that day on only. Then the lines of its month and all
    later ones are computed, going on from what each key had reached before; earlier months stay as
    they are published, with the names and stock levels of their time.
    """
    run = NextRun(spark, root, run_date, FOLDERS)
    if STATE not in run.before.folders:
        since = None
    missing, summary = Observation(), Observation()
    carried = None
    if since is not None:
        first = since.replace(day=1)
        sources = sources.replace(orders=sources["orders"].filter(F.col("order_date") >= F.lit(first)))
        for name in ("supply_chain_fact", STATE):
            run.keep(name, period_folders(run.before.folders[name], first))
        carried = carried_totals(_read_state(run), first)

    base = base_lines(sources, policy)
    lines = stored_lines(base.observe(missing, *null_counts()))
    clean = _with_all_columns(lines, policy, carried).transform(clean_fact)
    keys = PARTITIONED_BY["supply_chain_fact"]
    # few files for each period, none too large; measured after the shuffle, where no task counts twice
    rows = clean.hint("rebalance", *keys).observe(summary, *summary_measures())
    run.write(to_table(rows, "supply_chain_fact"), "supply_chain_fact", keys)
    run.write(totals_by_month(lines, *HISTORIES).hint("rebalance", *STATE_KEYS), STATE, STATE_KEYS)

    for d in DIMENSIONS.values():
        next_dimension(run, d, sources[d.source], run_time)
    fact = exact_fact(_in_order(run.read("supply_chain_fact", _schema("supply_chain_fact")), "supply_chain_fact"))
    changed = fact
    if since is not None:  # whole years, as the marts are kept by year
        changed = fact.filter(F.col("order_year") >= since.year)
    for table, mart in business_marts(changed).items():
        if since is not None:
            run.keep(table, period_folders(run.before.folders[table], since.replace(month=1, day=1)))
        keys = PARTITIONED_BY[table]
        run.write(to_table(mart, table).hint("rebalance", *keys), table, keys)
    run.write(to_table(supplier_scorecard(fact), "supplier_scorecard"), "supplier_scorecard")
    published = run.publish()

    if database is not None:
        show_publication(spark, root, database)
        create_views(spark, database)
    tables = {table: read_table(spark, root, table, published) for table in TABLES}
    fact = exact_fact(tables["supply_chain_fact"])
    measured = run_summary(fact)
    if since is None:
        measured = spark.createDataFrame([tuple(summary.get[c] for c in measured.columns)], measured.schema)
    counts = [(name, missing.get[name]) for name in CRITICAL_COLUMNS]
    return Warehouse(
        tables=tables,
        perfect_order_rate=perfect_order_rate(fact),
        inventory_turnover=inventory_turnover(fact),
        summary=measured,
        counts=table_counts(tables),
        quality={
            "null_profile": spark.createDataFrame(counts, "column_name string, null_count bigint"),
            **source_checks(sources),
        },
        published=published,
    )


def _schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def _in_order(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[name for name, _ in columns(TABLES[table])])


def _read_state(run: NextRun) -> DataFrame:
    """The totals by month that the run goes on from."""
    return run.read(STATE, T.StructType.fromDDL(STATE_COLUMNS)).drop("run")


def replace_periods(
    spark: SparkSession, root: str, table: str, df: DataFrame, run_date: date, periods: Iterable[Sequence[int]] | None = None
) -> Published:
    """Publish a table with the periods that ``df`` has replaced; all else stays as published.

    With ``periods`` (values of the table's partition columns), rows of any other period are an
    error, and periods that ``df`` has no rows of become empty.
    """
    keys = PARTITIONED_BY[table]
    if periods is not None:
        check_periods(df, keys, periods)
    run = NextRun(spark, root, run_date, FOLDERS)
    written = run.write(to_table(df, table), table, keys)
    named = {"/".join(f"{key}={value}" for key, value in zip(keys, p)) for p in periods or ()}
    replaced = named | {folder.split("/", 1)[1] for folder in written}
    for name, folders in run.before.folders.items():
        run.keep(name, [f for f in folders if name != table or f.split("/", 1)[1] not in replaced])
    return run.publish()
