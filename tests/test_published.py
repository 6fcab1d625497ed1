"""Published runs: crashes after each step, old readers, months replaced, dimensions by their changes."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from retail import ROWS, sources

from depotlake.operators.history import DIMENSIONS, Dimension, initial_load, merge_snapshot
from depotlake.operators.kpis import run_summary
from depotlake.operators.quality import null_profile
from depotlake.operators.staging import located
from depotlake.plans import dimensions, published, tables, warehouse
from depotlake.plans.published import AlreadyPublished, NextRun, current, publications
from depotlake.plans.warehouse import build_warehouse
from depotlake.schemas import TABLES
from depotlake.sources import retail_sources

FOLDER = "/root/testdata/sf0.001"
FIRST = (date(2024, 6, 1), datetime(2024, 6, 1, 8))
SECOND = (date(2024, 6, 2), datetime(2024, 6, 2, 8))
THIRD = (date(2024, 6, 3), datetime(2024, 6, 3, 8))


def rows_of(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


def all_rows(spark, root, publication=None):
    return {t: rows_of(tables.read_table(spark, root, t, publication)) for t in TABLES}


def changed(spark):
    """A renamed customer, an order more in an old month."""
    return sources(
        spark,
        customers=[(1, "Anna", "ann@example.com"), (2, "Bob", "bob@example.com")],
        orders=[*ROWS["orders"], (13, 2, date(2024, 1, 20))],
        order_items=[*ROWS["order_items"], (13, 100, 7, ROWS["order_items"][0][3], 1)],
    )


class Stop(Exception):
    pass




def stopped_before(step):
    """``NextRun.write`` that fails at one of the writes."""
    count = 0

    def write(self, *args, whole=NextRun.write, **kwargs):
        nonlocal count
        count += 1
        if count > step:
            raise Stop
        return whole(self, *args, **kwargs)

    return write


def stop(self, *args):
    raise Stop


def half_a_pointer(self, publication):
    files, place = located(self.spark, f"{self.root}/{published.POINTERS}/{self.number:09d}.json")
    out = files.create(place, False)
    out.write(publication.to_json()[:-9].encode())
    out.close()
    raise Stop


def test_a_stopped_build_changes_nothing(spark, tmp_path, monkeypatch):
    """Before each of the eight writes, before the pointer, while it is written, and after it."""
    root = str(tmp_path)
    build_warehouse(spark, sources(spark), root, *FIRST)
    first = all_rows(spark, root)
    ways = [("write", stopped_before(step)) for step in range(8)] + [("_switch", stop), ("_switch", half_a_pointer)]
    for name, fails in ways:
        with monkeypatch.context() as patch, pytest.raises(Stop):
            patch.setattr(NextRun, name, fails)
            build_warehouse(spark, changed(spark), root, *SECOND)
        assert all_rows(spark, root) == first
    with monkeypatch.context() as patch, pytest.raises(Stop):
        patch.setattr(NextRun, "remove_old", stop)
        build_warehouse(spark, changed(spark), root, *SECOND)
    second = all_rows(spark, root)
    build_warehouse(spark, changed(spark), root, *SECOND)
    assert all_rows(spark, root) == second != first
    assert len(second["customer_dim"]) == 3, "the first run's version stays"
    used = {f.split("/")[0] for p in publications(spark, root) for f in p.folders["supply_chain_fact"]}
    assert {f.name for f in (tmp_path / "fact_table").iterdir()} == used and len(used) == 2


def test_readers_of_the_last_publication_can_end(spark, tmp_path):
    root = str(tmp_path)
    first = build_warehouse(spark, sources(spark), root, *FIRST)
    wanted = all_rows(spark, root)
    build_warehouse(spark, changed(spark), root, *SECOND)
    assert {t: rows_of(df) for t, df in first.tables.items()} == wanted
    build_warehouse(spark, changed(spark), root, *THIRD)
    assert [p.number for p in publications(spark, root)] == [3, 2]


def test_two_builds_at_once(spark, tmp_path):
    root = str(tmp_path)
    one, two = (NextRun(spark, root, FIRST[0], warehouse.FOLDERS) for _ in range(2))
    for run in (one, two):
        run.write(spark.createDataFrame([], TABLES["supplier_scorecard"]), "supplier_scorecard")
    one.publish()
    with pytest.raises(AlreadyPublished):
        two.publish()
    assert current(spark, root).folders == one.folders


def test_an_earlier_day_is_refused(spark, tmp_path):
    build_warehouse(spark, sources(spark), str(tmp_path), *SECOND)
    with pytest.raises(ValueError):
        build_warehouse(spark, sources(spark), str(tmp_path), *FIRST)


def test_measures_are_taken_while_writing(spark, tmp_path):
    built = build_warehouse(spark, retail_sources(spark, FOLDER), str(tmp_path), *FIRST)
    assert "Aggregate" not in built.summary._jdf.queryExecution().analyzed().toString()
    assert built.summary.collect() == run_summary(built.fact).collect()
    lines = warehouse.base_lines(retail_sources(spark, FOLDER))
    assert rows_of(built.quality["null_profile"]) == rows_of(null_profile(lines))


def test_no_orders(spark, tmp_path):
    built = build_warehouse(spark, sources(spark, orders=[]), str(tmp_path), *FIRST, database="depot_none")
    assert built.fact.count() == spark.table("depot_none.supply_chain_fact").count() == 0
    assert built.summary.first().total_records == 0
    assert spark.table("depot_none.customer_dim").count() == 2


# ------------------------------------------------------------- later months only


@pytest.mark.parametrize("since", [date(1997, 3, 14), date(1992, 1, 1)])
def test_a_run_for_later_months_equals_a_whole_one(spark, tmp_path, since):
    """Late lines in an old month, and all orders of the months from there on."""
    known = retail_sources(spark, FOLDER)
    early = F.col("order_date") < F.lit(since)
    on_time = known.replace(orders=known["orders"].filter(early & ~((F.col("order_id") % 5 == 0) & ~early)))
    part, whole = str(tmp_path / "part"), str(tmp_path / "whole")
    build_warehouse(spark, on_time, part, *FIRST)
    build_warehouse(spark, known, part, *SECOND, since=since)
    build_warehouse(spark, known, whole, *SECOND)
    found, wanted = all_rows(spark, part), all_rows(spark, whole)
    for table in set(TABLES) - {d.table for d in DIMENSIONS.values()}:
        assert found[table] == wanted[table], table
    assert sum(found["supply_chain_fact"].values()) > 1000
    kept = [f for f in current(spark, part).folders["supply_chain_fact"] if f.startswith("run=000001")]
    assert all(f < f"run=000001-~/order_year={since.year}" for f in kept) and bool(kept) == (since.year > 1992)


def test_several_runs_for_later_months(spark, tmp_path):
    """Each goes on from the totals that the run before has left."""
    known = retail_sources(spark, FOLDER)
    root, whole = str(tmp_path / "a"), str(tmp_path / "b")
    days = [date(1995, 5, 20), date(1998, 1, 1), date(2100, 1, 1)]
    build_warehouse(spark, known.replace(orders=known["orders"].filter(F.col("order_date") < F.lit(days[0]))), root, *FIRST)
    for n, (since, until) in enumerate(zip(days, days[1:])):
        seen = known.replace(orders=known["orders"].filter(F.col("order_date") < F.lit(until)))
        build_warehouse(spark, seen, root, FIRST[0] + timedelta(n + 1), FIRST[1], since=since)
    built = build_warehouse(spark, known, whole, *FIRST)
    assert rows_of(tables.read_table(spark, root, "supply_chain_fact")) == rows_of(built.tables["supply_chain_fact"])


def test_first_run_and_lines_without_a_date(spark, tmp_path):
    """A first run takes everything; lines without a date count before all others, also later."""
    orders = [(10, 1, None), *ROWS["orders"][1:]]
    root, whole = str(tmp_path / "a"), str(tmp_path / "b")
    build_warehouse(spark, sources(spark, orders=orders[:2]), root, *FIRST, since=date(2024, 2, 1))
    assert tables.read_table(spark, root, "supply_chain_fact").count() == 2
    build_warehouse(spark, sources(spark, orders=orders), root, *SECOND, since=date(2024, 1, 1), database="depot_nodate")
    build_warehouse(spark, sources(spark, orders=orders), whole, *SECOND)
    found, wanted = all_rows(spark, root), all_rows(spark, whole)
    assert found["supply_chain_fact"] == wanted["supply_chain_fact"]
    assert rows_of(spark.table("depot_nodate.supply_chain_fact")) == wanted["supply_chain_fact"]


# ------------------------------------------------------------------ months replaced


def test_replacing_a_month(spark, tmp_path):
    root = str(tmp_path)
    built = build_warehouse(spark, sources(spark), root, *FIRST, database="depot_month")
    fact = built.tables["supply_chain_fact"]
    february = fact.filter("order_month = 2")
    doubled = february.withColumn("order_quantity", F.col("order_quantity") * 2)
    warehouse.replace_periods(spark, root, "supply_chain_fact", doubled, SECOND[0], periods=[(2024, 2)])
    now = tables.read_table(spark, root, "supply_chain_fact")
    assert rows_of(now) == rows_of(fact.filter("order_month = 1").unionByName(doubled))
    assert all_rows(spark, root)["customer_dim"] == rows_of(built.tables["customer_dim"])
    with pytest.raises(ValueError):
        warehouse.replace_periods(spark, root, "supply_chain_fact", fact, THIRD[0], periods=[(2024, 2)])
    warehouse.replace_periods(spark, root, "supply_chain_fact", february.limit(0), THIRD[0], periods=[(2024, 2)])
    assert rows_of(tables.read_table(spark, root, "supply_chain_fact")) == rows_of(fact.filter("order_month = 1"))
    with pytest.raises(ValueError):  # what others may be reading
        tables.insert_overwrite(fact, "supply_chain_fact", "depot_month")


def test_inserting_a_month_leaves_the_others(spark, tmp_path):
    built = build_warehouse(spark, sources(spark), str(tmp_path / "built"), *FIRST)
    tables.declare_tables(spark, str(tmp_path / "own"), "depot_insert", ["supply_chain_fact", "finance_team_metrics"])
    fact = built.tables["supply_chain_fact"]
    tables.insert_overwrite(fact, "supply_chain_fact", "depot_insert")
    february = fact.filter("order_month = 2")
    with pytest.raises(ValueError):
        tables.insert_overwrite(fact, "supply_chain_fact", "depot_insert", periods=[(2024, 2)])
    for _ in range(2):
        doubled = february.unionByName(february)
        tables.insert_overwrite(doubled, "supply_chain_fact", "depot_insert", periods=[(2024, 2)])
    stored = spark.table("depot_insert.supply_chain_fact")
    assert rows_of(stored) == rows_of(fact.unionByName(february))


# ---------------------------------------------------------------------- dimensions

SMALL = Dimension("customer_dim", "customers", ("customer_id",), ("customer_name", "customer_email"))


def follow(spark, root, snapshots):
    """Versions after each snapshot, by changes and by merging whole tables."""
    whole = None
    for day, rows in snapshots:
        now = datetime(day.year, day.month, day.day, 6)
        snapshot = spark.createDataFrame(rows, "customer_id long, customer_name string, customer_email string")
        run = NextRun(spark, root, day, warehouse.FOLDERS)
        dimensions.next_dimension(run, SMALL, snapshot, now)
        run.publish()
        if whole is None:
            whole = initial_load(snapshot, SMALL.keys, SMALL.tracked, day, now)
        else:
            whole = merge_snapshot(whole, snapshot, SMALL.keys, SMALL.tracked, day, now)
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        # a merge that undoes an earlier one of the day cannot know when a row had been updated before
        found = tables.read_table(spark, root, "customer_dim")
        yield tuple(rows_of(df.drop("updated_timestamp")) for df in (found, whole))


@pytest.mark.parametrize("gather", [16, 3])
def test_changes_give_what_a_whole_merge_gives(spark, tmp_path, monkeypatch, gather):
    """Changed, new, vanished and returning rows, two rows of a key, nulls, days repeated."""
    monkeypatch.setattr(dimensions, "GATHER_FOLDERS", gather)
    pick = random.Random(gather)
    days = [date(2024, 1, 1) + timedelta(d) for d in (0, 3, 3, 4, 9, 9, 10, 12, 13)]

    def snapshot():
        return [(k if k < 9 else None, pick.choice("abc"), pick.choice(["x", None])) for k in range(10) for _ in range(pick.choice([0, 1, 1, 1, 2]))]

    for found, wanted in follow(spark, str(tmp_path), [(day, snapshot()) for day in days]):
        assert found == wanted
    view = dimensions.dimension_sql(f"{tmp_path}/customer_dimension", current(spark, str(tmp_path)).folders["customer_dim"], "customer_dim")
    assert rows_of(spark.sql(view).drop("updated_timestamp")) == found


def test_written_bytes_follow_the_changes(spark, tmp_path):
    """A run with 1 of 100 keys changed writes a hundredth; one without changes writes nothing."""
    def rows(renamed):
        return [(k, f"{'new' if k % 100 < renamed else 'old'} {k * 7919 % 1000003}", f"{k}@x") for k in range(20_000)]

    days = [date(2024, 1, d) for d in (1, 2, 3)]
    wanted = list(follow(spark, str(tmp_path), list(zip(days, [rows(0), rows(1), rows(1)]))))
    assert all(found == whole for found, whole in wanted)
    sizes = {}
    for folder in (tmp_path / "customer_dimension").iterdir():
        sizes[folder.name[:10]] = sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    assert set(sizes) == {"run=000001", "run=000002"}
    assert sizes["run=000002"] < 0.08 * sizes["run=000001"]
