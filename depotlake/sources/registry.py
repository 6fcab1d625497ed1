"""The nine source tables a warehouse is built from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlake.schemas import (
    COLUMN_DEFAULTS,
    LOAD_TIME_DEFAULTS,
    MORE_COLUMNS,
    SOURCES,
    columns,
    conform,
)


class Sources(Mapping[str, DataFrame]):
    """Named source DataFrames with the declared columns, made and read only when asked for.

    Declared defaults stand for NULLs from the moment a source is loaded.
    """

    def __init__(
        self,
        frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
        current_only: bool = False,
        load_time: datetime | None = None,
        row_counts: Mapping[str, int] | None = None,
        counted_by: Mapping[str, Callable[[], DataFrame]] | None = None,
    ):
        """``current_only`` keeps the current versions of sources that carry ``is_current``.

        ``row_counts`` saves the counting of sources whose size is known; ``counted_by`` makes
        tables that have as many rows as a source and are quicker to count. ``load_time`` fills
        missing audit times.
        """
        missing = sorted(set(SOURCES) - set(frames))
        if missing:
            raise ValueError(f"sources not given: {missing}")
        self._given = dict(frames)
        self._current_only = current_only
        self._load_time = load_time
        self._ready: dict[str, DataFrame] = {}
        self._rows: dict[str, int] = dict(row_counts or {})
        self._counted_by = dict(counted_by or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._ready:
            given = self._given[name]
            frame = given if isinstance(given, DataFrame) else given()
            more = [c for c in columns(MORE_COLUMNS.get(name, "")) if c[0] in frame.columns]
            ddl = ", ".join([SOURCES[name], *[f"{column} {kind}" for column, kind in more]])
            frame = with_defaults(conform(frame, ddl), name, self._load_time)
            if self._current_only and "is_current" in frame.columns:
                frame = frame.filter("is_current")
            self._ready[name] = frame
        return self._ready[name]

    def core(self, name: str) -> DataFrame:
        """The columns that every such source has."""
        return self[name].select(*[column for column, _ in columns(SOURCES[name])])

    def __iter__(self):
        return iter(SOURCES)

    def __len__(self) -> int:
        return len(SOURCES)

    def rows(self, *names: str) -> dict[str, int]:
        """Row counts, each taken once; those still missing are taken in one job, at once."""
        missing = [n for n in names if n not in self._rows]
        if missing:
            tables = {n: self._counted_by[n]() if n in self._counted_by else self[n] for n in missing}
            counted = source_counts(tables).collect()
            self._rows |= {r["source_name"]: r["row_count"] for r in counted}
        return {n: self._rows[n] for n in names}

    def replace(self, **frames: DataFrame) -> "Sources":
        kept = {n: rows for n, rows in self._rows.items() if n not in frames}
        counted_by = {n: make for n, make in self._counted_by.items() if n not in frames}
        given = {**self._given, **frames}
        return Sources(given, self._current_only, self._load_time, kept, counted_by)


def source_counts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One row per source: its name and row count, all counted in one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("source_name"), "row_count"
        )
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


def with_defaults(df: DataFrame, source: str, load_time: datetime | None = None) -> DataFrame:
    """Replace NULLs by the source's declared column defaults, for the columns ``df`` has."""
    filled = {
        name: F.coalesce(F.col(name), F.expr(literal).cast(df.schema[name].dataType))
        for name, literal in COLUMN_DEFAULTS.get(source, {}).items()
        if name in df.columns
    }
    if load_time is not None:
        for name in LOAD_TIME_DEFAULTS.get(source, []):
            if name in df.columns:
                filled[name] = F.coalesce(F.col(name), F.lit(load_time))
    return df.withColumns(filled) if filled else df
