"""Column checks and key checks that can stop a pipeline."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from daygrain.functions import labels
from daygrain.operators.joins import broadcast_if_small


class CheckFailed(ValueError):
    """A check found failing rows."""


@dataclass(frozen=True)
class TableChecks:
    """Checks of one table; ``accepted`` maps a column to its allowed values."""

    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows that fail."""
    return df.filter(F.col(column).isNull())


def check_accepted(df: DataFrame, column: str, values: Sequence[str] | DataFrame) -> DataFrame:
    """Values outside the allowed set and how often each occurs; NULL passes.

    A long list, such as all series keys, is given as a one-column DataFrame.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n_records")
    )
    if isinstance(values, DataFrame):
        allowed = values.select(F.col(values.columns[0]).alias(column)).distinct()
        return counted.join(allowed, column, "left_anti")
    return counted.filter(~F.col(column).isin(*values))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    example = check_unique(df, keys).first()
    if example is not None:
        raise CheckFailed(f"duplicate key {example.asDict()}")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def coverage(df: DataFrame, series: str = "city", time: str = "date") -> DataFrame:
    """First date, last date and number of rows of each series."""
    return df.groupBy(series).agg(
        F.min(time).alias("first_date"),
        F.max(time).alias("last_date"),
        F.count(F.lit(1)).alias("total_records"),
    )


class Checking:
    """The checks of one table, as sums over its rows.

    Nothing here starts a scan of its own: the sums are taken where the rows pass, in one
    aggregation (:meth:`results`) or while they are written (:meth:`watch`). A long list of
    known series is joined to the rows, which marks those it holds.
    """

    def __init__(self, name: str, checks: TableChecks, series_list: DataFrame | Sequence[str]):
        self.name, self.observations = name, []
        listed = [c for c, values in checks.accepted.items() if values is SERIES_LIST]
        self.known = series_list if isinstance(series_list, DataFrame) else None
        self.marks = {c: f"_known_{c}" for c in listed} if self.known is not None else {}
        self.tests = [(c, "not_null", F.col(c).isNull()) for c in checks.not_null]
        for c, values in checks.accepted.items():
            if c in self.marks:
                accepted = F.col(self.marks[c]).isNotNull()
            else:
                accepted = F.col(c).isin(*(series_list if values is SERIES_LIST else values))
            self.tests.append((c, "accepted_values", F.col(c).isNotNull() & ~accepted))

    def marked(self, df: DataFrame) -> DataFrame:
        """Rows with the marks of what is known. Put where rows still lie by series, a join of a long list moves none of them."""
        for column, mark in self.marks.items():
            known = self.known.select(F.col(self.known.columns[0]).alias(mark))
            df = df.join(known, F.col(column) == F.col(mark), "left")
        return df

    def sums(self) -> list[Column]:
        return [F.count(F.when(test, 1)).alias(f"t{i}") for i, (_, _, test) in enumerate(self.tests)]

    def results(self, df: DataFrame) -> DataFrame:
        """(table_name, column_name, check_name, failures), lazily, from one pass over the table."""
        entries = [
            F.struct(
                F.lit(self.name).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(kind).alias("check_name"),
                F.col(f"t{i}").alias("failures"),
            )
            for i, (column, kind, _) in enumerate(self.tests)
        ]
        return self.marked(df).agg(*self.sums()).select(F.inline(F.array(*entries)))

    def watch(self, df: DataFrame) -> DataFrame:
        """The same rows, counted as they pass. Put last in a plan that is run once, such as a write.

        A table that is written in parts has each of them watched.
        """
        self.observations.append(Observation(f"checks of {self.name} {uuid.uuid4().hex}"))
        rows = df if set(self.marks.values()) <= set(df.columns) else self.marked(df)
        return rows.observe(self.observations[-1], *self.sums()).drop(*self.marks.values())

    def found(self) -> list[tuple]:
        """What :meth:`watch` counted, as rows of the results."""
        # A table that turns out empty may leave nothing to observe.
        counted = [observation.get for observation in self.observations]
        return [
            (self.name, column, kind, sum(part.get(f"t{i}", 0) for part in counted))
            for i, (column, kind, _) in enumerate(self.tests)
        ]


RESULTS = "table_name string, column_name string, check_name string, failures bigint"


def known_series(series_list: DataFrame | Sequence[str]) -> DataFrame | Sequence[str]:
    """The distinct known series, to be broadcast if they are few."""
    if not isinstance(series_list, DataFrame):
        return series_list
    return broadcast_if_small(series_list.select(series_list.columns[0]).distinct())


def run_checks(
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, TableChecks] | None = None,
    series_list: DataFrame | Sequence[str] = (),
) -> DataFrame:
    """Results of all checks: (table_name, column_name, check_name, failures). Each table is read once."""
    checks = STANDARD_CHECKS if checks is None else checks
    known = known_series(series_list)
    parts = [Checking(name, checks[name], known).results(df) for name, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def require_passed(results: DataFrame) -> DataFrame:
    """Raise if any check failed; returns the results as they were found, without another pass.

    There is one row per check, so they are few.
    """
    found = results.collect()
    failed = [r.asDict() for r in found if r.failures > 0]
    if failed:
        raise CheckFailed(f"{len(failed)} checks failed: {failed}")
    return results.sparkSession.createDataFrame(found, results.schema)


#: Stands for "the known series", given to `run_checks` as ``series_list``.
SERIES_LIST = ("<series>",)

# The 30 column checks of the model tables and the fact table.
STANDARD_CHECKS = {
    "moving_avg": TableChecks(
        not_null=(
            "city",
            "date",
            "temp_max",
            "temp_max_7day_avg",
            "temp_min_7day_avg",
            "temp_mean_7day_avg",
        ),
        accepted={"city": SERIES_LIST},
    ),
    "temp_anomaly": TableChecks(
        not_null=("city", "date", "temp_max", "temp_max_anomaly", "anomaly_category"),
        accepted={"city": SERIES_LIST, "anomaly_category": labels.ANOMALY_CATEGORIES},
    ),
    "rolling_precip": TableChecks(
        not_null=("city", "date", "precipitation_mm", "precip_7day_rolling_sum", "period_label"),
        accepted={"city": SERIES_LIST, "period_label": labels.PERIOD_LABELS},
    ),
    "dry_spell": TableChecks(
        not_null=("city", "date", "precipitation_mm", "dry_spell_days", "dry_spell_label"),
        accepted={"city": SERIES_LIST, "dry_spell_label": labels.DRY_SPELL_LABELS},
    ),
    "city_weather": TableChecks(not_null=("city", "date")),
}
