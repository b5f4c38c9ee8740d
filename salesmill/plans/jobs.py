"""Assembled jobs: raw rows in, finished datamart out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmill.operators.clean import clean, finish
from salesmill.operators.impute import impute
from salesmill.operators.stats import table_stats
from salesmill.plans.profiles import Profile, get_profile
from salesmill.plans.staging import new_path, stage
from salesmill.schemas import CLEAN_SCHEMA
from salesmill.sinks.tables import write_both
from salesmill.sources.files import land_bronze, read_table


def build_datamart(raw: DataFrame, profile: str | Profile = "datamart", as_of=None, stage_clean: bool = False) -> DataFrame:
    """Clean, derive, impute and project `raw` as `profile` does.

    `raw` is read twice: once, a few columns wide, for the means and once for the rows. Where the rows are
    costly to make (a join, gzip files) `stage_clean` writes the cleaned rows first and works from them.
    """
    p = get_profile(profile)
    rows = clean(raw, p, as_of)
    if p.imputation is None:
        return finish(rows, p)
    if stage_clean:
        rows = stage(rows, f"clean-{p.name}")
    return finish(impute(rows, p.imputation), p)


def run_job(spark: SparkSession, source, targets: list[str], profile: str | Profile = "datamart", as_of=None,
            bronze: str | None = None, quoted_newlines: bool = False, stats: str = "pipeline") -> DataFrame:
    """The whole job: land the CSV files of `source`, clean and impute, load every target, report on the first.

    The landed extract goes to `bronze`, or to the shared folder without it. Returns the one-row statistics of the
    loaded table, taken from what was written.
    """
    raw = land_bronze(spark, source, bronze or new_path(spark, "bronze"), quoted_newlines)
    write_both(build_datamart(raw, profile, as_of), targets)
    return table_stats(read_table(spark, targets[0], CLEAN_SCHEMA), stats)
