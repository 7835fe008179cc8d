"""Writing results: loaded rows, rejects, exports and check results."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.plans.migration import Migration
from tallybridge.session import run_jobs


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite ``path``. CSV keeps blanks at both ends and writes empty text as nothing."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = (
            writer.option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    writer.save(path)


def write_results(run: Migration, target: str, rejects: str, fmt: str = "parquet") -> None:
    """Loaded rows to ``target/<entity>``, rejects with their reason to ``rejects/<entity>``."""
    jobs = {}
    for name, result in run.results.items():
        jobs[f"{name} loaded"] = partial(write_table, result.loaded, f"{target}/{name}", fmt)
        jobs[f"{name} rejects"] = partial(write_table, result.rejects, f"{rejects}/{name}", fmt)
    run_jobs(run.spark, jobs)


def write_exports(tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet") -> None:
    """One folder per table, named as given (``<Table>-<Id>``)."""
    jobs = {name: partial(write_table, df, f"{base}/{name}", fmt) for name, df in tables.items()}
    run_jobs(next(iter(tables.values())).sparkSession, jobs)


def write_checks(checks: DataFrame, path: str) -> None:
    """The report as JSON: one line per check in ``checks``, and ``totals`` with passed and total."""
    checks.write.mode("overwrite").json(f"{path}/checks")
    totals = checks.agg(F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"))
    totals.write.mode("overwrite").json(f"{path}/totals")
