"""Reading text extracts.

An extract is a CSV file or folder in which every column is text. It is *landed* once as Parquet
together with each row's place in the source; everything later reads the landed table, column by
column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.operators.compare import union_all
from tallybridge.operators.quarantine import SOURCE_ROW
from tallybridge.plans.spec import col, quoted
from tallybridge.session import children, run_jobs
from tallybridge.sources.records import Survey, numbered, numbered_names, position, records, row_in_task, survey_files

# Texts that a source system writes for "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Where a landed table keeps the reader's own count of its records.
MANIFEST = "_landing"


def _scan(spark: SparkSession, path: str, columns: Sequence[str] | None) -> DataFrame:
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
    )
    if columns is not None:
        reader = reader.schema(", ".join(f"{quoted(c)} string" for c in columns)).option(
            "enforceSchema", False
        )
    return reader.csv(path)


def _with_nulls(df: DataFrame, columns: Sequence[str], null_tokens: Sequence[str]) -> DataFrame:
    if not null_tokens:
        return df
    return df.withColumns(
        {c: F.when(~col(c).isin(list(null_tokens)), col(c)) for c in columns}
    )


def _surveyed(
    spark: SparkSession, path: str, raw: DataFrame, multi_line: bool
) -> Survey:
    """The survey of an extract's text; raises where its files cannot be read safely."""
    found = survey_files(spark, path, raw.inputFiles())
    if found.breaks and not multi_line:
        broken = numbered_names(found.splits.where("breaks > 0").limit(1), found.index).first()
        raise ValueError(
            f"{broken['source_file']}: a quoted value holds a line break; read it with multi_line=True"
        )
    return found


def read_extract(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header as text columns; ``null_tokens`` become null.

    ``columns`` is the expected header. Without it the header is read from the first file. The text is surveyed
    first, as by :func:`land_extract`, and what that refuses is refused here.
    """
    raw = _scan(spark, path, columns)
    found = _surveyed(spark, path, raw, multi_line)
    names = raw.columns
    df = records(found, names, SOURCE_ROW).drop(SOURCE_ROW) if found.breaks else raw
    return _with_nulls(df, names, null_tokens)


def land_extract(
    spark: SparkSession,
    path: str,
    target: str,
    columns: Sequence[str] | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """Read an extract once, store it as Parquet with its ``_source_row`` and read that.

    ``_source_row`` ascends in source order, files in name order. Within a file it is the byte at
    which the row's split starts plus the number of the row in its task; a row takes at least one
    byte, so splits cannot overlap. It depends on how the scan was split, which is why it is stored
    with the rows.

    The text is surveyed before it is parsed. Files with different headers, quoted values that are never closed and,
    unless ``multi_line`` is set, quoted values with line breaks are refused; with it, files are cut at the true
    record borders and read by many tasks. A quote inside a field that does not start with one is text. The survey's own
    count of records stays with the table as its manifest (see :func:`landing_counts`).
    """
    raw = _scan(spark, path, columns)
    names = raw.columns
    found = _surveyed(spark, path, raw, multi_line)
    if found.breaks:
        rows = records(found, names, SOURCE_ROW)
    else:
        rows = raw.select(
            *[col(c) for c in names],
            F.input_file_name().alias("source_file"),
            F.col("_metadata.file_block_start").alias("split"),
            row_in_task().alias("row"),
        )
        place = position(F.col("file"), F.col("split"), F.col("row")).alias(SOURCE_ROW)
        rows = numbered(rows, found.index).select(*[col(c) for c in names], place)
    landed = _with_nulls(rows, names, null_tokens)
    landed.write.mode("overwrite").parquet(target)
    found.counts().write.mode("overwrite").parquet(f"{target.rstrip('/')}/{MANIFEST}")
    return spark.read.schema(landed.schema).parquet(target)


def landing_counts(spark: SparkSession, target: str, names: Sequence[str]) -> dict[str, int]:
    """Records that the reader counted in the text of each extract landed under ``target``, by extract.

    They were counted before anything was parsed or stored, so they tell rows that got lost on the way.
    """
    base = target.rstrip("/")
    parts = [
        spark.read.schema("source_file string, records bigint")
        .parquet(f"{base}/{name}/{MANIFEST}")
        .agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"))
        .select(F.lit(name).alias("name"), "records")
        for name in names
    ]
    return {r["name"]: r["records"] for r in union_all(parts).collect()} if parts else {}


def land_folder(
    spark: SparkSession,
    folder: str,
    target: str,
    null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
) -> dict[str, DataFrame]:
    """Land every CSV file of a folder, and every folder of CSV files in it, as one extract each, side by side."""
    found = [(n, d) for n, d in children(spark, folder) if d or n.endswith(".csv")]
    names = {n.removesuffix(".csv"): f"{folder.rstrip('/')}/{n}" for n, _ in found}
    if len(names) < len(found):
        raise ValueError(f"{folder}: a file and a folder share a name: {[n for n, _ in found]}")
    jobs = {
        name: partial(land_extract, spark, path, f"{target}/{name}", None, null_tokens, multi_line)
        for name, path in names.items()
    }
    return run_jobs(spark, jobs)
