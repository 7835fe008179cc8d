"""Records of CSV files whose quoted values may hold line breaks, read by many tasks.

Where a record ends depends on all quotes before it. But a line is a function of one bit only: given whether it starts inside a
quoted value, it ends inside one or not. Such functions compose, so each split of a file is summed up for both cases; a
prefix over the splits of a file then tells in which case each of them is. The summary also holds the number of records that start in a
split: the reader's own count, taken from the text before anything is parsed or stored.

Lines end in ``\\n`` or ``\\r\\n``. A quote opens a value at the start of a field only (elsewhere it is text), and two quotes
inside a quoted value are one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybridge.plans.spec import col, quoted
from tallybridge.session import materialise

# Row positions of a file start at its index shifted by this; rows of a task use the lower bits.
FILE_BITS = 43
TASK_BITS = 33
#: Longest stretch of whole splits, in bytes, that one record may cover.
MAX_RECORD = 256 << 20

# Inside of a quoted value; a whole field; the fields after the first. Possessive: no backtracking, no recursion.
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_QUOTED}"[^,]*+|[^",][^,]*+)?+'
_FIELDS = rf"(?:,{_FIELD})*+\z"
ENDS_OUTSIDE = (rf"^{_FIELD}{_FIELDS}", rf'^{_QUOTED}"[^,]*+{_FIELDS}')
_BLANK = r"^[\x00-\x20]*\z"


def file_index(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(source_file, file): files numbered in name order."""
    names = sorted(files, key=unquote)
    if len(names) >= 1 << (63 - FILE_BITS):
        raise ValueError(f"{names[0]} and others: too many files to number their rows")
    return spark.createDataFrame(pa.table({"source_file": pa.array(names, pa.string()), "file": pa.array(range(len(names)), pa.int64())}))


def numbered(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``rows`` with the number of their ``source_file``."""
    unlisted = F.raise_error(F.concat(F.lit("file was not listed: "), F.col("source_file"))).cast("bigint")
    known = rows.join(F.broadcast(index), "source_file", "left")
    return known.withColumn("file", F.coalesce("file", unlisted)).drop("source_file")


def row_in_task() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << TASK_BITS) - 1))


def position(file: Column, split: Column, row: Column) -> Column:
    """Ascends in source order: a row takes at least one byte, so the rows of a split stay below the next split."""
    return F.shiftleft(file, FILE_BITS) + split + row


def scan_lines(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    """(file, split, row, value): every line with its file, the byte at which its split starts, and its place in there."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return numbered(
        lines.select(
            "value",
            F.input_file_name().alias("source_file"),
            F.col("_metadata.file_block_start").alias("split"),
            row_in_task().alias("row"),
        ),
        index,
    )


def _with_function(lines: DataFrame) -> DataFrame:
    """Adds how a line ends if it starts outside (``out_0``) and inside (``out_1``) a quoted value, 1 being inside."""
    value = F.col("value")
    quotes = value.contains('"')
    return lines.withColumns(
        {
            "out_0": F.when(quotes, (~value.rlike(ENDS_OUTSIDE[0])).cast("int")).otherwise(0),
            "out_1": F.when(quotes, (~value.rlike(ENDS_OUTSIDE[1])).cast("int")).otherwise(1),
            "blank": value.rlike(_BLANK),
        }
    )


def _states(rows: DataFrame, keys: Sequence[str], order: str, start: Column) -> DataFrame:
    """Adds ``before`` and ``after``: the state at both ends of each row when the rows' functions follow each other.

    A function either sets the state or turns it (or leaves it), so the state is that of the last row
    that sets it, turned as often as rows after it turn it.
    """
    ordered = Window.partitionBy(*keys).orderBy(order)
    sets = F.col("out_0") == F.col("out_1")
    rows = rows.withColumn("turns", F.sum((F.col("out_0") > F.col("out_1")).cast("int")).over(ordered))
    rows = rows.withColumn("setter", F.last(F.when(sets, F.struct("out_0", "turns")), True).over(ordered))
    since = F.coalesce(F.col("setter.out_0") - F.col("setter.turns"), start)
    rows = rows.withColumn("after", F.pmod(F.col("turns") + since, F.lit(2)))
    return rows.withColumn("before", F.coalesce(F.lag("after").over(ordered), start)).drop("turns", "setter")


def survey(lines: DataFrame) -> DataFrame:
    """One row per split: ``inside`` (whether it starts in a quoted value), ``ends_inside``, ``records`` that start in it,
    ``breaks`` (lines that end inside), the last record that starts in earlier splits (``carry``) and the first of the
    file (``head``). Lines travel without their text.
    """
    narrow = _with_function(lines).select(
        "file", "split", "row", "out_0", "out_1", "blank",
        F.octet_length("value").alias("size"),
    )
    rows = _states(narrow, ("file", "split"), "row", F.lit(0))
    rows = rows.withColumnsRenamed({"before": "before_0", "after": "after_0"})
    rows = _states(rows, ("file", "split"), "row", F.lit(1))
    rows = rows.withColumnsRenamed({"before": "before_1", "after": "after_1"})
    measures = []
    for h in "01":
        starts = (F.col(f"before_{h}") == 0) & ~F.col("blank")
        measures += [
            F.max_by(f"after_{h}", "row").alias(f"out_{h}"),
            F.count_if(starts).alias(f"records_{h}"),
            F.count_if(F.col(f"after_{h}") == 1).alias(f"breaks_{h}"),
            F.min(F.when(starts, F.col("row"))).alias(f"first_{h}"),
            F.max(F.when(starts, F.col("row"))).alias(f"last_{h}"),
        ]
    whole = rows.groupBy("file", "split").agg(*measures, F.sum(F.col("size") + 1).alias("bytes"))

    splits = _states(whole, ("file",), "split", F.lit(0))
    chosen = {
        c: F.when(F.col("before") == 0, F.col(f"{c}_0")).otherwise(F.col(f"{c}_1")) for c in ("records", "breaks", "first", "last")
    }
    splits = splits.select(
        "file", "split", "bytes",
        F.col("before").alias("inside"),
        F.col("after").alias("ends_inside"),
        *[v.alias(c) for c, v in chosen.items()],
    )
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    first, last = (
        F.when(F.col(c).isNotNull(), F.struct("split", F.col(c).alias("row"))) for c in ("first", "last")
    )
    found = {"carry": F.last(last, True).over(earlier), "head": F.min(first).over(Window.partitionBy("file"))}
    return splits.withColumns(found).drop("first", "last")


def _line_text() -> Column:
    """A line without its carriage return and a byte order mark."""
    return F.regexp_replace("value", "^﻿|\r\\z", "")


@dataclass(frozen=True)
class Survey:
    """What the text of an extract says about itself, before it is parsed. ``files`` has the records of each file; ``splits`` is
    None where no line ends inside a quoted value."""

    lines: DataFrame
    splits: DataFrame | None
    files: DataFrame
    index: DataFrame
    breaks: int

    def counts(self) -> DataFrame:
        """(source_file, records) of every file that holds a line; headers are not counted."""
        return numbered_names(self.files, self.index).select("source_file", "records")


def numbered_names(rows: DataFrame, index: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(index), "file")


def survey_files(spark: SparkSession, path: str, files: Sequence[str]) -> Survey:
    """Survey an extract. Raises if its files have different headers, if a quoted value is never closed, or if one
    record covers more than ``MAX_RECORD`` bytes of whole splits."""
    index = file_index(spark, files)
    lines = scan_lines(spark, path, index)

    def name(number: int) -> str:
        return index.where(F.col("file") == number).first()["source_file"]

    # A file starts outside. If no line that starts outside ends inside, none starts inside: one row per file says all.
    title = F.when(F.col("split") == 0, F.struct("row", F.xxhash64(_line_text()).alias("title")))
    plain = _with_function(lines).groupBy("file").agg(
        F.count_if(F.col("out_0") == 1).alias("odd"),
        F.greatest(F.count_if(~F.col("blank")) - 1, F.lit(0)).alias("records"),
        F.min(title).alias("head"),
    )
    plain = materialise(plain)
    found = plain.agg(
        F.coalesce(F.sum("odd"), F.lit(0)).alias("odd"),
        F.count_distinct("head.title").alias("titles"),
        F.min_by("file", "head.title").alias("one"),
        F.max_by("file", "head.title").alias("other"),
    ).first()
    if found["titles"] > 1:
        raise ValueError(f"{path}: headers differ, e.g. of {name(found['one'])} and {name(found['other'])}")
    if not found["odd"]:
        return Survey(lines, None, plain.select("file", "records"), index, 0)

    splits = materialise(survey(lines))
    ends = splits.groupBy("file").agg(F.max_by("ends_inside", "split").alias("inside")).where("inside = 1").first()
    if ends:
        raise ValueError(f"{name(ends['file'])}: a quoted value is never closed")
    covered = splits.where("records = 0 and inside = 1").groupBy("file", "carry").agg(F.sum("bytes").alias("bytes"))
    covered = covered.where(F.col("bytes") > MAX_RECORD).first()
    if covered:
        raise ValueError(f"{name(covered['file'])}: a record is longer than {MAX_RECORD} bytes")
    heads = F.count_if(F.col("head.split") == F.col("split"))
    counts = splits.groupBy("file").agg((F.sum("records") - heads).alias("records"))
    return Survey(lines, splits, counts, index, splits.agg(F.sum("breaks")).first()[0])


def records(found: Survey, columns: Sequence[str], row_column: str) -> DataFrame:
    """Every record as text columns and its position. Headers are left out.

    Lines meet their split's summary by a shuffle on the split, so a task holds no more than it would read. Records of one line
    go on from there; only lines of longer ones are brought together.
    """
    keys = ("file", "split")
    known = found.splits.select(*keys, "inside", "carry", "head")
    rows = _with_function(found.lines).join(known, list(keys))
    rows = _states(rows, keys, "row", F.col("inside"))
    starts = (F.col("before") == 0) & ~F.col("blank")
    so_far = Window.partitionBy(*keys).orderBy("row")
    rows = rows.withColumn("own", F.last(F.when(starts, F.struct("split", "row")), True).over(so_far))
    rows = rows.withColumn("at", F.coalesce("own", "carry")).where(starts | (F.col("before") == 1)).where(F.col("at") != F.col("head"))
    single = starts & (F.col("after") == 0)
    whole = rows.where(single).select("file", "at", "value")
    parts = rows.where(~single).groupBy("file", "at").agg(F.sort_array(F.collect_list(F.struct("split", "row", "value"))).alias("lines"))
    joined = parts.select("file", "at", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("value"))
    schema = ", ".join(f"{quoted(c)} string" for c in columns)
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    parsed = F.from_csv(F.regexp_replace("value", "\r\\z", ""), schema, options)
    texts = whole.unionByName(joined).select(
        parsed.alias("parsed"), position(F.col("file"), F.col("at.split"), F.col("at.row")).alias("position")
    )
    return texts.select(*[F.col("parsed").getField(c).alias(c) for c in columns], F.col("position").alias(row_column))
