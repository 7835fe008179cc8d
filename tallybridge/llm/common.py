"""Helpers of the training-data operators: folds, staged tables, Arrow passes over text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybridge.session import new_folder

#: Rows of a batch that a Python function sees at once.
SLICE = 256


def in_fold(doc_id: Column, k: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder. A null id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % k == remainder, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe from lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def map_text(
    df: DataFrame,
    text: str,
    outputs: str,
    make: Callable[[], Callable[[list[str | None]], dict[str, Sequence]]],
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` (or its columns ``carry``) with columns computed from whole texts in Arrow batches.

    ``make`` runs once per task and returns a function from a list of texts to the values of
    ``outputs`` (a DDL string). Input columns named like an output are replaced by it.
    """
    added = T._parse_datatype_string(outputs)
    kept = without(df if carry is None else df.select(*dict.fromkeys([*carry, text])), added.names)
    out = [c for c in kept.columns if carry is None or c in carry]
    schema = T.StructType([kept.schema[c] for c in out] + added.fields)
    arrow = [pa_type(f.dataType) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                values = f(part.column(part.schema.get_field_index(text)).to_pylist())
                columns = [part.column(part.schema.get_field_index(c)) for c in out]
                columns += [pa.array(values[n], t) for n, t in zip(added.names, arrow)]
                yield pa.RecordBatch.from_arrays(columns, names=[*out, *added.names])

    return kept.mapInArrow(run, schema)


def keep_rows(df: DataFrame, text: str, make: Callable[[], Callable[[str | None], bool]]) -> DataFrame:
    """The rows whose text passes, with all their columns. ``make`` runs once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                yield part.filter(pa.array([passes(t) for t in texts], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def pa_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def word_blocks(text: str, chars: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words (runs without ASCII white space) of a text with A-Z lower-cased, in blocks, so that a
    very long text never becomes one list."""
    if len(text) <= chars:
        yield text.encode("utf-8", "surrogatepass").lower().split()
        return
    rest = b""
    for at in range(0, len(text), chars):
        piece = rest + text[at : at + chars].encode("utf-8", "surrogatepass").lower()
        words = piece.split()
        if words and not piece[-1:].isspace():
            rest = words.pop()
        else:
            rest = b""
        if words:
            yield words
    if rest:
        yield [rest]
