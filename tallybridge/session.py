"""Shared-folder helpers: where intermediate tables live so that any executor can be lost."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can read: ``spark.checkpoint.dir``.

    It is taken from the session. Only a session in one process without one gets a temporary folder;
    a cluster without one is a configuration error, since a machine-local folder there would
    vanish with its executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallybridge-"))
    return sc.getCheckpointDir().rstrip("/")


_RECORDERS: list[list[str]] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is ever overwritten there."""
    folder = f"{shared_root(spark)}/tallybridge/{label}-{uuid.uuid4().hex[:12]}"
    for made in _RECORDERS:
        made.append(folder)
    return folder


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Collects the folders that :func:`new_folder` names in the meantime, in order, so that a run can
    delete those that nothing reads any more (:func:`remove_folder`)."""
    made: list[str] = []
    _RECORDERS.append(made)
    try:
        yield made
    finally:
        _RECORDERS[:] = [r for r in _RECORDERS if r is not made]


def children(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """Direct children of a folder as (name, is folder), sorted; hidden ones are left out. Reads no content."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = ((s.getPath().getName(), s.isDirectory()) for s in files.listStatus(path))
    return sorted((name, is_folder) for name, is_folder in found if name[0] not in "._")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that :func:`new_folder` named, when nothing reads it any more."""
    if not folder.startswith(f"{shared_root(spark)}/tallybridge/"):
        raise ValueError(f"{folder} was not made here")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in place by a rename, so that it is there whole or not at all."""
    jvm = spark.sparkContext._jvm
    target, fresh = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex[:12]}"))
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(fresh)
    out.write(bytearray(text.encode()))
    out.close()
    files.delete(target, False)
    if not files.rename(fresh, target):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file's content, or None if there is none."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def delete_file(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, False)


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, keep it in the shared folder and cut its lineage."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def run_jobs(
    spark: SparkSession,
    jobs: Mapping[str, Callable[[], T]],
    after: Mapping[str, set[str]] | None = None,
    at_once: int = 8,
) -> dict[str, T]:
    """Run independent Spark jobs side by side, so that one's last tasks leave no cores idle.

    A job starts when those that ``after`` names for it are done; list them before it.
    """
    futures: dict[str, Future] = {}

    def run(name: str) -> T:
        for earlier in (after or {}).get(name, ()):
            if earlier in futures:
                futures[earlier].result()
        return jobs[name]()

    with ThreadPoolExecutor(at_once) as pool:
        for name in jobs:
            futures[name] = pool.submit(inheritable_thread_target(spark)(run), name)
        return {name: future.result() for name, future in futures.items()}
