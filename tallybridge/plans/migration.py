"""Run a mapping spec over its extracts: classify, write once, read back."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybridge.operators.keysets import Budget
from tallybridge.operators.quarantine import (
    SOURCE_ROW,
    STATUS,
    classify,
    loaded_rows,
    rejected_rows,
)
from tallybridge.plans.spec import Entity, load_spec
from tallybridge.session import delete_file, new_folder, read_text, run_jobs, write_text

# Where a run that can be resumed keeps its manifests.
COMMITS = "_commits"


@dataclass(frozen=True)
class EntityResult:
    """Outcome for one entity. ``source`` is the extract itself, not a product of the run.

    ``counted`` is the number of records that the reader counted in the extract's text, if it was landed.
    """

    entity: Entity
    source: DataFrame
    classified: DataFrame
    counted: int | None = None

    @property
    def loaded(self) -> DataFrame:
        return loaded_rows(self.classified, self.entity)

    @property
    def rejects(self) -> DataFrame:
        return rejected_rows(self.classified)


@dataclass
class Migration:
    spark: SparkSession
    folder: str
    results: dict[str, EntityResult] = field(default_factory=dict)
    resumed: set[str] = field(default_factory=set)

    def __getitem__(self, name: str) -> EntityResult:
        return self.results[name]


def migrate(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    spec: Mapping[str, Entity] | None = None,
    folder: str | None = None,
    run: Migration | None = None,
    order_by: Mapping[str, Sequence[str]] | None = None,
    entities: Sequence[str] | None = None,
    strict: bool = False,
    budget: Budget = Budget(),
    counted: Mapping[str, int] | None = None,
    resume: bool = False,
) -> Migration:
    """Migrate every entity of ``spec``, parents first.

    Each entity is classified and written once, partitioned by ``status``; parents, checks and
    reports all read that table. Entities that do not depend on each other run side by side. ``sources`` maps extract names to DataFrames and ``order_by``
    extract names to the columns that give source order. ``entities`` restricts the run and
    ``run`` continues an earlier one. ``strict`` stops at the first entity with an unreadable
    number, before anything of it is written, instead of quarantining the row. ``counted`` gives
    the reader's own count of records per extract (``landing_counts``); row accounting then starts
    there and not at the landed table.

    With ``resume`` (and a ``folder``) each entity is committed when its table is written: a manifest with its plan, its
    input files, its parents' commits and its row counts is put in place by a rename. A later run with the same folder takes over
    entities whose manifest still holds (``resumed`` names them) and runs the others.
    """
    if resume and folder is None and run is None:
        raise ValueError("a run can be resumed only in a folder that is named")
    spec = spec or load_spec()
    run = run or Migration(spark, folder or new_folder(spark, "migration"))
    names = [name for name in spec if entities is None or name in entities]
    commits: dict[str, str] = {}

    def one(name: str) -> None:
        entity = spec[name]
        source = sources[entity.source]
        parents = {
            parent: (run[parent].loaded, spec[parent].key_target[0])
            for _, parent in entity.foreign_keys
        }
        if strict:
            _stop_on_bad_numbers(entity, source)
        order = tuple((order_by or {}).get(entity.source, (SOURCE_ROW,)))
        path, manifest = f"{run.folder}/{name}", f"{run.folder}/{COMMITS}/{name}.json"
        known = (counted or {}).get(entity.source)
        if resume:
            expected = _fingerprint(entity, source, order, strict, {p: commits.get(p, "") for p in parents})
            commit = _held(spark, manifest, expected, source)
            if commit:
                schema = StructType.fromJson(commit["schema"])
                run.results[name] = EntityResult(entity, source, spark.read.schema(schema).parquet(path), known)
                run.resumed.add(name)
                commits[name] = commit["id"]
                return
            delete_file(spark, manifest)  # before the table it stands for is replaced
        plan = classify(entity, source, parents, order, budget)
        plan.write.mode("overwrite").partitionBy(STATUS).parquet(path)
        written = spark.read.schema(plan.schema).parquet(path)
        if resume:
            commits[name] = uuid.uuid4().hex
            rows = {r[STATUS]: r["count"] for r in written.groupBy(STATUS).count().collect()}
            content = {**expected, "id": commits[name], "rows": rows, "schema": plan.schema.jsonValue()}
            write_text(spark, manifest, json.dumps(content, sort_keys=True))
        run.results[name] = EntityResult(entity, source, written, known)

    run_jobs(
        spark,
        {name: partial(one, name) for name in names},
        after={name: {parent for _, parent in spec[name].foreign_keys} for name in names},
    )
    run.results = {name: run[name] for name in spec if name in run.results}
    return run


def _fingerprint(
    entity: Entity, source: DataFrame, order: Sequence[str], strict: bool, parents: Mapping[str, str]
) -> dict:
    """What an entity's table follows from: its mapping, the names of its input files, and the tables of its parents."""
    names = "\n".join(sorted(source.inputFiles()))
    return {
        "entity": entity.name,
        "plan": hashlib.md5(repr((entity, tuple(order), strict, source.columns)).encode()).hexdigest(),
        "inputs": hashlib.md5(names.encode()).hexdigest(),
        "parents": dict(sorted(parents.items())),
    }


def _held(spark: SparkSession, manifest: str, expected: dict, source: DataFrame) -> dict | None:
    """The commit of an earlier run, if it is of the same plan and input and has as many rows as the source."""
    text = read_text(spark, manifest)
    commit = json.loads(text) if text else None
    if commit is None or any(commit.get(k) != v for k, v in expected.items()):
        return None
    return commit if sum(commit["rows"].values()) == source.count() else None


def _stop_on_bad_numbers(entity: Entity, source: DataFrame) -> None:
    """Raise if a number of the extract cannot be read; the error gives the count per field."""
    counts = source.agg(*[F.count_if(bad).alias(t) for t, bad in entity.bad_numbers()] or [F.lit(0).alias("none")])
    bad = {t: n for t, n in counts.first().asDict().items() if n}
    if bad:
        raise ValueError(f"{entity.name}: unreadable numbers, rows per field: {bad}")
