"""Split every source row into loaded or quarantined-with-a-reason.

Reasons are tested in a fixed order and the first one wins: number that cannot be read, missing
required field, duplicate after cleansing, reference without a loaded parent. Duplicates are
looked for among *all* rows, also those already rejected; a reference counts only when its parent
was *loaded*.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybridge.operators.keysets import Budget, label_rows, mark_repeats, unmatched_keys
from tallybridge.plans.spec import Entity, check_source, col

SOURCE_ROW = "_source_row"
SOURCE = "_source"
REASON = "reject_reason"
STATUS = "status"
LOADED, REJECTED = "loaded", "rejected"

DUPLICATE = "duplicate_after_normalisation"


def missing_required(targets: Sequence[str]) -> Column:
    """Reason for the first required field that is null or empty, else null."""
    tests = [
        F.when(
            col(t).isNull() | (F.length(col(t).cast("string")) == 0), f"missing_required:{t}"
        )
        for t in targets
    ]
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def mark_duplicates(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (SOURCE_ROW,),
    flag: str = "is_duplicate",
    budget: Budget = Budget(),
) -> DataFrame:
    """Add ``flag``: true for every row of a key but its first in ``order``.

    ``order`` must give the rows of a key different positions (see :func:`refuse_ties`).
    """
    return mark_repeats(rows, keys, order, flag, budget)


def refuse_ties(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> None:
    """Raise if two rows of a key share a position, for then neither would be the first alone."""
    tied = (
        rows.groupBy(*[col(c) for c in (*keys, *order)])
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
        .limit(1)
        .collect()
    )
    if tied:
        raise ValueError(f"order columns {list(order)} do not tell rows apart: {tied[0].asDict()}")


def mark_orphans(
    rows: DataFrame,
    key: str,
    parents: DataFrame,
    parent_key: str,
    flag: str = "is_orphan",
    spread_by: Sequence[str] = (SOURCE_ROW,),
    budget: Budget = Budget(),
) -> DataFrame:
    """Add ``flag``: true where ``key`` is null or names no row of ``parents``."""
    verdicts = unmatched_keys(rows, key, parents, parent_key, budget)
    labelled = label_rows(rows, key, verdicts, flag, spread_by, budget)
    return labelled.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def classify(
    entity: Entity,
    source: DataFrame,
    parents: Mapping[str, tuple[DataFrame, str]] | None = None,
    order_by: Sequence[str] = (SOURCE_ROW,),
    budget: Budget = Budget(),
) -> DataFrame:
    """One row per source row: cleansed target fields, ``reject_reason`` (null when loadable),
    ``status``, the lineage columns and, for rejects only, the untouched source columns.

    ``parents`` maps parent entities to their loaded rows and the name of their key. ``order_by``
    names source columns that give every row its own place in the source; "keep first" follows
    them. They may be mapped columns too, and rejects keep them. Columns other than the position
    stored by landing are checked for ties first. Checking and measuring run jobs while the plan is built.
    """
    check_source(entity, source.columns)
    absent = [c for c in order_by if c not in source.columns]
    if absent:
        raise KeyError(f"{entity.name}: the source has no order column {absent}; land it first")
    original = [c for c in source.columns if c != SOURCE_ROW]
    raw = {c: F.col(f"source_{i}") for i, c in enumerate(original)}
    keys = dict.fromkeys([*entity.dedupe_on, *[child for child, _ in entity.foreign_keys]])
    key_names = {target: f"key_{i}" for i, target in enumerate(keys)}
    order = [_lineage(i) for i in range(len(order_by))]

    # Up to the final projection rows carry their source columns and keys only.
    rows = source.select(
        *[col(c).alias(f"source_{i}") for i, c in enumerate(original)],
        *[col(c).alias(n) for c, n in zip(order_by, order)],
        *[entity.field(target).value().alias(n) for target, n in key_names.items()],
    )
    flags: list[Column] = []
    if entity.dedupe_on:
        dedupe_on = [key_names[t] for t in entity.dedupe_on]
        if tuple(order_by) != (SOURCE_ROW,):
            refuse_ties(rows, dedupe_on, order)
        rows = mark_duplicates(rows, dedupe_on, order, "is_duplicate", budget)
        flags.append(F.when(F.col("is_duplicate"), DUPLICATE))
    for i, (child, parent) in enumerate(entity.foreign_keys):
        if parents is None or parent not in parents:
            raise KeyError(f"{entity.name}: {child!r} needs the loaded rows of {parent!r}")
        loaded, parent_key = parents[parent]
        rows = mark_orphans(
            rows, key_names[child], loaded, parent_key, f"is_orphan_{i}", order, budget
        )
        flags.append(F.when(F.col(f"is_orphan_{i}"), f"orphan:{child}"))
    unreadable = [F.when(bad, f"invalid_number:{t}") for t, bad in entity.bad_numbers(raw)]

    mapped = rows.select(
        *[f.value(raw[f.source]).alias(f.target) for f in entity.fields],
        *order,
        *raw.values(),
        F.coalesce(*unreadable, F.lit(None).cast("string")).alias("unreadable"),
        F.coalesce(*flags, F.lit(None).cast("string")).alias("finding"),
    )
    mapped = mapped.withColumn(
        REASON, F.coalesce("unreadable", missing_required(entity.required), "finding")
    )
    rejected = F.col(REASON).isNotNull()
    as_extracted = F.struct(*[value.alias(c) for c, value in raw.items()])
    return mapped.select(
        *[col(f.target) for f in entity.fields],
        *order,
        F.when(rejected, as_extracted).alias(SOURCE),
        REASON,
        F.when(rejected, REJECTED).otherwise(LOADED).alias(STATUS),
    )


def _lineage(i: int) -> str:
    return SOURCE_ROW if i == 0 else f"{SOURCE_ROW}_{i}"


def loaded_rows(classified: DataFrame, entity: Entity) -> DataFrame:
    """Target fields of the rows that passed, without lineage."""
    return classified.filter(F.col(STATUS) == LOADED).select(
        *[col(f.target) for f in entity.fields]
    )


def rejected_rows(classified: DataFrame) -> DataFrame:
    """Source columns as they were extracted, plus the reason."""
    return classified.filter(F.col(STATUS) == REJECTED).select(f"{SOURCE}.*", REASON)
