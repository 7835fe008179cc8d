"""Checks that prove a migration: nothing lost, nothing changed.

The source side of every check is computed from the extract, the target side from the table the
migration wrote. Row counts, key checksums and gaps of an entity come out of one scan of each side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybridge.functions.rules import MONEY
from tallybridge.operators.checksum import differing_keys, digest_bucket, digest_sum, key_digest
from tallybridge.operators.compare import totals_by_side, union_all, within
from tallybridge.operators.quarantine import LOADED, REASON, SOURCE, STATUS
from tallybridge.plans.migration import EntityResult, Migration
from tallybridge.plans.spec import Entity, Field, col

# Largest accepted difference, name of the local currency in totals, check titles.
TOLERANCE = 0.005
LOCAL = "LCY"
ROW_ACCOUNTING = "row accounting (loaded + rejected)"
KEY_CHECKSUM = "key checksum (MD5)"
ACCOUNT_TOTALS = "per-account totals match"
TRIAL_BALANCE = "trial balance nets to zero"


class CheckFailed(RuntimeError):
    """At least one check did not pass."""


def _quarantined(field: Field) -> Column:
    """The field's source column as it was put into quarantine."""
    return F.col(SOURCE).getField(field.source)


def _source_digest(entity: Entity) -> Column:
    """Digest of the key that a source row should arrive with; of its text where that is no number."""
    return key_digest([entity.field(k).key_text() for k in entity.key_target])


def _target_digest(entity: Entity) -> Column:
    """Digest of the key that arrived: as loaded, or as cleansed from the quarantined source row."""
    quarantined = key_digest(
        [entity.field(k).key_text(_quarantined(entity.field(k))) for k in entity.key_target]
    )
    loaded = key_digest([col(k) for k in entity.key_target])
    return F.when(F.col(STATUS) == LOADED, loaded).otherwise(quarantined)


def _no_currency(entity: Entity) -> Column:
    currency = entity.currency_field()
    return F.lit(False) if currency is None else col(currency.source).isNull()


def missing_currency(entity: Entity, source: DataFrame) -> DataFrame:
    """Source rows without a currency; they default to the local one."""
    return source.agg(F.count_if(_no_currency(entity)).alias("missing_currency")).select(
        F.lit(entity.name).alias("entity"), "missing_currency"
    )


def _totals(result: EntityResult, per_bucket: bool) -> list[DataFrame]:
    """Counts and checksum of the extract, and of what was written.

    Where the reader counted the records of the extract's text, that count is the number of source rows: rows
    that got lost in landing are missing then on the target side.
    """
    entity, loaded = result.entity, F.col(STATUS) == LOADED
    digest = F.col("digest")
    bucket = [digest_bucket(digest).alias("bucket")] if per_bucket else []
    source = (
        result.source.withColumn("digest", _source_digest(entity))
        .groupBy(*bucket)
        .agg(
            F.count(F.lit(1)).alias("source_rows"),
            F.count_if(_no_currency(entity)).alias("missing_currency"),
            digest_sum(digest).alias("source_checksum"),
        )
    )
    if result.counted is not None and not per_bucket:
        source = source.withColumn("source_rows", F.lit(result.counted).cast("bigint"))
    target = (
        result.classified.withColumn("digest", _target_digest(entity))
        .groupBy(*bucket)
        .agg(
            F.count_if(loaded).alias("loaded_rows"),
            F.count_if(~loaded).alias("rejected_rows"),
            digest_sum(digest).alias("target_checksum"),
        )
    )
    return [side.withColumn("entity", F.lit(entity.name)) for side in (source, target)]


def entity_totals(run: Migration, per_bucket: bool = False) -> DataFrame:
    """Row counts, key checksums and currency gaps per entity (and digest bucket)."""
    sides = union_all(
        [side for r in run.results.values() for side in _totals(r, per_bucket)], partial_columns=True
    )
    keys = ["entity", "bucket"] if per_bucket else ["entity"]
    return sides.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sides.columns if c not in keys]
    )


def _rows_accounted() -> Column:
    return F.col("source_rows") == F.col("loaded_rows") + F.col("rejected_rows")


def row_accounting(run: Migration) -> DataFrame:
    """Rows in the extract against rows written, split into loaded and rejected.

    The rows of a landed extract are those that the reader counted in its text (``migrate(counted=...)``); without
    that count they are those of the source table.
    """
    return entity_totals(run).select(
        "entity", "source_rows", "loaded_rows", "rejected_rows", _rows_accounted().alias("passed")
    )


def entity_summary(run: Migration) -> DataFrame:
    """Source, loaded and rejected rows per entity, and rows that fell back to local currency."""
    return entity_totals(run).select(
        "entity", "source_rows", "loaded_rows", "rejected_rows", "missing_currency"
    )


def _key_columns(totals: DataFrame) -> DataFrame:
    keys = [c for c in ("entity", "bucket") if c in totals.columns]
    target_keys = F.col("loaded_rows") + F.col("rejected_rows")
    same = (F.col("source_rows") == target_keys) & (
        F.col("source_checksum") == F.col("target_checksum")
    )
    return totals.select(
        *keys,
        F.col("source_rows").alias("source_keys"),
        "source_checksum",
        target_keys.alias("target_keys"),
        "target_checksum",
        same.alias("passed"),
    )


def key_checksums(run: Migration, per_bucket: bool = False) -> DataFrame:
    """Key count and checksum of both sides, per entity or per entity and digest bucket."""
    return _key_columns(entity_totals(run, per_bucket))


def source_keys(result: EntityResult) -> DataFrame:
    return result.source.select(*result.entity.key_from_source())


def target_keys(result: EntityResult) -> DataFrame:
    """Keys that arrived: those loaded, and those of the rejects cleansed by the same rules."""
    return result.loaded.select(*[col(k) for k in result.entity.key_target]).union(
        result.rejects.select(*result.entity.key_from_source())
    )


def key_differences(result: EntityResult) -> DataFrame:
    """Keys that did not arrive as often as they were extracted, with ``surplus`` rows on the source side.

    Goes down from the bucketed checksum: only buckets whose checksums differ are looked into, on both sides. Names of
    buckets are two hex digits, so there are 256 at most. A lost key has a positive surplus, a doubled one a negative
    surplus, and a changed key shows twice: as it was and as it arrived. Keys are given as text.
    """
    entity = result.entity
    run = Migration(result.source.sparkSession, "", {entity.name: result})
    failed = key_checksums(run, per_bucket=True).where("NOT passed").select("bucket").collect()
    inside = digest_bucket(F.col("digest")).isin([r["bucket"] for r in failed])
    extracted = [entity.field(k).key_text().alias(k) for k in entity.key_target]
    arrived = [
        F.when(F.col(STATUS) == LOADED, col(k).cast("string"))
        .otherwise(entity.field(k).key_text(_quarantined(entity.field(k))))
        .alias(k)
        for k in entity.key_target
    ]
    source = result.source.withColumn("digest", _source_digest(entity)).where(inside).select(*extracted)
    target = result.classified.withColumn("digest", _target_digest(entity)).where(inside).select(*arrived)
    return differing_keys(source, target)


def amount_by_currency(result: EntityResult, amount: str = "Amount") -> DataFrame:
    """Source amount per currency against loaded plus rejected amount, over all currencies seen.

    An amount that cannot be read has no value on either side. Such rows are counted on both, and a
    currency that has any does not pass: its totals prove nothing about them.
    """
    entity, loaded = result.entity, F.col(STATUS) == LOADED
    numbers = ("source_unreadable", "rejected_unreadable")
    money, currency = entity.field(amount), entity.currency_field()

    def per_currency(rows: DataFrame, code: Column, sums: dict[str, Column]) -> DataFrame:
        named = F.when(code == "", LOCAL).otherwise(code).alias("currency")
        found = rows.groupBy(named).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
        zero = {n: F.lit(0).cast("bigint" if n in numbers else "decimal(28,2)") for n in all_sums}
        return found.select(
            "currency",
            *[F.coalesce(F.col(n) if n in sums else zero[n], zero[n]).alias(n) for n in all_sums],
        )

    all_sums = ("source_amount", "loaded_amount", "rejected_amount", *numbers)

    source = per_currency(
        result.source,
        currency.value(),
        {
            "source_amount": money.value().cast(MONEY),
            "source_unreadable": money.is_bad_number().cast("bigint"),
        },
    )
    target = per_currency(
        result.classified,
        F.when(loaded, col(currency.target)).otherwise(currency.value(_quarantined(currency))),
        {
            "loaded_amount": F.when(loaded, col(amount).cast(MONEY)),
            "rejected_amount": F.when(~loaded, money.value(_quarantined(money)).cast(MONEY)),
            "rejected_unreadable": F.when(
                ~loaded, money.is_bad_number(_quarantined(money)).cast("bigint")
            ),
        },
    )
    return (
        source.unionByName(target)
        .groupBy("currency")
        .agg(*[F.sum(n).alias(n) for n in source.columns if n != "currency"])
        .select(F.lit(entity.name).alias("entity"), "*")
        .withColumn(
            "passed",
            within(
                F.col("source_amount"),
                F.col("loaded_amount") + F.col("rejected_amount"),
                TOLERANCE,
                strict=True,
            )
            & (F.col("source_unreadable") == 0)
            & (F.col("rejected_unreadable") == 0),
        )
    )


def account_totals(
    result: EntityResult,
    amount: str = "Amount (LCY)",
    accounts: Sequence[str] | None = None,
) -> DataFrame:
    """Total per account in the extract and in the loaded rows; an account on one side fails."""
    entity, account = result.entity, result.entity.key_target[0]
    source = result.source.select(
        entity.field(account).value().alias("account"),
        entity.field(amount).value().alias("amount"),
    )
    loaded = result.loaded.select(col(account).alias("account"), col(amount).alias("amount"))
    sides = {"source_amount": source, "loaded_amount": loaded}
    if accounts is not None:
        wanted = F.col("account").isin(list(accounts))
        sides = {side: rows.filter(wanted) for side, rows in sides.items()}
    return (
        totals_by_side(sides, ["account"], "amount")
        .select(F.lit(entity.name).alias("entity"), "*")
        .withColumn(
            "passed", F.coalesce(F.col("source_amount") == F.col("loaded_amount"), F.lit(False))
        )
    )


def _net(totals: DataFrame, entity: str) -> DataFrame:
    zero = F.lit(0).cast(MONEY)
    return totals.agg(
        F.coalesce(F.sum("source_amount"), zero).alias("source_net"),
        F.coalesce(F.sum("loaded_amount"), zero).alias("loaded_net"),
        F.count(F.lit(1)).alias("n_seen"),
        F.count("source_amount").alias("n_accounts"),
        F.count_if("passed").alias("n_match"),
        F.coalesce(F.bool_and("passed"), F.lit(False)).alias("accounts_match"),
    ).select(
        F.lit(entity).alias("entity"),
        "*",
        (within(F.col("loaded_net"), zero, TOLERANCE, strict=True) & (F.col("n_seen") > 0)).alias("nets_to_zero"),
    )


def trial_balance(
    result: EntityResult,
    amount: str = "Amount (LCY)",
    accounts: Sequence[str] | None = None,
) -> DataFrame:
    """Net of the extract and of the loaded rows; the loaded net must be zero.

    ``accounts`` restricts the check, e.g. to the suspense account of the cut-over. A balance of no
    account at all, or of one that neither side has, does not pass.
    """
    net = _net(account_totals(result, amount, accounts), result.entity.name)
    enough = F.col("n_seen") >= (1 if accounts is None else len(set(accounts)))
    return net.select(
        "entity", "source_net", "loaded_net", (F.col("nets_to_zero") & enough).alias("passed")
    )


def _whole(c: str) -> Column:
    return F.format_number(F.col(c), 0)


def _money(c: str) -> Column:
    return F.format_number(F.col(c), 2)


def _line(check: Column | str, source: Column, target: Column, passed: Column) -> Column:
    title = F.lit(check) if isinstance(check, str) else check
    return F.struct(
        F.col("entity"),
        title.alias("check"),
        source.alias("source"),
        target.alias("target"),
        passed.alias("passed"),
    )


def _lines(rows: DataFrame, *lines: Column) -> DataFrame:
    return rows.select(F.explode(F.array_compact(F.array(*lines))).alias("line")).select("line.*")


#: What a row of the grouped pass is about: the whole entity, one currency, or one account.
_WHOLE, _CURRENCY, _ACCOUNT = "entity", "currency", "account"
_COUNTS = ("source_rows", "loaded_rows", "rejected_rows", "source_unreadable", "rejected_unreadable", "seen")
_SUMS = ("source_checksum", "target_checksum", "source_amount", "loaded_amount", "rejected_amount")


def _side_pass(result: EntityResult, kind: str, amount: str | None) -> list[DataFrame]:
    """Both sides of an entity, each scanned once and grouped by ``kind``: counts, checksum and amounts."""
    entity, loaded = result.entity, F.col(STATUS) == LOADED
    item = {"source": F.lit(None).cast("string"), "target": F.lit(None).cast("string")}
    if kind == _CURRENCY:
        field = entity.currency_field()
        codes = {
            "source": field.value(),
            "target": F.when(loaded, col(field.target)).otherwise(field.value(_quarantined(field))),
        }
        item = {side: F.when(code == "", LOCAL).otherwise(code) for side, code in codes.items()}
    elif kind == _ACCOUNT:
        field = entity.field(entity.key_target[0])
        item = {
            "source": field.value(),
            "target": F.when(loaded, col(field.target)).otherwise(field.value(_quarantined(field))),
        }
    one = F.lit(1).cast("bigint")
    rows = {
        "source": {"source_rows": one, "seen": one},
        "target": {"loaded_rows": F.when(loaded, one), "rejected_rows": F.when(~loaded, one), "seen": one},
    }
    if amount is not None:
        money = entity.field(amount)
        rejected = _quarantined(money)
        rows["source"]["source_amount"] = money.value().cast(MONEY)
        rows["target"]["loaded_amount"] = F.when(loaded, col(amount).cast(MONEY))
        rows["target"]["rejected_amount"] = F.when(~loaded, money.value(rejected).cast(MONEY))
        rows["source"]["source_unreadable"] = money.is_bad_number().cast("bigint")
        rows["target"]["rejected_unreadable"] = F.when(~loaded, money.is_bad_number(rejected).cast("bigint"))
    digests = {"source": _source_digest(entity), "target": _target_digest(entity)}
    tables = {"source": result.source, "target": result.classified}
    kinds = [_WHOLE] if kind == _WHOLE else [_WHOLE, kind]
    sides = []
    for side, df in tables.items():
        grouped = (
            df.withColumn("digest", digests[side])
            .groupBy(item[side].alias("item"))
            .agg(
                digest_sum(F.col("digest")).alias(f"{side}_checksum"),
                *[F.sum(v).alias(n) for n, v in rows[side].items()],
            )
        )
        sides.append(
            grouped.select(
                F.lit(entity.name).alias("entity"), F.explode(F.array(*map(F.lit, kinds))).alias("kind"), "*"
            )
        )
    return sides


def check_totals(
    run: Migration, invoices: str = "open_invoice", ledger: str = "gl_opening_balance"
) -> DataFrame:
    """Everything that :func:`check_rows` compares, from one scan of each side of each entity.

    A side is grouped once, by the finest item that is checked in it (currency, account or nothing). Each group counts
    for its item and for the entity; the sums of both sides meet in one small group-by.
    """
    grouped = {}
    if invoices in run.results:
        grouped[invoices] = (_CURRENCY, "Amount")
    if ledger in run.results:
        grouped[ledger] = (_ACCOUNT, "Amount (LCY)")
    sides = []
    for name, result in run.results.items():
        sides += _side_pass(result, *grouped.get(name, (_WHOLE, None)))
    # an entity without a row, or a ledger without an account, is checked too
    seeds = [(name, _WHOLE) for name in run.results]
    seeds += [(ledger, _ACCOUNT)] if ledger in run.results else []
    sides.append(run.spark.createDataFrame(seeds, "entity string, kind string").withColumn("item", F.lit(None).cast("string")))
    merged = union_all(sides, partial_columns=True)
    types = {c: "bigint" if c in _COUNTS else "decimal(28,2)" if "amount" in c else "decimal(28,0)" for c in (*_COUNTS, *_SUMS)}
    present = [F.col(c) if c in merged.columns else F.lit(None).cast(types[c]).alias(c) for c in types]
    merged = merged.select("entity", "kind", "item", *present)
    items = merged.groupBy("entity", "kind", "item").agg(*[F.sum(c).cast(types[c]).alias(c) for c in types])
    same = F.coalesce(F.col("source_amount") == F.col("loaded_amount"), F.lit(False))
    seen = F.coalesce("seen", F.lit(0)) > 0
    shown = F.when(F.col("kind") == _CURRENCY, F.col("item")).alias("item")
    zero = {c: F.lit(0).cast(t) for c, t in types.items()}
    totals = items.groupBy("entity", "kind", shown).agg(
        *[F.coalesce(F.sum(c), zero[c]).alias(c) for c in types],
        F.count_if(seen).alias("n_seen"),
        F.count("source_amount").alias("n_items"),
        F.count_if(seen & same).alias("n_match"),
    )
    counted = [F.when(F.col("entity") == n, F.lit(r.counted).cast("bigint")) for n, r in run.results.items() if r.counted is not None]
    return totals.withColumn("source_rows", F.coalesce(*counted, F.col("source_rows")))


def check_rows(
    run: Migration, invoices: str = "open_invoice", ledger: str = "gl_opening_balance"
) -> DataFrame:
    """All checks of a run as ``entity, check, source, target, passed``."""
    target_keys_text = (F.col("loaded_rows") + F.col("rejected_rows")).cast("string")
    kind = F.col("kind")
    zero = F.lit(0).cast(MONEY)
    amounts_agree = within(
        F.col("source_amount"), F.col("loaded_amount") + F.col("rejected_amount"), TOLERANCE, strict=True
    )
    readable = (F.col("source_unreadable") == 0) & (F.col("rejected_unreadable") == 0)
    seen = F.col("n_seen") > 0
    lines = {
        _WHOLE: [
            _line(
                ROW_ACCOUNTING,
                _whole("source_rows"),
                F.concat_ws(" + ", _whole("loaded_rows"), _whole("rejected_rows")),
                _rows_accounted(),
            ),
            _line(
                KEY_CHECKSUM,
                F.concat_ws(":", "source_rows", "source_checksum"),
                F.concat_ws(":", target_keys_text, "target_checksum"),
                _rows_accounted() & (F.col("source_checksum") == F.col("target_checksum")),
            ),
        ],
        _CURRENCY: [
            _line(
                F.concat(F.lit("amount total "), F.col("item"), F.lit(" (loaded + rejected)")),
                _money("source_amount"),
                F.concat_ws(" + ", _money("loaded_amount"), _money("rejected_amount")),
                amounts_agree & readable,
            )
        ],
        _ACCOUNT: [
            _line(
                ACCOUNT_TOTALS,
                F.concat_ws(" ", F.col("n_items").cast("string"), F.lit("accounts")),
                F.concat_ws(" ", F.col("n_match").cast("string"), F.lit("match")),
                seen & (F.col("n_match") == F.col("n_seen")),
            ),
            _line(
                TRIAL_BALANCE,
                _money("source_amount"),
                _money("loaded_amount"),
                seen & within(F.col("loaded_amount"), zero, TOLERANCE, strict=True),
            ),
        ],
    }
    found = [F.when(kind == k, line) for k, ls in lines.items() for line in ls]
    return _lines(check_totals(run, invoices, ledger), *found)


def summary(checks: DataFrame) -> DataFrame:
    """One row: how many checks ran, how many passed, and whether any ran and all of them did."""
    return checks.agg(
        F.count_if("passed").alias("passed"),
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.bool_and(F.coalesce("passed", F.lit(False))), F.lit(False)).alias("all_passed"),
    )


def gate(checks: DataFrame, allow_empty: bool = False, examples: int = 100) -> None:
    """Raise :class:`CheckFailed` if a check failed or none ran, so that a job ends with an error.

    The error names all failures by their number and the first ``examples`` in full.
    """
    failing = ~F.coalesce("passed", F.lit(False))
    ran, failed = checks.agg(F.count(F.lit(1)), F.count_if(failing)).first()
    if not ran and not allow_empty:
        raise CheckFailed("no check ran")
    if failed:
        rows = checks.filter(failing).limit(examples).collect()
        shown = "; ".join(str(row.asDict()) for row in rows)
        raise CheckFailed(f"{failed} of {ran} checks failed: {shown}")


def reject_summary(run: Migration) -> DataFrame:
    """Rejected rows per entity and reason."""
    parts = [
        r.classified.filter(F.col(STATUS) != LOADED).select(F.lit(name).alias("entity"), REASON)
        for name, r in run.results.items()
    ]
    return union_all(parts).groupBy("entity", REASON).agg(F.count(F.lit(1)).alias("rows"))


def reject_value(result: EntityResult, amount: str = "Amount") -> DataFrame:
    """Rejected rows and their value per reason, for the data owner's signature.

    ``unreadable`` counts the rows whose amount has no value because it is no number.
    """
    rejects = result.classified.filter(F.col(STATUS) != LOADED)
    money = result.entity.field(amount)
    return rejects.groupBy(REASON).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(col(amount)).alias("amount"),
        F.count_if(money.is_bad_number(_quarantined(money))).alias("unreadable"),
    )


def audit_sample(result: EntityResult, size: int = 25) -> DataFrame:
    """Repeatable random sample of loaded records: the ``size`` smallest key digests."""
    digest = key_digest([col(k) for k in result.entity.key_target])
    return result.loaded.orderBy(digest).limit(size)
