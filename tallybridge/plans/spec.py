"""Mapping specs: loading, validation and compilation to column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

import yaml
from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybridge.functions.rules import apply_rules, rule

# Source fields that hold numbers although no rule says so, rules that need a
# number as input, and the source fields whose gaps are reported as a warning.
NUMERIC_FIELDS = frozenset({"BLOCKED", "RECID"})
NUMERIC_RULES = frozenset({"to_decimal", "map_blocked"})
CURRENCY_FIELDS = ("CURRENCY", "CURRENCYCODE")

DEFAULT_SPEC = Path(__file__).with_name("entities.yaml")


def quoted(name: str) -> str:
    """Column reference for names that contain dots, brackets, dashes or dollar signs."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def _as_list(value) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


@dataclass(frozen=True)
class Field:
    target: str
    source: str
    rules: tuple[str, ...]

    @property
    def is_number(self) -> bool:
        return self.source in NUMERIC_FIELDS or any(r in NUMERIC_RULES for r in self.rules)

    def value(self, raw: Column | None = None) -> Column:
        """Cleansed value of the field; ``raw`` says where its source column is, if elsewhere."""
        raw = col(self.source) if raw is None else raw
        if self.is_number and not self.rules:
            return raw.try_cast("bigint")
        return apply_rules(raw, self.rules)

    def is_bad_number(self, raw: Column | None = None) -> Column:
        """True where the source holds text, blanks included, that is no (storable) number."""
        raw = col(self.source) if raw is None else raw
        stored = not self.rules or "to_decimal" in self.rules
        number = self.value(raw) if stored else raw.try_cast("double")
        text = raw.cast("string")
        return text.isNotNull() & (text != "") & number.isNull()

    def key_text(self, raw: Column | None = None) -> Column:
        """Cleansed value as text; where no number can be read, the text as extracted."""
        raw = col(self.source) if raw is None else raw
        return F.coalesce(self.value(raw).cast("string"), raw.cast("string"))


@dataclass(frozen=True)
class Entity:
    name: str
    source: str
    target: str
    key_source: tuple[str, ...]
    key_target: tuple[str, ...]
    dedupe_on: tuple[str, ...]
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    foreign_keys: tuple[tuple[str, str], ...]

    def field(self, target: str) -> Field:
        for f in self.fields:
            if f.target == target:
                return f
        raise KeyError(f"{self.name}: no field is mapped to {target!r}")

    def mapped(self, *targets: str) -> list[Column]:
        """Projection of the mapped fields (all, or the named ones)."""
        return [self.field(t).value().alias(t) for t in targets or [f.target for f in self.fields]]

    def key_from_source(self) -> list[Column]:
        """The business key as it should arrive in the target, computed on source rows."""
        return [self.field(t).value().alias(t) for t in self.key_target]

    def bad_numbers(self, raw: Mapping[str, Column] | None = None) -> list[tuple[str, Column]]:
        """Numeric target fields with a test for text that is no number, in the order of the spec."""
        return [
            (f.target, f.is_bad_number(None if raw is None else raw[f.source]))
            for f in self.fields
            if f.is_number
        ]

    def currency_field(self) -> Field | None:
        return next((f for f in self.fields if f.source in CURRENCY_FIELDS), None)


def _entity(name: str, raw: Mapping) -> Entity:
    fields = tuple(
        Field(target, f["from"], tuple(f.get("rules", ()))) for target, f in raw["fields"].items()
    )
    return Entity(
        name=name,
        source=raw["source"],
        target=raw.get("target", name),
        key_source=tuple(_as_list(raw["key"]["source"])),
        key_target=tuple(_as_list(raw["key"]["target"])),
        dedupe_on=tuple(raw.get("dedupe_on", ())),
        fields=fields,
        required=tuple(raw.get("required", ())),
        foreign_keys=tuple(raw.get("foreign_keys", {}).items()),
    )


def load_spec(path: str | Path = DEFAULT_SPEC) -> dict[str, Entity]:
    """Read a mapping spec; entities come back parents first."""
    return parse_spec(yaml.safe_load(Path(path).read_text(encoding="utf-8")))


def parse_spec(raw: Mapping) -> dict[str, Entity]:
    entities = {name: _entity(name, block) for name, block in raw.items()}
    for e in entities.values():
        _check_names(e, entities)
    return {name: entities[name] for name in _parents_first(entities)}


def _check_names(e: Entity, entities: Mapping[str, Entity]) -> None:
    targets = {f.target for f in e.fields}
    for f in e.fields:
        for name in f.rules:
            rule(name)
    for what, names in (
        ("key", e.key_target),
        ("dedupe_on", e.dedupe_on),
        ("required", e.required),
        ("foreign_keys", [child for child, _ in e.foreign_keys]),
    ):
        for name in names:
            if name not in targets:
                raise KeyError(f"{e.name}.{what}: {name!r} is not a mapped field")
    for child, parent in e.foreign_keys:
        if parent not in entities:
            raise KeyError(f"{e.name}.foreign_keys: unknown entity {parent!r}")
        if len(entities[parent].key_target) != 1:
            raise ValueError(f"{e.name}.foreign_keys: {parent!r} has a composite key")


def _parents_first(entities: Mapping[str, Entity]) -> list[str]:
    done: list[str] = []
    waiting = list(entities)
    while waiting:
        ready = [
            n for n in waiting
            if all(parent in done for _, parent in entities[n].foreign_keys)
        ]
        if not ready:
            raise ValueError(f"entities refer to each other in a circle: {waiting}")
        done.append(ready[0])
        waiting.remove(ready[0])
    return done


def check_source(e: Entity, columns: Sequence[str]) -> None:
    """Fail while the plan is built if the extract lacks a mapped column."""
    missing = [f.source for f in e.fields if f.source not in columns]
    missing += [c for c in e.key_source if c not in columns and c not in missing]
    if missing:
        raise KeyError(f"{e.name}: extract {e.source} has no column {missing}")
