"""Declarative data contracts, checked in one pass over the table.

A rule is a name, the column it speaks of and a condition:

* ``row``   - a boolean column, true where a row breaks the rule. Null means the
  rule does not apply.
* ``batch`` - a boolean aggregate, true when the whole batch is sound.
* ``key``   - the columns that must identify a row.

All row and batch rules of a contract share one aggregate over one scan. Only a
key rule shuffles, on its key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa import spec as S
from brisa.functions.values import coerce_numeric, lost_in_cast, nan_as_null


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    scope: str  # row | batch | key, or rows for a plain row count
    condition: Column | None = None
    key: tuple[str, ...] = ()


class ContractViolation(ValueError):
    """A table breaks its contract; carries the broken rules."""

    def __init__(self, broken: list[dict]):
        self.broken = broken
        names = ", ".join(f"{b['rule']}({b['column']}): {b['violations']}" for b in broken)
        super().__init__(f"{len(broken)} rules broken: {names}")


# --- rules -------------------------------------------------------------------


def row_rule(name: str, column: str, broken: Column) -> Rule:
    return Rule(name, column, "row", broken)


def batch_rule(name: str, column: str, sound: Column) -> Rule:
    return Rule(name, column, "batch", sound)


def unique_key(key: Sequence[str], name: str = "unique_key") -> Rule:
    return Rule(name, ",".join(key), "key", key=tuple(key))


def within(column: str, low: float, high: float) -> Rule:
    return row_rule("range", column, ~F.col(column).between(low, high))


def member(column: str, levels: Sequence[str]) -> Rule:
    return row_rule("member", column, ~F.col(column).isin(*levels))


def not_null(column: str) -> Rule:
    return row_rule("not_null", column, F.col(column).isNull())


def not_after(column: str, as_of: str | None) -> Rule:
    """No event time beyond ``as_of`` (default: now, fixed when the rule is made)."""
    moment = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    return row_rule("not_in_future", column, F.col(column) > F.lit(moment).cast("timestamp_ntz"))


def not_above(name: str, low: str, high: str, flags: bool) -> Rule:
    """``low`` never exceeds ``high``; filled values do not count."""
    broken = F.col(high) < F.col(low)
    if flags:
        broken = broken & (F.col(f"{high}_era_nulo") == 0) & (F.col(f"{low}_era_nulo") == 0)
    return row_rule(name, f"{high},{low}", broken)


def _ordered(spec: S.ReadingSpec, flags: bool) -> list[Rule]:
    return [not_above(n, a, b, flags) for n, a, b in spec.ordered if {a, b} <= set(spec.measures)]


def min_volume(rows: int = S.MIN_ROWS) -> Rule:
    return batch_rule("min_volume", "*", F.count(F.lit(1)) >= rows)


def coverage(column: str, share: float = S.MIN_COVERAGE) -> Rule:
    return batch_rule("coverage", column, F.avg(F.col(column).isNotNull().cast("double")) >= share)


def varies(column: str) -> Rule:
    """More than one distinct value; min and max tell without a distinct."""
    return batch_rule("varies", column, F.min(column) != F.max(column))


def raw_contract(spec: S.ReadingSpec = S.READINGS, as_of: str | None = None) -> list[Rule]:
    """What readings must satisfy as they arrive."""
    members = [member(c, spec.levels[c]) for c in spec.categoricals if c in spec.levels]
    covered = [c for c in spec.limits if c in S.POLLUTANTS]
    return [
        not_null(spec.time),
        not_null(spec.entity),
        *members,
        *[within(c, *spec.limits[c]) for c in spec.limits],
        *_ordered(spec, False),
        not_after(spec.time, as_of),
        min_volume(),
        *[coverage(c) for c in covered],
        varies(spec.target),
        unique_key(spec.key, "one_reading_per_key"),
    ]


def processed_contract(spec: S.ReadingSpec = S.READINGS) -> list[Rule]:
    """What prepared rows must satisfy before a model sees them."""
    limits = {**{c: spec.limits[c] for c in spec.measures if c in spec.limits}, **S.CALENDAR_LIMITS}
    if spec.target in spec.limits:
        limits[spec.target] = spec.limits[spec.target]
    members = [member(c, (*spec.levels[c], S.UNKNOWN)) for c in spec.categoricals if c in spec.levels]
    return [
        *[not_null(c) for c in (*spec.features, spec.target)],
        *members,
        member(S.SEASON, S.SEASONS),
        *[within(c, low, high) for c, (low, high) in limits.items()],
        *_ordered(spec, True),
        varies(spec.target),
    ]


# --- evaluation --------------------------------------------------------------


def report(
    df: DataFrame, rules: list[Rule], by: list[str] = (), sample_of: str | None = None
) -> DataFrame:
    """One row per rule (and group): rule, column, scope, violations.

    Violations are offending rows; for a batch rule 0 or 1; for a key the rows
    beyond the first of their key. NaN counts as null. ``sample_of`` adds the smallest value of that
    column among the offending rows.
    """
    by = list(by)
    df = nan_as_null(df)
    one_pass = [r for r in rules if r.scope != "key"]
    parts = []
    if one_pass:
        parts.append(_one_pass(df, one_pass, by, sample_of))
    for rule in rules:
        if rule.scope == "key":
            parts.append(_key_rule(df, rule, by, sample_of))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _one_pass(df: DataFrame, rules: list[Rule], by: list[str], sample_of: str | None) -> DataFrame:
    aggregates, cells = [], []
    for i, r in enumerate(rules):
        if r.scope == "row":
            aggregates.append(F.count_if(r.condition).alias(f"n{i}"))
        elif r.scope == "rows":
            aggregates.append(r.condition.alias(f"n{i}"))
        else:
            sound = F.coalesce(r.condition, F.lit(False))
            aggregates.append(F.when(sound, 0).otherwise(1).cast("bigint").alias(f"n{i}"))
        cell = [
            F.lit(r.name).alias("rule"),
            F.lit(r.column).alias("column"),
            F.lit(r.scope).alias("scope"),
            F.col(f"n{i}").alias("violations"),
        ]
        if sample_of:
            example = F.lit(None).cast("string")
            if r.scope == "row":
                aggregates.append(
                    F.min(F.when(r.condition, F.col(sample_of))).cast("string").alias(f"s{i}")
                )
                example = F.col(f"s{i}")
            cell.append(example.alias("sample"))
        cells.append(F.struct(*cell))
    grouped = df.groupBy(*by).agg(*aggregates)
    return grouped.select(*by, F.inline(F.array(*cells)))


def _key_rule(df: DataFrame, rule: Rule, by: list[str], sample_of: str | None) -> DataFrame:
    keyed = df.groupBy(*by, *[k for k in rule.key if k not in by])
    counts = [F.count(F.lit(1)).alias("__n")]
    if sample_of:
        counts.append(F.min(F.col(sample_of)).alias("__s"))
    per_key = keyed.agg(*counts)
    totals = [F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("violations")]
    if sample_of:
        totals.append(
            F.min(F.when(F.col("__n") > 1, F.col("__s"))).cast("string").alias("sample")
        )
    return per_key.groupBy(*by).agg(*totals).select(
        *by,
        F.lit(rule.name).alias("rule"),
        F.lit(rule.column).alias("column"),
        F.lit(rule.scope).alias("scope"),
        "violations",
        *(["sample"] if sample_of else []),
    )


def broken_rules(df: DataFrame, rules: list[Rule], lazy: bool = True) -> list[dict]:
    """Broken rules as plain records.

    ``lazy`` collects all of them. Otherwise the first one found ends the check:
    row rules stop at the first offending row.
    """
    if lazy:
        broken = report(df, rules).filter(F.col("violations") > 0)
        return [r.asDict() for r in broken.collect()]
    rows = [r for r in rules if r.scope == "row"]
    df = nan_as_null(df)
    if rows:
        name = F.coalesce(
            *[F.when(r.condition, F.lit(i)) for i, r in enumerate(rows)]
        )
        hit = df.select(name.alias("i")).filter(F.col("i").isNotNull()).limit(1).collect()
        if hit:
            r = rows[hit[0]["i"]]
            return [{"rule": r.name, "column": r.column, "scope": r.scope, "violations": 1}]
    rest = [r for r in rules if r.scope != "row"]
    return broken_rules(df, rest)[:1] if rest else []


def enforce(df: DataFrame, rules: list[Rule], lazy: bool = True) -> DataFrame:
    """The table itself, or ContractViolation."""
    broken = broken_rules(df, rules, lazy)
    if broken:
        raise ContractViolation(broken)
    return df


def by_partition(df: DataFrame, rules: list[Rule], label: str = "particion") -> DataFrame:
    """The contract of every partition in one pass, with the rows of each."""
    rows = Rule("rows", "*", "rows", F.count(F.lit(1)))
    return report(df, [rows, *rules], by=[label])


def enforce_by(
    df: DataFrame, rules: list[Rule], label: str, expected: list[str]
) -> DataFrame:
    """Hold every labelled group to the contract; a group without rows breaks it too."""
    found = by_partition(df, rules, label).collect()  # one row per rule and label
    broken = [r.asDict() for r in found if r["scope"] != "rows" and r["violations"] > 0]
    for missing in sorted(set(expected) - {r[label] for r in found}):
        empty = {"rule": "min_volume", "column": "*", "scope": "batch", "violations": 1}
        broken.append({label: missing, **empty})
    if broken:
        raise ContractViolation(broken)
    return df


def coercion_contract(spec: S.ReadingSpec = S.READINGS) -> list[Rule]:
    """Values that are present but do not cast: checked on the text, before casting."""
    lost = F.col(spec.time).isNotNull() & F.col(spec.time).try_cast("timestamp_ntz").isNull()
    numbers = (*spec.measures, spec.target)
    return [
        row_rule("coerce", spec.time, lost),
        *[row_rule("coerce", c, lost_in_cast(F.col(c))) for c in numbers],
    ]


def coerce_readings(df: DataFrame, spec: S.ReadingSpec = S.READINGS) -> DataFrame:
    """Cast time and numbers to their types; what does not cast becomes null."""
    typed = coerce_numeric(df, (*spec.measures, spec.target))
    return typed.withColumn(spec.time, F.col(spec.time).try_cast("timestamp_ntz"))


def contract_columns(spec: S.ReadingSpec = S.READINGS) -> dict[str, list[str]]:
    """The contract as data: which columns play which part."""
    return {
        "required": list(spec.required),
        "categorical_features": list(spec.categorical_features),
        "numeric_features": list(spec.numeric_features),
        "target": [spec.target],
    }
