"""Expectations: named row rules with an action (warn, drop, fail), plus key checks.

All rules of a dataset are counted in one ``observe`` over the input, so checking
costs no extra pass. A rule whose predicate is NULL counts as violated, which makes
drop and quarantine exact complements.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str  # SQL boolean expression over the dataset's columns
    action: str = WARN

    def __post_init__(self):
        if self.action not in (WARN, DROP, FAIL):
            raise ValueError(f"unknown action {self.action!r} for expectation {self.name!r}")

    def column(self) -> Column:
        return F.expr(self.condition)

    def holds(self) -> Column:
        """True only where the predicate is TRUE; NULL is a violation."""
        return F.coalesce(self.column(), F.lit(False))


def expect(name: str, condition: str) -> Expectation:
    return Expectation(name, condition, WARN)


def expect_or_drop(name: str, condition: str) -> Expectation:
    return Expectation(name, condition, DROP)


def expect_or_fail(name: str, condition: str) -> Expectation:
    return Expectation(name, condition, FAIL)


def _metric_name(name: str) -> str:
    return "failed_" + re.sub(r"\W", "_", name)


def metric_columns(rules) -> list[Column]:
    cols = [F.count(F.lit(1)).alias("rows")]
    cols += [F.count_if(~r.holds()).alias(_metric_name(r.name)) for r in rules]
    return cols


def enforce(df: DataFrame, rules, dataset: str, observe: Observation | str | None = None) -> DataFrame:
    """Apply ``rules`` to ``df``: count every rule (before any row is dropped), stop on a
    failing FAIL rule, remove rows failing a DROP rule. Works on batch and streaming frames."""
    rules = list(rules)
    if not rules:
        return df
    if observe is not None:
        df = df.observe(observe, *metric_columns(rules))
    for r in rules:
        if r.action == FAIL:
            msg = f"expectation '{r.name}' on dataset '{dataset}' violated: {r.condition}"
            # used by the filter, so it cannot be pruned away
            df = df.where(F.when(~r.holds(), F.raise_error(F.lit(msg))).otherwise(F.lit(True)))
    drops = [r.holds() for r in rules if r.action == DROP]
    if drops:
        cond = drops[0]
        for c in drops[1:]:
            cond = cond & c
        df = df.where(cond)
    return df


def quarantine(df: DataFrame, rules) -> DataFrame:
    """Rows that fail at least one of ``rules``: the complement of dropping on them."""
    rules = list(rules)
    ok = rules[0].holds()
    for r in rules[1:]:
        ok = ok & r.holds()
    return df.where(~ok)


def expectation_report(metrics: dict, rules, dataset: str) -> list[dict]:
    """Observed counts → ``[{name, dataset, passed_records, failed_records}]``."""
    total = int(metrics.get("rows", 0) or 0)
    out = []
    for r in rules:
        failed = int(metrics.get(_metric_name(r.name), 0) or 0)
        out.append({"name": r.name, "dataset": dataset, "passed_records": total - failed,
                    "failed_records": failed})
    return out


def rule_counts(df: DataFrame, rules) -> DataFrame:
    """The same counts as a plain aggregate (one pass, partial aggregation)."""
    rules = list(rules)
    agg = df.agg(*metric_columns(rules))
    parts = [F.struct(F.lit(r.name).alias("expectation"),
                      (F.col("rows") - F.col(_metric_name(r.name))).alias("passed_records"),
                      F.col(_metric_name(r.name)).alias("failed_records")) for r in rules]
    return agg.select(F.explode(F.array(*parts)).alias("m")).select("m.*")


def key_counts(df: DataFrame, keys) -> DataFrame:
    """Occurrences per key, ``count(key)`` semantics (a NULL key counts 0)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.col(keys[0]) if len(keys) == 1
                                         else F.struct(*keys)).alias("num_rows"))


def duplicate_keys(df: DataFrame, keys, count_name: str = "num_rows") -> DataFrame:
    """Keys that occur other than once. Partial aggregation map-side, so a hot key
    sends one row per task to the shuffle."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*keys).agg(F.count(F.col(keys[0])).alias(count_name))
            .where(F.col(count_name) != 1))
