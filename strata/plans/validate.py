"""Validate: build every definition and resolve it, run nothing.

Definitions are functions from a reader to a DataFrame, in dependency order. A
definition reads earlier definitions through the reader, which hands out their
(lazy, unexecuted) plans, so missing inputs and missing columns surface as
analysis errors without a Spark job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.quality import Expectation


@dataclass
class Definition:
    name: str
    build: Callable[["Reader"], DataFrame]
    expectations: list[Expectation] = field(default_factory=list)


class MissingDataset(KeyError):
    pass


class Reader:
    def __init__(self, sources: dict[str, DataFrame]):
        self.plans = dict(sources)

    def read(self, name: str) -> DataFrame:
        if name not in self.plans:
            raise MissingDataset(f"dataset '{name}' is not defined before it is read")
        return self.plans[name]


def validate(spark: SparkSession, definitions: list[Definition], sources: dict[str, DataFrame]) -> DataFrame:
    """One row per dataset and check: ``(dataset, check, status, message)``."""
    reader = Reader(sources)
    rows = []
    for d in definitions:
        try:
            df = d.build(reader)
            df.schema  # analysis only
            reader.plans[d.name] = df
            rows.append((d.name, "definition", "OK", ""))
        except (AnalysisException, MissingDataset) as e:
            rows.append((d.name, "definition", "FAILED", str(e)))
            continue
        for e in d.expectations:
            try:
                t = df.select(e.column().alias("v")).schema["v"].dataType.simpleString()
                ok = t == "boolean"
                rows.append((d.name, f"expectation:{e.name}", "OK" if ok else "FAILED",
                             "" if ok else f"not a boolean rule: {t}"))
            except AnalysisException as x:
                rows.append((d.name, f"expectation:{e.name}", "FAILED", str(x)))
    return spark.createDataFrame(rows, "dataset string, check string, status string, message string")


def rule_counts(definitions: list[Definition], sources: dict[str, DataFrame]) -> DataFrame:
    """Rows that pass and fail each rule of each definition that resolves: ``(dataset,
    expectation, passed, failed)``, one aggregate a dataset. A NULL verdict is a failure;
    definitions and rules that do not resolve are left to ``validate``."""
    reader, out = Reader(sources), None
    for d in definitions:
        try:
            df = d.build(reader)
            df.schema  # analysis only
        except (AnalysisException, MissingDataset):
            continue
        reader.plans[d.name] = df
        rules = []
        for e in d.expectations:
            try:
                df.select(e.column()).schema  # noqa: B018
                rules.append(e)
            except AnalysisException:
                continue
        if not rules:
            continue
        held = [F.count_if(F.coalesce(e.column(), F.lit(False))).alias(f"p{k}") for k, e in enumerate(rules)]
        one = df.agg(F.count(F.lit(1)).alias("n"), *held)
        each = F.explode(F.array(*[F.struct(F.lit(e.name).alias("expectation"), F.col(f"p{k}").alias("passed")) for k, e in enumerate(rules)]))
        one = one.select("n", each.alias("r")).select(F.lit(d.name).alias("dataset"), "r.expectation", "r.passed", (F.col("n") - F.col("r.passed")).alias("failed"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no rule resolves")
    return out


def failures(report: DataFrame) -> DataFrame:
    return report.where(F.col("status") != "OK")
