"""Aggregates kept as mergeable partials.

A measure is stored as the few numbers (or the sketch) from which it can be put together
with others of its kind: partials of batches make the whole, those of hours make days, and
nobody reads the rows again. Measures that can be taken back (counts, totals, means) also
take signed rows, so that updates and deletes of a source subtract what they replace.

``PartialStore`` keeps the partials of one table, a folder a batch, each published by one
rename; many small folders are folded into one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fs import children, delete, exists, move

ROWS = "_rows"  # signed number of rows of a group, in every partial


class Measure(NamedTuple):
    """``kind`` of ``column`` (a SQL expression): ``count`` (of its values; without a column of
    rows), ``total``, ``mean``, ``least``, ``most``, ``distinct`` (a HyperLogLog sketch),
    ``quantile`` (a KLL sketch; ``arg`` the rank from 0 to 1)."""

    name: str
    kind: str
    column: str | None = None
    arg: float | None = None

    def _value(self) -> Column:
        return F.expr(self.column) if self.column else F.lit(1)

    def parts(self, sign: Column | None = None) -> dict[str, Column]:
        """Aggregates of rows that the measure is kept as."""
        v = self._value()
        if sign is not None and self.kind not in ("count", "total", "mean"):
            raise ValueError(f"{self.name}: a {self.kind} cannot be taken back")
        s = F.lit(1) if sign is None else sign
        n = F.coalesce(F.sum(F.when(v.isNotNull(), s)), F.lit(0)).cast("long")
        if self.kind == "count":
            return {"n": n}
        if self.kind in ("total", "mean"):
            return {"n": n, "s": F.sum(v if sign is None else F.when(s < 0, -v).otherwise(v))}
        return {"least": lambda: {"v": F.min(v)}, "most": lambda: {"v": F.max(v)}, "distinct": lambda: {"d": F.hll_sketch_agg(v.cast("string"))},
                "quantile": lambda: {"q": F.kll_sketch_agg_double(v.cast("double"))}}[self.kind]()

    def merged(self) -> dict[str, Column]:
        """Aggregates of partials."""
        how = {"n": F.sum, "s": F.sum, "v": F.min if self.kind == "least" else F.max, "d": F.hll_union_agg, "q": F.kll_merge_agg_double}
        parts = {"count": "n", "total": "ns", "mean": "ns", "least": "v", "most": "v", "distinct": "d", "quantile": "q"}[self.kind]
        return {p: how[p](f"{self.name}__{p}") for p in parts}

    def finished(self) -> Column:
        of = lambda p: F.col(f"{self.name}__{p}")
        if self.kind == "count":
            return of("n")
        if self.kind == "total":
            return F.when(of("n") > 0, of("s"))
        if self.kind == "mean":
            return F.when(of("n") > 0, of("s").cast("double") / of("n"))
        if self.kind == "distinct":
            return F.coalesce(F.hll_sketch_estimate(of("d")), F.lit(0)).cast("long")
        if self.kind == "quantile":
            return F.when(F.kll_sketch_get_n_double(of("q")) > 0, F.kll_sketch_get_quantile_double(of("q"), F.lit(float(self.arg))))
        return of("v")


def partial(df: DataFrame, keys: list, measures: list[Measure], sign: str | None = None) -> DataFrame:
    """Partials of rows by ``keys`` (columns, or names of them)."""
    s = F.col(sign) if sign else None
    rows = F.sum(s).cast("long") if sign else F.count(F.lit(1))
    return df.groupBy(*keys).agg(rows.alias(ROWS), *[c.alias(f"{m.name}__{p}") for m in measures for p, c in m.parts(s).items()])


def merge(partials: DataFrame, keys: list, measures: list[Measure]) -> DataFrame:
    """Partials of partials: of batches, or of finer keys."""
    return partials.groupBy(*keys).agg(F.sum(ROWS).alias(ROWS), *[c.alias(f"{m.name}__{p}") for m in measures for p, c in m.merged().items()])


def finish(partials: DataFrame, keys: list[str], measures: list[Measure]) -> DataFrame:
    """The measures, of groups that have rows (left)."""
    return partials.where(F.col(ROWS) > 0).select(*keys, *[m.finished().alias(m.name) for m in measures])


class PartialStore:
    """Partials under ``path``: ``part=<series><number>``, and ``folded`` ones."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], measures: list[Measure]):
        self.spark, self.path, self.keys, self.measures = spark, path, list(keys), measures

    def publish(self, df: DataFrame, folder: str) -> None:
        """Write ``df`` as a folder by one rename, unless an earlier attempt has."""
        target, stage = f"{self.path}/{folder}", f"{self.path}/_staging/{folder.replace('/', '-')}"
        if not exists(self.spark, target):
            df.write.mode("overwrite").parquet(stage)
            move(self.spark, stage, target)

    def add(self, rows: DataFrame, number: int, series: str = "batch", sign: str | None = None) -> None:
        self.publish(partial(rows, self.keys, self.measures, sign).coalesce(1), f"parts/{series}-{number}")

    def _folded(self) -> tuple[str | None, dict[str, int]]:
        """The newest folded folder and the last number of each series in it."""
        names = children(self.spark, f"{self.path}/folded")
        if not names:
            return None, {}
        newest = max(names, key=lambda n: int(n.split("-")[0]))
        return newest, {s.split("=")[0]: int(s.split("=")[1]) for s in newest.split("-")[1:]}

    def parts(self) -> list[tuple[str, int]]:
        """``(series, number)`` of the folders that are not folded."""
        _, upto = self._folded()
        found = [n.rsplit("-", 1) for n in children(self.spark, f"{self.path}/parts")]
        return sorted((s, int(k)) for s, k in found if int(k) > upto.get(s, -1))

    def partials(self) -> DataFrame | None:
        folded, _ = self._folded()
        paths = [f"{self.path}/parts/{s}-{k}" for s, k in self.parts()] + ([f"{self.path}/folded/{folded}"] if folded else [])
        return merge(self.spark.read.parquet(*paths), self.keys, self.measures) if paths else None

    def read(self) -> DataFrame | None:
        df = self.partials()
        return None if df is None else finish(df, self.keys, self.measures)

    def fold(self, most: int = 16) -> bool:
        """Merge the folders into one if there are more than ``most``. The newest of each
        series stays out: a batch that is retried finds it."""
        parts = self.parts()
        if len(parts) <= most:
            return False
        newest = {}
        for s, k in parts:
            newest[s] = max(k, newest.get(s, -1))
        old = [(s, k) for s, k in parts if k < newest[s]]
        folded, upto = self._folded()
        for s, k in old:
            upto[s] = max(k, upto.get(s, -1))
        paths = [f"{self.path}/parts/{s}-{k}" for s, k in old] + ([f"{self.path}/folded/{folded}"] if folded else [])
        number = int(folded.split("-")[0]) + 1 if folded else 0
        name = "-".join([str(number), *(f"{s}={k}" for s, k in sorted(upto.items()))])
        self.publish(merge(self.spark.read.parquet(*paths), self.keys, self.measures), f"folded/{name}")
        return True

    def clear(self) -> None:
        """Delete folders that are folded into another. For times when nobody reads them."""
        folded, upto = self._folded()
        for n in children(self.spark, f"{self.path}/parts"):
            s, k = n.rsplit("-", 1)
            if int(k) <= upto.get(s, -1):
                delete(self.spark, f"{self.path}/parts/{n}")
        for n in children(self.spark, f"{self.path}/folded"):
            if n != folded:
                delete(self.spark, f"{self.path}/folded/{n}")
