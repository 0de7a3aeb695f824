"""Table layout at write time: range clustering, Z-order, partitioning, statistics columns.

All layouts return the same rows as their input; they only decide which rows share
a file, so that min/max statistics in file footers let readers skip files.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANKS = 64  # quantile cuts a column's distribution is known by
DEFAULT_INDEXED_COLUMNS = 32
MOST_FOLDERS = 2_000  # partitions of a write that get folders of their own


def _names(x) -> tuple[str, ...]:
    if not x:
        return ()
    if isinstance(x, str):
        return tuple(c.strip() for c in x.split(",") if c.strip())
    return tuple(x)


def _numeric(df: DataFrame, c: str) -> Column:
    """A number that grows with the column (of a text: its first six bytes)."""
    t = df.schema[c].dataType
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(c)).cast("double")
    if isinstance(t, T.NumericType):
        return F.col(c).cast("double")
    if isinstance(t, T.StringType):
        head = F.rpad(F.substring(F.hex(F.encode(F.col(c), "UTF-8")), 1, 12), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    raise TypeError(f"layout keys are numbers, dates, times or texts, got {c}: {t.simpleString()}")


def _coder(cuts: list[list[float]], bits: int):
    """Function of batches of numbers, a column a key: the ``bits`` bits of each number's place in
    its distribution, interleaved. A place is the quantile a number falls in, and in it the share
    of the way to the next. (All it needs is inside: it is sent to the tasks.)"""
    stride, low = len(cuts), min(10, bits)
    edges = [np.array(sorted(set(c))) for c in cuts]
    # the bits of a number, ``stride`` places apart; ten at a time
    table = np.array([sum((v >> b & 1) << b * stride for b in range(low)) for v in range(1 << low)], np.int64)

    def rank(x: np.ndarray, e: np.ndarray) -> np.ndarray:
        n = len(e) - 1
        if n < 1:
            return np.zeros(len(x), np.int64)
        a = np.clip(np.searchsorted(e, x, side="right") - 1, 0, n - 1)
        with np.errstate(all="ignore"):
            share = np.fmin(np.maximum((x - e[a]) / (e[a + 1] - e[a]), 0.0), 1.0)  # NaN comes last
        return np.minimum(np.floor((a + share) / n * (1 << bits)).astype(np.int64), (1 << bits) - 1)

    def code(*numbers: pd.Series) -> pd.Series:
        out = np.zeros(len(numbers[0]), np.int64)
        for i, (x, e) in enumerate(zip(numbers, edges)):
            r = rank(x.to_numpy(), e)
            for at in range(0, bits, 10):
                out |= table[r >> at & len(table) - 1] << at * stride + i
        return pd.Series(out)

    return F.pandas_udf(code, "long")


def quantile_cuts(df: DataFrame, cols, rel_error: float = 0.001) -> list[list[float]]:
    """RANKS approximate quantiles of each column (a distributed sketch; only the cuts come
    back to the driver)."""
    cols = list(cols)
    probe = df.select(*[_numeric(df, c).alias(c) for c in cols])
    return probe.approxQuantile(cols, [i / RANKS for i in range(RANKS + 1)], rel_error)


def zorder_code(df: DataFrame, cols, bits: int | None = None, rel_error: float = 0.001, cuts: list | None = None) -> Column:
    """Morton code of the ranks of ``cols``.

    A column's distribution is known by its ``cuts`` (``quantile_cuts``; measured here if not
    given), so skewed values still fill all ranks. ``bits`` a column: by default as many as
    fit 62 bits together, at most 20, so that however many ranges a write is cut into, the
    order inside a quantile is kept."""
    cols = list(cols)
    bits = bits or min(20, 62 // len(cols))
    cuts = quantile_cuts(df, cols, rel_error) if cuts is None else cuts
    # by the batch: this runs over every row several times
    return _coder(cuts, bits)(*[F.coalesce(_numeric(df, c), F.lit(float("-inf"))) for c in cols])  # NULL comes first


def deepest(files: list[tuple], depth: int) -> list[int]:
    """Which files to rewrite so that no point of the key lies in more than ``depth`` of the
    others: ``files`` are ``(lo, hi)`` of the code in each; places in the list are returned.

    A sweep over the intervals finds the deepest point; of the files over it the widest go
    first, as they overlap the most. Files of one code cannot be parted further and do not
    count."""
    lo, hi = (np.array([f[k] for f in files], np.int64) for k in (0, 1))
    rest, taken = lo < hi, []
    while rest.any():
        own = np.flatnonzero(rest)
        at = np.sort(lo[own])  # the depth changes upwards at these points alone
        over = np.searchsorted(at, at, side="right") - np.searchsorted(np.sort(hi[own]), at, side="left")
        if over.max() <= depth:
            break
        x = at[over.argmax()]
        there = own[(lo[own] <= x) & (hi[own] >= x)]
        wide = there[np.argsort(-(hi[there] - lo[there]), kind="stable")][: over.max() - depth]
        rest[wide] = False
        taken += wide.tolist()
    return sorted(taken)


@dataclass(frozen=True)
class Layout:
    cluster_by: tuple = ()
    zorder_by: tuple = ()
    partition_by: tuple = ()
    stats_columns: tuple | None = None  # only these get footer min/max
    num_indexed_cols: int = DEFAULT_INDEXED_COLUMNS  # or: the first n columns
    bloom_filter_columns: tuple = ()
    optimize_write: bool = False  # rebalance before writing: fewer, evenly sized files

    @staticmethod
    def from_properties(props: dict | None, cluster_by=(), partition_by=()) -> "Layout":
        props = props or {}
        stats = props.get("delta.dataSkippingStatsColumns")
        n = props.get("delta.dataSkippingNumIndexedCols")
        return Layout(cluster_by=_names(cluster_by),
                      zorder_by=_names(props.get("pipelines.autoOptimize.zOrderCols")),
                      partition_by=_names(partition_by),
                      stats_columns=_names(stats) if stats else None,
                      num_indexed_cols=int(n) if n is not None else DEFAULT_INDEXED_COLUMNS,
                      optimize_write=str(props.get("delta.autoOptimize.optimizeWrite", "false")).lower() == "true")

    @property
    def reads_twice(self) -> bool:
        """Does arranging look at the rows (quantiles, range samples) before the write?"""
        return bool(self.cluster_by or self.zorder_by)

    def by_folder(self, df: DataFrame) -> bool:
        """Do the partitions of ``df`` get a folder each? Beyond ``MOST_FOLDERS`` of them (folders
        and files would be as many as the values) a partition is a stretch of a file instead:
        files are ranges of the partition columns, which they hold with their statistics."""
        if not self.partition_by:
            return False
        return df.select(*self.partition_by).distinct().limit(MOST_FOLDERS + 1).count() <= MOST_FOLDERS

    def arrange(self, df: DataFrame, folders: bool = True) -> DataFrame:
        """Co-locate rows: range partitions on the cluster key, or on the Z-order code of
        several keys (so each of them skips files), sorted within each file. The number of
        ranges is left to AQE. ``folders``: as ``by_folder`` says."""
        # A row hash ends every range key: rows sharing one hot key value can still be
        # split over several ranges (files), so no task writes a whole hot key.
        spread = F.xxhash64(*[F.col(c) for c in df.columns])
        together = self.zorder_by or (self.cluster_by if len(self.cluster_by) > 1 else ())
        if together:
            code = "__zorder"
            df = df.withColumn(code, zorder_code(df, together))
            keys = [*self.partition_by, code]
            return df.repartitionByRange(*keys, spread).sortWithinPartitions(*keys).drop(code)
        if self.cluster_by:
            keys = [*self.partition_by, *self.cluster_by]
            return df.repartitionByRange(*keys, spread).sortWithinPartitions(*keys)
        if self.partition_by and not folders:
            return df.repartitionByRange(*self.partition_by, spread).sortWithinPartitions(*self.partition_by)
        if self.partition_by:
            # AQE rebalances the write: skewed partitions are split, small ones merged
            return df.hint("rebalance", *self.partition_by)
        if self.optimize_write:
            return df.hint("rebalance")
        return df

    def writer_options(self, columns: list[str], folders: bool = True) -> dict:
        """Parquet footer statistics only on the chosen columns, and on partition columns that
        are no ``folders``."""
        chosen = None
        if self.stats_columns is not None:
            chosen = list(self.stats_columns)
        elif self.num_indexed_cols >= 0:  # -1: all
            plain = [c for c in columns if c not in self.partition_by]
            chosen = plain[: self.num_indexed_cols] if len(plain) > self.num_indexed_cols else None
        if chosen is not None and not folders:
            chosen = [*dict.fromkeys([*self.partition_by, *chosen])]
        opts: dict = {}
        if chosen is not None:
            opts["parquet.column.statistics.enabled"] = "false"
            for c in chosen:
                opts[f"parquet.column.statistics.enabled#{c}"] = "true"
        for c in self.bloom_filter_columns:
            opts[f"parquet.bloom.filter.enabled#{c}"] = "true"
        return opts

    def write(self, df: DataFrame, path: str, folders: bool) -> None:
        """Write ``df`` in this layout as the folder ``path``, in place of what is there."""
        w = (self.arrange(df, folders).write.mode("overwrite").option("partitionOverwriteMode", "static")
             .options(**self.writer_options(df.columns, folders)))
        if self.partition_by and folders:
            w = w.partitionBy(*self.partition_by)
        w.parquet(path)
