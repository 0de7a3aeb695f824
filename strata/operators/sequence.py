"""Per-key ordered operators that stay balanced when one key holds a large share of rows.

``Window.partitionBy(key)`` sends every row of a key to one task. Here the rows of a key
are cut into blocks by the leading order column itself: a block works locally, and only its
outermost row takes its value from the next block of the key that has rows (a small
aggregate). How wide blocks are is measured (one aggregate: count, ends and quantiles), so
that no block is much above ``rows`` rows however the values are spread; the block of a row
depends on its value alone. Keys whose rows fit one block (found by counting) are not cut:
for them one window is the whole work.
"""

from __future__ import annotations

import functools
import os.path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS = 64  # quantiles; inside each, blocks of equal width
ROWS = 200_000  # rows a block is to hold


def _number(t: T.DataType, c: Column) -> Column | None:
    """A number that grows with ``c``, None for types without one."""
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double") if isinstance(t, T.NumericType) else None


def block_of(df: DataFrame, column: str, rows: int = ROWS) -> Column:
    """Block of a row, an expression on ``column`` that grows with it (null comes first).

    Measured on ``df``, valid for any value. Times, dates and numbers: quantiles, and equal
    widths between them. Texts: the eight characters behind what all of them begin with.
    Values of other types, and up to ``rows`` rows, are one block."""
    t, c = df.schema[column].dataType, F.col(column)
    x = _number(t, c)
    if x is not None:
        at = [k / CELLS for k in range(CELLS + 1)]
        m = df.agg(F.count(c).alias("n"), F.percentile_approx(x, at, 4 * CELLS).alias("q")).first()
        if m["n"] <= rows:
            return F.lit(0)
        q, parts = m["q"], -(-m["n"] // (rows * CELLS))
        cuts = F.array(*map(F.lit, q))

        def block(v: Column) -> Column:
            cell = F.greatest(F.lit(1), F.least(F.lit(CELLS), F.size(F.filter(cuts, lambda k: k <= v))))
            lo, hi = F.element_at(cuts, cell), F.element_at(cuts, cell + 1)
            part = F.when(hi > lo, F.floor((v - lo) / (hi - lo) * parts)).otherwise(F.lit(0))
            return cell * parts + F.greatest(F.lit(0), F.least(F.lit(parts - 1), part))

        return F.when(x.isNull(), F.lit(-1)).otherwise(block(x)).cast("long")
    if isinstance(t, T.StringType):
        m = df.agg(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")).first()
        if m["n"] <= rows:
            return F.lit(0)
        same = len(os.path.commonprefix([m["lo"], m["hi"]]))
        # values outside the measured ends keep their place beside those inside
        inside = c.between(F.lit(m["lo"]), F.lit(m["hi"]))
        return F.when(c < F.lit(m["lo"]), F.lit("")).when(inside, F.concat(F.lit("m"), F.substring(c, same + 1, 8))).when(c > F.lit(m["hi"]), F.lit("z"))
    return F.lit(0)


def hot_keys(df: DataFrame, keys, rows: int = ROWS) -> DataFrame | None:
    """Keys that have more than ``rows`` rows (so at most one key in ``rows`` rows), None without any."""
    many = df.groupBy(*keys).count().where(F.col("count") > rows).select(*keys)
    found = many.collect()
    return df.sparkSession.createDataFrame(found, many.schema) if found else None


def split_hot(df: DataFrame, keys, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``hot`` keys, and the others."""
    names = [f"__hot{i}" for i in range(len(keys))]
    few = F.broadcast(hot.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]))
    on = functools.reduce(lambda x, y: x & y, [df[k].eqNullSafe(few[n]) for k, n in zip(keys, names)])
    return df.join(few, on, "left_semi"), df.join(few, on, "left_anti")


def next_in_order(df: DataFrame, keys, order, value: str, out: str, back: bool = False, block: Column | None = None,
                  rows: int = ROWS) -> DataFrame:
    """``lead(value) OVER (PARTITION BY keys ORDER BY order)`` (``back``: ``lag``), computed
    skew-safe.

    ``order`` must be a total order within a key (add a tie-break column). ``block``: one
    measured before (``block_of``), by which all keys are cut; else the rows of the keys are
    counted, and only keys of more than ``rows`` rows are cut."""
    keys, order = list(keys), list(order)
    if block is not None:
        return _next_by_block(df, keys, order, value, out, back, block)
    cols = [c for c in df.columns if c != out]
    near = (F.lag if back else F.lead)(value).over(Window.partitionBy(*keys).orderBy(*order))
    hot = hot_keys(df, keys, rows)
    if hot is None:
        return df.select(*cols, near.alias(out))
    large, rest = split_hot(df, keys, hot)
    cut = _next_by_block(large, keys, order, value, out, back, block_of(large, order[0], rows))
    return rest.select(*cols, near.alias(out)).unionByName(cut)


def _next_by_block(df: DataFrame, keys: list, order: list, value: str, out: str, back: bool, block: Column) -> DataFrame:
    b = "__strata_block"
    d = df.withColumn(b, block)
    near = F.lag if back else F.lead
    at_edge = (F.max_by if back else F.min_by)(F.struct(F.col(value).alias("v")), F.struct(*order))
    local = d.withColumn(out, near(F.struct(F.col(value).alias("v"))).over(Window.partitionBy(*keys, b).orderBy(*order)))
    # the outermost value of each block, handed to the neighbouring block of the key
    edges = d.groupBy(*keys, b).agg(at_edge.alias("__edge"))
    bridge = (edges.withColumn("__bridge", near("__edge").over(Window.partitionBy(*keys).orderBy(b)))
              .where(F.col("__bridge").isNotNull())
              .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate([*keys, b])], "__bridge"))
    on = None
    for i, k in enumerate([*keys, b]):
        c = local[k].eqNullSafe(bridge[f"__k{i}"])
        on = c if on is None else on & c
    cols = [c for c in df.columns if c != out]
    return local.join(bridge, on, "left").select(*[local[c] for c in cols], F.coalesce(local[out], F.col("__bridge"))["v"].alias(out))


def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The row with the greatest ``order`` per key (top-1 per group).

    A ``max_by`` aggregate: partial per task, so the shuffle carries one row per key
    and task, whatever the skew. Ties on ``order`` need a tie-break column."""
    keys = list(keys)
    order = list(order)
    cols = df.columns
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("__r"))
    return picked.select(*[F.col("__r")[c].alias(c) for c in cols])
