"""Mixing sources to target weights, block by block.

Method. The words of each source, its documents in a fixed pseudorandom order, are one
stream cut into blocks of ``block`` words. Each output shard holds a number of slots for
every source: the whole part of its expected share, and multinomial draws for the
fractional rest (in turn one draw more or less a shard, so that over all shards they add
up to it). The slots of a source are numbered over the shards; number j of a source
with n blocks goes through that source's pseudorandom permutation of 0..n-1 for epoch
j / n, and blocks are joined by that index. So a block is taken once an epoch, and never
more often than ``most`` times (slots beyond are left out: the cap of the targets).

Size. Sources are one row each. A document's place in its stream comes from sums by
(source, bucket), so a hot source is spread over buckets; blocks are joined on (source,
index), which spreads it too. Everything drawn is a hash of the seed and numbers: a task
that is run again draws the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, free_name, keep, let, text_of, words

WEIGHTS = (5.0, 2.0, 1.0)


def sources(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """``sizes(source, size)`` -> one row for each source: ``sid`` (order by code point, null
    last), ``source_size``, ``weight``, ``target``. Targets share ``share`` times all sizes
    by weight; none is over ``most`` times its source, the excess goes to the others."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    s = s.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("sid") % len(weights)))
    s = s.withColumn("cap", most * F.col("source_size"))
    # The level is that at which min(cap, level * weight) adds up: with the sources in the
    # order in which they reach their caps, the largest of the levels below.
    full = Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(full), F.lit(0))
    open_ = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(full), F.lit(0.0))
    s = s.withColumn("level", left / open_).withColumn("level", F.max("level").over(whole))
    return s.select("sid", "source", "source_size", "weight",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _step(v: Column, n: Column, side: Column, *seed: Column) -> Column:
    """Rounds that add a hash of one coordinate to the other, on a grid of ``side`` columns
    and as many rows as n needs."""
    rows = F.ceil(n / side).cast("long")
    a, b = v % side, F.floor(v / side).cast("long")
    for r in range(3):
        a = F.pmod(a + F.pmod(F.xxhash64(F.lit(2 * r), *seed, b), side), side)
        b = F.pmod(b + F.pmod(F.xxhash64(F.lit(2 * r + 1), *seed, a), rows), rows)
    return a + b * side


def _permuted(df: DataFrame, x: str, n: str, out: str, *seed: Column) -> DataFrame:
    """``df`` with ``out``: a pseudorandom permutation of 0..n-1, picked by ``seed``, at ``x``.
    The steps are a permutation of a grid of about the root of n by the root of n; from the
    few places of the grid that are not below n they are walked on."""
    side, first = free_name(df, "side"), free_name(df, "first")
    df = df.withColumn(side, F.ceil(F.sqrt(n)).cast("long"))
    df = df.withColumn(first, _step(F.col(x), F.col(n), F.col(side), *seed))
    # the grid has fewer than ``side`` places too many, so ``side`` steps always come home
    walked = F.aggregate(F.sequence(F.lit(1).cast("long"), F.col(side)), F.col(first), lambda y, _: F.when(y < F.col(n), y)
                         .otherwise(_step(y, F.col(n), F.col(side), *seed)))
    return df.withColumn(out, F.when(F.col(first) < F.col(n), F.col(first)).otherwise(walked)).drop(side, first)


def _draws(s: DataFrame, block: int, shard_slots: int, most: int, seed: int) -> DataFrame:
    """Blocks taken: ``(sid, index, epoch, shard)``."""
    spark = s.sparkSession
    s = s.where("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    s = keep(s.withColumn("slots", F.col("target") * F.col("blocks") / F.col("source_size")), "sources")
    total = s.agg(F.sum("slots")).first()[0] or 0.0
    shards = max(1, -(-int(total) // shard_slots))
    s = s.withColumn("whole", F.floor(F.col("slots") / shards).cast("long")).withColumn("rest", F.col("slots") / shards - F.col("whole"))
    up_to = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    s = keep(s.withColumn("hi", F.sum("rest").over(up_to)), "sources")
    rest, n = s.agg(F.max("hi"), F.count(F.lit(1))).first()
    n_draws = round(shards * (rest or 0.0))

    # whole parts: shard h has slots h * whole ... of each source. Numbers are made in three
    # steps, dealt out after each to a set number of tasks: the few rows they start from
    # would else be one task's.
    part, tasks = 4096, int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (s.select("sid", "blocks", "whole", F.explode(F.sequence(F.lit(0), F.lit((shards - 1) // part))).alias("part"))
            .repartition(tasks, "sid", "part").withColumn("shard", F.explode(F.sequence(
                F.col("part").cast("long") * part, F.least(F.col("part").cast("long") * part + part, F.lit(shards)) - 1)))
            .repartition(tasks, "sid", "shard"))
    slots = rows.where("whole > 0").select("sid", "blocks", "shard", F.explode(F.sequence(
        F.col("shard") * F.col("whole"), (F.col("shard") + 1) * F.col("whole") - 1)).alias("j"))
    if n_draws:
        # the rest: n_draws multinomial draws, dealt evenly over the shards, looked up in cells of the unit range
        unit = lambda c: F.col(c) / F.lit(rest)
        cells = s.where("rest > 0").select(
            "sid", "blocks", (F.lit(shards) * F.col("whole")).alias("first"), (F.col("hi") - F.col("rest")).alias("lo"), "hi")
        cells = cells.withColumn("cell", F.explode(F.sequence(F.floor(unit("lo") * n), F.floor(unit("hi") * n))))
        u = F.pmod(F.xxhash64(F.lit(seed), "shard", "draw"), F.lit(1 << 53)) / float(1 << 53) * F.lit(rest)
        upto = lambda h: F.floor(h * F.lit(rest) + 0.5)
        drawn = (spark.range(shards).select(F.col("id").alias("shard"), (upto(F.col("id") + 1) - upto(F.col("id"))).cast("int").alias("own"))
                 .where("own > 0").select("shard", F.explode(F.sequence(F.lit(1), F.col("own"))).alias("draw"))
                 .withColumn("u", u).withColumn("cell", F.floor(unit("u") * n)))
        drawn = drawn.join(cells, "cell").where("u >= lo AND u < hi")
        number = F.row_number().over(Window.partitionBy("sid").orderBy("shard", "draw")) - 1
        slots = slots.unionByName(drawn.select("sid", "blocks", "shard", (F.col("first") + number).alias("j")))
    slots = slots.withColumn("epoch", F.floor(F.col("j") / F.col("blocks")).cast("int")).where(F.col("epoch") < most)
    slots = _permuted(slots.withColumn("x", F.col("j") % F.col("blocks")), "x", "blocks", "index", F.lit(seed), F.col("sid"), F.col("epoch"))
    return slots.select("sid", "index", "epoch", "shard")


def _placed(rows: DataFrame, s: DataFrame, seed: int) -> DataFrame:
    """``rows(rid, id, source, size)`` with words -> ``(rid, sid, size, at)``, ``at`` the place
    of its first word in its source's stream. Sums by bucket come first, then places in a
    bucket; with the root of the rows as buckets, neither is long for a hot source."""
    buckets = max(1, math.isqrt(rows.count()))
    d = (rows.where("size > 0").join(s.select("sid", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s")))
         .withColumn("h", F.xxhash64(F.lit(seed), "id", "size")).withColumn("bucket", F.pmod("h", F.lit(buckets)))
         .select("rid", "id", "sid", "size", "h", "bucket"))
    sums = d.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("words")
    sums = sums.select("sid", "bucket", before.alias("before"))
    own = Window.partitionBy("sid", "bucket").orderBy("h", "id", "rid")
    d = d.withColumn("own", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    return d.join(sums, ["sid", "bucket"]).select("rid", "sid", "size", (F.col("before") + F.col("own")).alias("at"))


def _pieces(rows: DataFrame, s: DataFrame, block: int, shard_slots: int, most: int, seed: int) -> DataFrame:
    """What the mix takes of each row: ``(rid, size, epoch, start, length)`` in words."""
    d = _placed(rows, s, seed)
    d = d.withColumn("index", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))))
    # draws come out of numbers that are made after a small shuffle, which makes them look small
    taken = d.join(_draws(s, block, shard_slots, most, seed).hint("shuffle_merge"), ["sid", "index"])
    start = F.greatest(F.col("index") * block - F.col("at"), F.lit(0))
    stop = F.least((F.col("index") + 1) * block - F.col("at"), F.col("size"))
    return taken.select("rid", "size", "epoch", start.alias("start"), (stop - start).alias("length"))


def _rows(docs: DataFrame, id_col: str, source: str, text: str, number: Column) -> DataFrame:
    """Documents' sizes, each row with a number that is fixed once written."""
    return docs.select(number.alias("rid"), F.col(id_col).alias("id"), F.col(source).alias("source"),
                       F.size(words(text_of(text))).cast("long").alias("size"))


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: int = 2, block: int = 64,
        shard_slots: int = 16384, seed: int = 7) -> DataFrame:
    """One row for each row of ``docs``: id, ``size`` (words), ``source_size``, ``target`` of
    its source, and ``taken``, the words that the mix takes of it (repeats counted).

    A null text has no words; a null source is a source of its own, the last. Documents
    without words have ``taken`` 0. Null ids and repeated rows are carried, each with its
    own place. An empty table gives an empty table. Other columns are not read.
    """
    rows = keep(_rows(docs, id_col, source, text, F.monotonically_increasing_id()), "sizes")
    s = keep(sources(rows, weights, share, most), "targets")
    taken = _pieces(rows, s, block, shard_slots, most, seed).groupBy("rid").agg(F.sum("length").alias("taken"))
    return (rows.join(taken, "rid", "left").join(s.select(F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s")))
            .select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text",
                    weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: int = 2, block: int = 64,
                    shard_slots: int = 16384, seed: int = 7) -> DataFrame:
    """The mix as documents: for every epoch a row of each document of which that epoch
    takes words. A document taken whole keeps its text; else its text is what was taken of
    it, in order: stretches of the text as they stand, white space and line breaks inside
    them included. Columns stay, whatever they are called; documents without words are left
    out. Rows of both epochs have the same id; repeated rows and null ids are mixed like any
    other, a null source is the last one. An empty table gives an empty table."""
    row = free_name(docs, "row")
    one = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns])
    marked = keep(docs.select(one.alias(row), F.monotonically_increasing_id().alias("rid")), "numbered")
    own = lambda c: F.col(row)[c]
    rows = keep(marked.select("rid", own(id_col).alias("id"), own(source).alias("source"),
                              F.size(words(text_of(own(text)))).cast("long").alias("size")), "sizes")
    s = keep(sources(rows, weights, share, most), "targets")
    taken = (_pieces(rows, s, block, shard_slots, most, seed).groupBy("rid", "epoch")
             .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("parts"), (F.sum("length") == F.first("size")).alias("whole")))
    # each word with the white space behind it, so stretches of them are stretches of the text
    each = F.regexp_extract_all(text_of(own(text)), F.lit(f"{WORD}+{SPACE[:-1]}*+"), F.lit(0))
    cut = let(each, lambda w: F.array_join(F.flatten(F.transform("parts", lambda p: F.slice(w, p["start"].cast("int") + 1, p["length"].cast("int")))), ""))
    new = F.when(F.col("whole"), own(text)).otherwise(F.regexp_replace(cut, f"{SPACE}$", ""))
    fresh = free_name(docs, "new")
    out = marked.join(taken, "rid").select(row, new.alias(fresh))
    return out.select(*[F.col(fresh).alias(c) if c == text else own(c).alias(c) for c in docs.columns])
