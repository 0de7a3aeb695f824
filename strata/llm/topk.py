"""Exact top-k by inner product, with vector-approximation files.

Method. Each vector is kept twice: in full, and as a file of cells, ``bits`` bits a
dimension at that dimension's quantiles. The cells are scanned first and bound every score
from both sides; a candidate whose upper bound is below a query's k-th lower bound is out.
Exact vectors are then read in the order of their bounds: first the best few of each
query, then those whose bound the k-th exact score so far does not exclude. What is left
out could not have entered.

Size. Queries and cells meet in blocks: a block of queries with a run of packed cells, one
matrix product each; only bounds that stand leave a task. Of equal vectors the k + 1
smallest ids are kept (no more can be in any answer), so copies do not swell the candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

BLOCK = 1024  # queries a block holds
CHUNK = 4096  # vectors a packed row of cells holds
RUN = 16  # packed rows that meet a block in one run


def integer_vectors(rows: DataFrame, id_col: str, vector: str, scale: float = 256.0) -> DataFrame:
    """``(id, dim, v)`` of the rows that take part: id and vector not null, vector not empty,
    all components finite. ``v`` is floor(scale * x). Repeated rows count once."""
    x = F.col(vector)
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    v = F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long"))
    return (rows.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.coalesce(fine, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), F.size(x).alias("dim"), v.alias("v")).distinct())


def _cells(exact: DataFrame, bits: int) -> dict[int, np.ndarray]:
    """For each number of dimensions the cell edges, dimension by edge (from the smallest
    value to the largest). Bounded by dimensions times 2 ** bits."""
    at = [i / (1 << bits) for i in range(1, 1 << bits)]
    rows = (exact.select("dim", F.posexplode("v").alias("k", "x")).groupBy("dim", "k")
            .agg(F.percentile_approx("x", at, 2000).alias("q"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
    out: dict[int, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["dim"], np.zeros((r["dim"], (1 << bits) + 1)))[r["k"]] = [r["lo"], *r["q"], r["hi"]]
    return out


def _packed(exact: DataFrame, edges: dict[int, np.ndarray]) -> DataFrame:
    """The approximation file: ``(dim, ids, codes)``, up to CHUNK vectors a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def row(dim: int) -> pa.RecordBatch:
            ids, vs = held.pop(dim)
            x = np.asarray(vs, np.float64)
            # cell c holds edges[c] <= x <= edges[c + 1]
            codes = np.stack([np.clip(np.searchsorted(e[1:-1], x[:, k], side="left"), 0, len(e) - 2)
                              for k, e in enumerate(edges[dim])], axis=1).astype(np.uint8)
            return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "ids": pa.array([np.asarray(ids, "<i8").tobytes()], pa.binary()),
                                               "codes": pa.array([codes.tobytes()], pa.binary())})

        for b in batches:
            for i, dim, v in zip(*(b.column(k).to_pylist() for k in range(3))):
                ids, vs = held.setdefault(dim, ([], []))
                ids.append(i)
                vs.append(v)
                if len(ids) == CHUNK:
                    yield row(dim)
        for dim in list(held):
            yield row(dim)

    return keep(exact.select("id", "dim", "v").mapInArrow(run, "dim int, ids binary, codes binary"), "cells")


def _met(cells: DataFrame, blocks: DataFrame, n_blocks: int, runs: int) -> DataFrame:
    """Every packed row beside every block of queries of its dimensions."""
    c = (cells.withColumn("run", F.pmod(F.xxhash64("ids"), F.lit(runs)))
         .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))))
    q = blocks.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(runs - 1).cast("long"))))
    return c.join(q, ["dim", "block", "run"]).select("dim", "block", "run", "ids", "codes", "qids", "qvs", "least")


def _bounds(dim: int, codes: bytes, qvs: np.ndarray, edges: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores, query by vector."""
    e, c = edges[dim], np.frombuffer(codes, np.uint8).reshape(-1, dim)
    k = np.arange(dim)
    lo, hi = e[k, c], e[k, c + 1]
    mid, half = (lo + hi) / 2, (hi - lo) / 2
    a, b = qvs @ mid.T, np.abs(qvs) @ half.T
    b += 1e-12 * (np.abs(qvs) @ np.abs(mid).T + b)  # rounding of large values
    return a - b, a + b


def _scan(met: DataFrame, edges: dict[int, np.ndarray], k: int, final: bool) -> DataFrame:
    """Scan cells. First: ``(qid, lows)``, the k best lower bounds of a run. Final: ``(qid,
    id, high)``, the candidates whose upper bound reaches the query's ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best, qids, qvs, least = None, None, None, None, None

        def lows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"qid": pa.array(qids), "lows": pa.array(list(best), pa.list_(pa.float64()))})

        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1)
                key = tuple(r.column(c)[0].as_py() for c in range(3))
                if key != now:
                    if now is not None and not final:
                        yield lows()
                    now, qids = key, np.asarray(r.column(5)[0].values.to_numpy(zero_copy_only=False))
                    qvs = r.column(6)[0].values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, key[0])
                    least = r.column(7)[0].values.to_numpy(zero_copy_only=False)
                    best = np.full((len(qids), k), -np.inf)
                ids = np.frombuffer(r.column(3)[0].as_py(), "<i8")
                low, high = _bounds(key[0], r.column(4)[0].as_py(), qvs, edges)
                own = qids[:, None] == ids[None, :]
                if final:
                    q, c = np.nonzero((high >= least[:, None]) & ~own)
                    yield pa.RecordBatch.from_pydict({"qid": pa.array(qids[q]), "id": pa.array(ids[c]), "high": pa.array(high[q, c])})
                else:
                    low[own] = -np.inf
                    both = np.concatenate([best, low], axis=1)
                    best = -np.partition(-both, k - 1, axis=1)[:, :k]
        if now is not None and not final:
            yield lows()

    return met.mapInArrow(run, "qid long, id long, high double" if final else "qid long, lows array<double>")


def _scored(pairs: DataFrame, queries: DataFrame, exact: DataFrame) -> DataFrame:
    """``pairs(qid, id)`` with their exact ``score``."""
    p = pairs.join(exact.select("id", "v"), "id").join(queries.select(F.col("id").alias("qid"), F.col("v").alias("qv")), "qid")
    return p.select("qid", "id", F.aggregate(F.zip_with("v", "qv", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x).alias("score"))


def top_k(rows: DataFrame, query_filter, id_col: str = "vec_id", vector: str = "embedding", k: int = 5, scale: float = 256.0,
          bits: int = 6, first: int = 4) -> DataFrame:
    """``(query_id, rank, <id_col>, score)``: for each row that ``query_filter`` (a condition
    on ``id``) picks, the k other rows with the highest integer inner product, ties to the
    smaller id; fewer where there are fewer.

    Rows with a null id or vector, an empty vector, or null or non-finite components take
    no part. A row of the query's own id is never its candidate. Repeated rows count once;
    vectors meet only those with as many dimensions. Components are to stay within 2 ** 24
    after scaling. An empty table gives an empty table. Other columns are not read.
    """
    valid = keep(integer_vectors(rows, id_col, vector, scale), "vectors")
    queries = keep(valid.where(query_filter), "queries")
    n_queries, n_valid = queries.count(), valid.count()
    number = F.row_number().over(Window.partitionBy("dim", "v").orderBy("id"))
    exact = keep(valid.withColumn("n", number).where(F.col("n") <= k + 1).drop("n"), "exact")
    edges = _cells(exact, bits)
    cells = _packed(exact, edges)
    n_blocks, runs = max(1, -(-n_queries // BLOCK)), max(1, -(-n_valid // (CHUNK * RUN)))
    in_block = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))

    def blocks(q: DataFrame) -> DataFrame:
        q = q.groupBy("dim", "block").agg(F.sort_array(F.collect_list(F.struct("id", "v", "least"))).alias("q"))  # about BLOCK rows
        return q.select("dim", "block", F.col("q.id").alias("qids"), F.col("q.v").alias("qvs"), F.col("q.least").alias("least"))

    none = F.lit(float("-inf"))
    lows = _scan(_met(cells, blocks(in_block.withColumn("least", none)), n_blocks, runs), edges, k, final=False)
    least = lows.groupBy("qid").agg(F.get(F.sort_array(F.flatten(F.collect_list("lows")), asc=False), F.lit(k - 1)).alias("least"))
    bounded = keep(in_block.join(least, F.col("id") == F.col("qid"), "left").select("id", "dim", "v", "block", F.coalesce("least", none).alias("least")), "bounded")
    found = keep(_scan(_met(cells, blocks(bounded), n_blocks, runs), edges, k, final=True), "candidates")

    turn = F.row_number().over(Window.partitionBy("qid").orderBy(F.col("high").desc(), "id"))
    found = keep(found.withColumn("turn", turn), "candidates")
    early = keep(_scored(found.where(F.col("turn") <= first * k), queries, exact), "early")
    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.col("score").desc(), "id"))
    certain = early.withColumn("rank", place).where(F.col("rank") == k).select(F.col("qid").alias("q"), F.col("score").alias("kth"))
    late = (found.where(F.col("turn") > first * k).join(certain, F.col("qid") == F.col("q"), "left")
            .where("kth IS NULL OR high >= kth").select("qid", "id"))
    scored = early.unionByName(_scored(late, queries, exact))
    return (scored.withColumn("rank", place).where(F.col("rank") <= k)
            .select(F.col("qid").alias("query_id"), "rank", F.col("id").alias(id_col), "score"))
