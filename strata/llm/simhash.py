"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

Method. A fingerprint has 64 bits, cut into ``max_bits + agree`` blocks. Two fingerprints
that differ in at most ``max_bits`` bits agree in at least ``agree`` whole blocks, so each
fingerprint is filed once under every choice of ``agree`` blocks; candidates share such a
bucket and are verified by Hamming distance.

Size. Equal fingerprints are one node, so copies never meet each other. A bucket whose
members are more than a Hamming ball over the bits that vary in it (a dense cloud of near
copies) is not paired up: each member writes the points within half the distance, and
members that meet at a point are linked by a star. Both ways give the same components; the
second costs a fixed number of rows for each member instead of their square.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, keep
from .components import components

PIECE = 1 << 20  # bytes of one text hashed at a time: bounds memory, not the text


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces that end at white space."""
    at = 0
    while len(data) - at > PIECE:
        end = at + PIECE
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def simhash(data: bytes, shingle: int = 3) -> int:
    """Fingerprint (signed 64 bits) of a UTF-8 text: majority over the XXH64 bits of its
    word shingles, repeats included."""
    ones, n, carry, short = np.zeros(64, np.int64), 0, [], True
    digest = xxhash.xxh64_intdigest
    for piece in _pieces(data.lower()):  # bytes: lowers A-Z only, splits at ASCII white space
        ws = carry + piece.split()
        if len(ws) >= shingle:
            short = False
            h = np.fromiter((digest(x, 42) for x in map(b" ".join, zip(*(ws[i:] for i in range(shingle))))),
                            np.uint64, len(ws) - shingle + 1)
            for i in range(0, len(h), 65536):
                part = h[i:i + 65536]
                ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(h)
        carry = ws[-(shingle - 1):] if shingle > 1 else []
    if short and carry:  # fewer words than a shingle: the whole sequence is the one shingle
        ones, n = np.unpackbits(np.array([digest(b" ".join(carry), 42)], np.uint64).view(np.uint8), bitorder="little"), 1
    if not n:
        return 0
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fp", shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a last column ``name`` (bigint). A null
    text counts as empty; a text without words has fingerprint 0."""
    at = docs.columns.index(text)
    schema = T.StructType(docs.schema.fields + [T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(at).cast(pa.large_binary())
            fp = pa.array([simhash(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle) for x in col], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, fp], names=[*b.schema.names, name])

    return docs.mapInArrow(run, schema)


def _blocks(max_bits: int, agree: int) -> list[int]:
    """Bit masks of every choice of ``agree`` of the ``max_bits + agree`` blocks."""
    n = max_bits + agree
    cut = [64 * i // n for i in range(n + 1)]
    block = [sum(1 << k for k in range(cut[i], cut[i + 1])) for i in range(n)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(sum(c)) for c in combinations(block, agree)]


def links(nodes: DataFrame, max_bits: int = 3, agree: int = 2) -> DataFrame:
    """Links ``(a, b)`` over distinct fingerprints ``nodes(fp)`` whose components are those
    of "differ in at most ``max_bits`` bits". ``agree`` sets the key width: 2 gives ten
    copies under some 26 bits, 3 gives twenty under 32 (for over 10^10 fingerprints)."""
    if not 1 <= max_bits <= 4:
        raise ValueError("max_bits must be 1 to 4")
    masks = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("c"), F.lit(m).alias("mask"))
                      for i, m in enumerate(_blocks(max_bits, agree))])
    filed = (nodes.select("fp", F.explode(masks).alias("k"))
             .select(F.col("k.c").alias("c"), F.col("fp").bitwiseAND(F.col("k.mask")).alias("key"), "fp"))
    buckets = (filed.groupBy("c", "key")
               .agg(F.count(F.lit(1)).alias("m"), F.bit_or("fp").alias("hi"), F.bit_and("fp").alias("lo"))
               .where("m > 1").withColumn("vary", F.col("hi").bitwiseXOR(F.col("lo")))
               .withColumn("v", F.bit_count("vary").cast("long")))
    far, near = (max_bits + 1) // 2, max_bits // 2  # a pair meets at a point this far from its ends
    ball = F.lit(1) + F.col("v") + (F.col("v") * (F.col("v") - 1) / 2 if far == 2 else 0)
    buckets = buckets.select("c", "key", "vary", (F.col("m") > 2 * ball).alias("dense"))
    met = keep(filed.join(buckets, ["c", "key"]), "buckets")

    thin = met.where("NOT dense").select("c", "key", "fp")
    other = thin.withColumnRenamed("fp", "fp2")
    pairs = (thin.join(other, ["c", "key"])
             .where((F.col("fp") < F.col("fp2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= max_bits))
             .select(F.col("fp").alias("a"), F.col("fp2").alias("b")))

    cloud = met.where("dense").groupBy("fp").agg(F.bit_or("vary").alias("vary"))
    one = F.lit(1).cast("long")
    flips = F.filter(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", one, i)),
                     lambda b: b.bitwiseAND(F.col("vary")) != 0)
    cloud = cloud.withColumn("flips", flips)
    point = lambda z, close: F.struct(z.alias("z"), F.lit(close).alias("near"))
    points = [F.array(point(F.col("fp"), True)),
              F.transform("flips", lambda i: point(F.col("fp").bitwiseXOR(i), near >= 1))]
    if far == 2:
        points.append(F.flatten(F.transform("flips", lambda i, k: F.transform(
            F.slice("flips", 1, k), lambda j: point(F.col("fp").bitwiseXOR(i).bitwiseXOR(j), near >= 2)))))
    points = cloud.select("fp", F.explode(F.concat(*points)).alias("p")).select("fp", "p.z", "p.near")
    hubs = (points.groupBy("z").agg(F.min("fp").alias("hub"), F.max("fp").alias("last"), F.bool_or("near").alias("near"))
            .where("near AND hub <> last").select("z", "hub"))
    stars = points.join(hubs, "z").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()
    return pairs.union(stars)


def _classes(fps: DataFrame, max_bits: int, agree: int) -> DataFrame:
    """``fps(id, fp)`` -> ``(fp, root, component_id)`` of every distinct fingerprint."""
    nodes = keep(fps.groupBy("fp").agg(F.min("id").alias("rep")), "nodes")
    roots = components(links(nodes.select("fp"), max_bits, agree))
    linked = (nodes.join(roots, nodes.fp == roots.node, "left")
              .select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    least = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    return linked.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 3, agree: int = 2) -> DataFrame:
    """One row for each row of ``docs``: id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id among the documents reachable over links of at most
    ``max_bits`` differing bits (itself included).

    Null and empty texts have fingerprint 0 and are linked like any other. A null id is
    carried and never chosen as a component id (a component without any other id has
    null). Repeated rows stay repeated. Other columns are not read. An empty table gives
    an empty table.
    """
    fps = keep(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), shingle=shingle)
               .select("id", "fp"), "fingerprints")
    return (fps.join(_classes(fps, max_bits, agree), "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                         max_bits: int = 3, agree: int = 2) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id (a null id
    only where there is no other; among equal ids the smallest fingerprint, then any one
    of the rows, which have the same fingerprint). Columns are unchanged."""
    fp, key = free_name(docs, "fp"), free_name(docs, "key")
    id_key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    fps = keep(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), shingle=shingle)
               .select("id", "fp"), "fingerprints")
    chosen = (fps.join(_classes(fps, max_bits, agree), "fp").groupBy("root")
              .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("first"))
              .select(id_key("first.id").alias(key), F.col("first.fp").alias(fp)))
    # fingerprints are made again beside the texts, which so need not be written
    marked = with_fingerprint(docs, text, fp, shingle).withColumn(key, id_key(id_col))
    return marked.join(chosen, [key, fp], "left_semi").dropDuplicates([key, fp]).select(*docs.columns)
