"""Phrase collocation mining by dynamic itemset counting.

Method. The corpus lies in ``shards`` that are scanned in turn, over and over. Words are
counted from the first scan on. As soon as both parts of a phrase (without its last, without
its first word) have reached the threshold, the phrase is active: it is counted from the next
scan on, beside the shorter ones, until each shard has been scanned once with it. Scans end
when nothing active is left. A part has reached the threshold when it has its share of it,
``least / shards``, in the shard just scanned: whatever reaches ``least`` in all has its
share in some shard, so no phrase is missed, and no scan waits for counts of the others.

Size. A scan sends on only windows whose parts are active, added up inside each task, as a
96-bit hash and a number. Which are active is told to the tasks by two bit filters of fixed
size: a false yes costs a row, never a result (the phrase's count comes out right or stays
below the threshold); a false no does not occur. A phrase counted twice in a shard has the
same number there. Words come back for the frequent phrases at the end, by one more look at
as few shards as hold them. Counts stay in tables; the driver sees the filters alone.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..fs import delete
from .common import keep, new_path, text_of

LONGEST = 5
BYTES = 1 << 20  # of text that a task looks at together
ROWS = 1 << 20  # counts a task holds before it adds them up
END, SPACE = ord("."), ord(" ")
# every piece delimiter becomes END, which no word holds; A-Z become a-z, tab a space
_BYTES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"." * 10 + b" abcdefghijklmnopqrstuvwxyz")
STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd numbers, one a hash
COUNTS = "h1 long, h2 int, n long"  # the last three bits of h2: words in the phrase
# a number for each byte and hash; bytes between words count nothing
_VALUE = np.random.default_rng(2).integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_VALUE[:, [END, SPACE]] = 0


def plain(text: str) -> bytes:
    """A text with its pieces ended by END and words parted by spaces."""
    return text.encode("utf-8", "replace").translate(_BYTES) + b"."


def _powers(n: int) -> np.ndarray:
    out = np.empty((2, n), np.uint64)
    for k in (0, 1):
        out[k, 0] = 1
        out[k, 1:] = STEP[1 - k]
        np.multiply.accumulate(out[k], out=out[k])
    return out


def _mixed(h: np.ndarray, lang: str, seed: int) -> np.ndarray:
    h = (h ^ np.uint64(xxhash.xxh64_intdigest(lang.encode(), seed + 2))) * STEP[seed]
    return (h ^ (h >> np.uint64(32))) * STEP[seed]


class Bits:
    """A set of hashes as a bit set; it may hold others too."""

    def __init__(self, bits: int, data: np.ndarray | None = None):
        self.bits, self.data = bits, np.zeros(1 << (bits - 3), np.uint8) if data is None else data

    def __getstate__(self) -> tuple:  # sent with every task's code: few bits are set in small ones
        return self.bits, zlib.compress(self.data.tobytes(), 1)

    def __setstate__(self, state: tuple) -> None:
        self.bits, self.data = state[0], np.frombuffer(zlib.decompress(state[1]), np.uint8)

    def __or__(self, other: Bits) -> Bits:
        return Bits(self.bits, self.data | other.data)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - self.bits)
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    @staticmethod
    def of(rows: DataFrame, bits: int) -> Bits:
        """The hashes ``h1`` of ``rows``; bits are joined by word before they come here."""
        slot = F.shiftrightunsigned("h1", 64 - bits)
        got = (rows.groupBy(F.shiftrightunsigned(slot, 6).alias("word"))
               .agg(F.expr(f"bit_or(shiftleft(1L, CAST(shiftrightunsigned(h1, {64 - bits}) & 63 AS INT)))").alias("bits")).toArrow())
        out = Bits(bits)
        out.data.view("<u8")[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
        return out


class _Windows:
    """The windows of some plain text of one language, by their hashes. A word's hash is the
    sum of its bytes' numbers, each times a power of its place."""

    def __init__(self, lang: str, text: bytes):
        b = np.frombuffer(text, np.uint8)
        end = b == END
        inside = ~end & (b != SPACE)
        begins = end.copy()
        begins[1:] |= inside[1:] & ~inside[:-1]
        begins[0] |= inside[0]
        self.start = np.flatnonzero(begins)
        b = b[self.start[0] :]
        place = np.arange(len(b), dtype=np.int32) - np.repeat((self.start - self.start[0]).astype(np.int32), np.diff(np.append(self.start, len(text))))
        power = _powers(int(place.max()) + 1)
        self.lang, self.text = lang, text
        self.word = [np.add.reduceat(_VALUE[k][b] * power[k][place], self.start - self.start[0]) for k in (0, 1)]
        self.is_word = ~end[self.start]
        self.words = int(np.count_nonzero(self.is_word))

    def _second(self, raw: np.ndarray, n: int) -> np.ndarray:
        return ((_mixed(raw, self.lang, 1) >> np.uint64(32)).astype(np.uint32) & np.uint32(0xFFFFFFF8) | np.uint32(n)).view(np.int32)

    def second(self, at: np.ndarray, n: int) -> np.ndarray:
        """The second hash of the windows of ``n`` words at these places."""
        raw = self.word[1][at]
        for k in range(1, n):
            raw = raw * STEP[1] + self.word[1][at + k]
        return self._second(raw, n)

    def by_length(self, known: Bits | None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """``(n, at, h1, old)`` for 1 to 5 words: windows inside a piece whose parts are both
        known (words: all; without ``known`` all windows), their first hash, and which of
        them are known. What has an unknown part is unknown, so windows get fewer."""
        at, raw = np.flatnonzero(self.is_word), self.word[0].copy()
        h1 = _mixed(raw[at], self.lang, 0)
        now = np.ones(len(at), bool) if known is None else known.has(h1)
        yield 1, at, h1, now
        old = np.zeros(len(raw), bool)
        old[at] = now
        for n in range(2, LONGEST + 1):
            at = np.flatnonzero(old[:-1] & old[1:])
            if not len(at):
                return
            r = raw[at] * STEP[0] + self.word[0][at + n - 1]
            h1 = _mixed(r, self.lang, 0)
            now = np.ones(len(at), bool) if known is None or n == LONGEST else known.has(h1)
            yield n, at, h1, now
            old = np.zeros(len(old) - 1, bool)
            old[at] = now
            raw[at] = r

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """The hash that the number of all words is counted under."""
        none = np.zeros(1, np.uint64)
        return _mixed(none, self.lang, 0), self._second(none, 0)

    def phrase(self, at: int, n: int) -> bytes:
        upto = self.start[at + n] if at + n < len(self.start) else len(self.text)
        return b" ".join(w for w in self.text[self.start[at] : upto].split(b" ") if w)


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[_Windows]:
    """The rows ``(lang, text)`` of a task, about ``BYTES`` of a language at a time."""
    held: defaultdict[str, list[bytes]] = defaultdict(list)
    size: defaultdict[str, int] = defaultdict(int)
    for b in batches:
        for i in range(b.num_rows):
            lang, text = b.column(0)[i].as_py(), plain(b.column(1)[i].as_py())
            held[lang].append(text)
            size[lang] += len(text)
            while sum(size.values()) > BYTES:  # the longest first; what is left is small
                most = max(size, key=size.get)
                del size[most]
                yield _Windows(most, b"".join(held.pop(most)))
    for lang in list(held):
        yield _Windows(lang, b"".join(held.pop(lang)))


class _Sums:
    """Counts by hash, added up whenever there are many."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, h1: np.ndarray, h2: np.ndarray, n: np.ndarray | None = None) -> None:
        self.held.append((h1, h2, np.ones(len(h1), np.int64) if n is None else n))
        self.size += len(h1)

    def close(self) -> None:
        """One row a hash."""
        h1, h2, n = (np.concatenate(x) for x in zip(*self.held))
        order = np.argsort(h1)
        k1, k2 = h1[order], h2[order]
        same = k1[1:] == k1[:-1]
        if (same & (k2[1:] != k2[:-1])).any():  # first hashes that meet: order by both
            order = np.lexsort((h2, h1))
            k1, k2 = h1[order], h2[order]
            same = (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1])
        first = np.flatnonzero(np.append(True, ~same))
        self.held = [(k1[first], k2[first], np.add.reduceat(n[order], first))]
        self.size = len(first)

    def batch(self) -> pa.RecordBatch:
        h1, h2, n = self.held[0]
        self.held, self.size = [], 0
        return pa.RecordBatch.from_pydict({"h1": pa.array(h1.view(np.int64)), "h2": pa.array(h2), "n": pa.array(n)})


def _scan(docs: DataFrame, known: Bits, recent: Bits, words: bool) -> DataFrame:
    """Counts of one shard: of words, and of windows both of whose parts are known, one of
    them only recently (a cycle ago at most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, some = _Sums(), recent.data.any()
        for w in _by_language(batches):
            if words:
                sums.add(*w.all(), np.array([w.words]))
            new = np.zeros(len(w.start), bool)
            for n, at, h1, old in w.by_length(known):
                if n == 1:
                    on = np.full(len(at), words)
                else:
                    on = new[at] | new[at + 1]
                if on.any():
                    sums.add(h1[on], w.second(at[on], n))
                if not some:
                    break
                new = np.zeros(len(new), bool)
                if n < LONGEST:
                    new[at[old]] = recent.has(h1[old])
            if sums.size > ROWS:
                sums.close()
                if sums.size > ROWS // 2:
                    yield sums.batch()
        if sums.size:
            sums.close()
            yield sums.batch()

    return docs.mapInArrow(run, COUNTS).groupBy("h1", "h2").agg(F.sum("n").alias("n"))


def _chosen(counts: DataFrame, chosen: Bits) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(chosen.has(b.column(0).to_numpy().view(np.uint64))))

    return counts.mapInArrow(run, counts.schema)


def _spelled(docs: DataFrame, frequent: Bits, wanted: Bits) -> DataFrame:
    """``(h1, h2, lang, phrase)`` of frequent windows that may be wanted, each once a task (and
    the empty phrase, for the number of all words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for w in _by_language(batches):
            h, g, text, ends = array("q"), array("i"), array("b"), array("i", [0])

            def put(h1: int, h2: int, phrase: bytes) -> None:
                h.append(h1)
                g.append(h2)
                text.frombytes(phrase)
                ends.append(len(text))

            none = w.all()
            put(int(none[0].view(np.int64)[0]), int(none[1][0]), b"")
            for n, at, h1, _ in w.by_length(frequent):
                hit = wanted.has(h1)
                at, h1 = at[hit], h1[hit]
                h1, k = np.unique(h1, return_index=True)
                at = at[k]
                fresh = np.fromiter((x not in seen for x in h1.tolist()), bool, len(h1))
                at, h1 = at[fresh], h1[fresh]
                seen.update(h1.tolist())
                for i, x, y in zip(at.tolist(), h1.view(np.int64).tolist(), w.second(at, n).tolist()):
                    put(x, y, w.phrase(i, n))
            yield pa.RecordBatch.from_pydict({"h1": pa.array(np.frombuffer(h, np.int64)), "h2": pa.array(np.frombuffer(g, np.int32)), "lang": pa.repeat(pa.scalar(w.lang), len(h)),
                                              "phrase": pa.StringArray.from_buffers(len(h), pa.py_buffer(ends), pa.py_buffer(text))})

    return docs.mapInArrow(run, "h1 long, h2 int, lang string, phrase string").dropDuplicates(["h1", "h2"])


def _written(spark: SparkSession, df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def count_phrases(docs: DataFrame, least: int, shards: int = 4, bits: int = 24) -> DataFrame:
    """``(lang, phrase, words, n)``: every phrase of 1 to 5 words of ``docs(lang, text)`` that
    occurs ``least`` times or more, and for each language of that many words the number of
    all words under the empty phrase (0 words)."""
    spark, gone = docs.sparkSession, []
    shelf = new_path(spark, "shards")
    rows = docs.select("lang", "text").withColumn("shard", F.pmod(F.xxhash64("text", F.rand(seed=3)), F.lit(shards)))
    rows.write.partitionBy("shard").parquet(shelf)
    kept = spark.read.schema("lang string, text string, shard int").parquet(shelf)
    shard = lambda s: kept.where(F.col("shard") == s).select("lang", "text")
    part = -(-least // shards)  # the share of one shard
    known, recent, reached, counts, tick = Bits(bits), [Bits(bits)], None, [], 0
    while tick < shards or any(x.data.any() for x in recent):
        now, path = _written(spark, _scan(shard(tick % shards), known, recent[0] if len(recent) == 1 else Bits(bits, np.bitwise_or.reduce([x.data for x in recent])), tick < shards), "counts")
        counts.append(now.withColumn("shard", F.lit(tick % shards)))
        gone.append(path)
        first = now.where(F.col("n") >= part).select("h1", "h2")
        if reached is not None:
            first = first.join(reached, ["h1", "h2"], "left_anti")
        first, path = _written(spark, first, "reached")
        gone.append(path)
        reached = first if reached is None else reached.unionByName(first)
        own = Bits.of(first.where(f"(h2 & 7) BETWEEN 1 AND {LONGEST - 1}"), bits)
        known, recent, tick = known | own, [*recent, own][-shards:], tick + 1
    every = counts[0]
    for c in counts[1:]:
        every = every.unionByName(c)
    of = [F.coalesce(F.max(F.when(F.col("shard") == s, F.col("n"))), F.lit(0)) for s in range(shards)]
    total = _chosen(every, Bits.of(reached, bits)).groupBy("h1", "h2").agg(sum(of[1:], of[0]).alias("n"))
    left, path = _written(spark, total.where(F.col("n") >= least), "frequent")
    gone.append(path)
    out, frequent = [], Bits.of(left, bits)
    for s in range(shards):  # nearly all are in the first
        found = left.join(_spelled(shard(s), frequent, Bits.of(left, bits)), ["h1", "h2"])
        found, path = _written(spark, found, "spelled")
        out.append(found)
        gone.append(path)
        left, path = _written(spark, left.join(found.select("h1", "h2"), ["h1", "h2"], "left_anti"), "left")
        gone.append(path)
        if left.isEmpty():
            break
    every = out[0]
    for x in out[1:]:
        every = every.unionByName(x)
    every = keep(every.select("lang", "phrase", (F.col("h2").bitwiseAND(7)).alias("words"), "n"), "phrases")
    for path in (shelf, *gone):
        delete(spark, path)
    return every


def _part(of: str, first, n) -> Column:
    return F.array_join(F.slice(of, first, n), " ")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, shards: int = 4, bits: int = 24) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: for each language the ``top`` phrases of 2
    to 5 words by score, ties to the higher count, then to the phrase first in byte order.

    ``a`` counts the phrase, ``n`` all words of the language. Of its cuts into two parts with
    counts ``l`` and ``r`` the one with the lowest ``floor(1000 * a * n / (l * r))`` is the
    score. Phrases under ``least`` are not candidates; those that occur only inside a longer
    candidate are dropped. A null text is empty, a null lang ``und``; repeated rows count as
    often as they come; a table without rows or phrases gives an empty table; other columns
    are not read.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of("text").alias("text"))
    f = count_phrases(rows, least, shards, bits)
    size = keep(f.where("words = 0").select("lang", "n"), "sizes")  # a row a language: small enough for Spark to send around
    cand = f.where("words >= 2").withColumn("w", F.split("phrase", " ", -1))
    # a longer phrase that occurs as often leaves nothing for the shorter one; it is enough to
    # look one word further, since every phrase between the two occurs as often as well
    inside = F.array(F.struct(_part("w", 1, F.col("words") - 1).alias("phrase")), F.struct(_part("w", 2, F.col("words") - 1).alias("phrase")))
    cover = (cand.where("words >= 3").select("lang", "n", F.explode(inside).alias("s")).groupBy("lang", F.col("s.phrase").alias("phrase")).agg(F.max("n").alias("cover")))
    cand = cand.join(cover, ["lang", "phrase"], "left").where("cover IS NULL OR cover < n")
    cuts = cand.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), "w", "words")
    cuts = cuts.select("lang", "phrase", "a", "k", _part("w", 1, F.col("k")).alias("first"), _part("w", F.col("k") + 1, F.col("words")).alias("rest"))
    one = f.where("words >= 1")
    cuts = (cuts.join(one.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
            .join(one.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
            .join(size, "lang"))
    score = F.expr("(CAST(a AS DECIMAL(16,0)) * 1000 * CAST(n AS DECIMAL(16,0))) DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r"))
    best = keep(best, "scored")
    # the best of a language are among the best of each of its lots, about the root of the rows many
    lots = max(1, math.isqrt(best.count() // top))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    place = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(lots))).orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (best.withColumn("place", place).where(F.col("place") <= top).withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
