"""Packing documents into fixed-length sequences along a space-filling curve.

Method. Each document's token counts, hashed to a vector, are projected to three
coordinates; these, scaled by the corpus' mean and deviation, give a key on a Hilbert
curve. Documents are ranged by that key and laid end to end, so neighbours along the curve
share sequences. A sequence is the next ``length`` tokens of that line; the remainder at
its end is cut into sequences of falling powers of two. So nothing is padded.

Size. Token ids are made once and kept in the shared folder; only (row, key, count) is
ranged and summed (range sums, then places inside a range), and ids move once, to meet
their place. A document's pieces depend on nothing but its place.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, text_of

DIMS, BITS, FEATURES = 3, 16, 256
MOST_WORDS, MOST_PARTS = 40_000, 120_000  # whose ids a Python worker remembers (up to twice as many)
LONG_WORD = 200  # longer words are not remembered
STRETCH = 1 << 14  # characters of a text looked at together: bounds memory, not the text

# Fixed values of the vocabulary's own format: how it splits a text, and the part of that
# which can be said over lower-case ASCII and Latin-1 words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PART = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
SIMPLE = re.compile(r"[\n -~À-ÖØ-öø-ÿ]*")
GAP = re.compile("[\n ]")


def _stretches(text: str) -> Iterator[str]:
    """``text`` in stretches that end at white space (which has no ids, and is left out)."""
    at = 0
    while len(text) - at > STRETCH and (gap := GAP.search(text, at + STRETCH)):
        yield text[at:gap.start()]
        at = gap.end()
    yield text[at:] if at else text


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1
    characters for themselves, the other bytes, in order, for those from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in own)}


class _Remembered(dict):
    """Values by key, made when missing; keeps between one and two times ``most``, those
    used last."""

    def __init__(self, make, most: int):
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > LONG_WORD:
                return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class _Tokens:
    """Token ids. White space separates tokens in these vocabularies, so the ids of a text
    are those of its words, and most words of a corpus come again. A stretch of simple
    letters is made of its parts (letters, a digit, other signs), which come again still
    more often, where the file splits texts as SPLIT says."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.of = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.of.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            how = json.load(f)
        first = (how.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        lowers = [n.get("type") for n in (how.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.by_part = lowers and first.get("pattern", {}).get("Regex") == SPLIT
        self.letters, self.code = _byte_letters(), "H" if self.kind.itemsize == 2 else "I"
        self.model = self.of.model
        self.parts, self.words = _Remembered(self._part, MOST_PARTS), _Remembered(self._word, MOST_WORDS)

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def _part(self, part: str) -> bytes:
        part = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return self._packed([t.id for t in self.model.tokenize(part)])

    def _word(self, word: str) -> bytes:
        return self._packed(self.of.encode(word, add_special_tokens=False).ids)

    def _ids(self, stretch: str) -> bytes:
        if self.by_part and SIMPLE.fullmatch(stretch) and "<|" not in stretch:
            return b"".join(map(self.parts.__getitem__, PART.findall(stretch.lower())))
        if GAP.search(stretch):  # only the words that are not simple need the whole tokenizer
            return b"".join(map(self._ids, GAP.split(stretch)))
        return self.words[stretch]

    def encode(self, text: str, end: int) -> bytes:
        return b"".join(map(self._ids, _stretches(text))) + self._packed([end])


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of one of the installed public vocabularies."""
    import public_tokenizers
    return public_tokenizers.path(name)


_LOADED: dict[str, _Tokens] = {}


def _tokens(path: str) -> _Tokens:
    """The tokenizer, loaded once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = _Tokens(path)
    return _LOADED[path]


def _projection() -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token id (by a multiplicative hash) and the fixed directions."""
    ids = np.arange(1 << 16, dtype=np.uint64)
    bucket = ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.int64)
    return bucket, np.random.default_rng(5).standard_normal((FEATURES, DIMS))


def tokenize(docs: DataFrame, tokenizer: str, id_col: str, text: str, end: int) -> DataFrame:
    """``(rid, id, tokens, ids, place)``: a row number (fixed once written), the ids as packed
    little-endian integers, and the projected vector."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("rid", T.LongType()), T.StructField("id", id_type), T.StructField("tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType()), *[T.StructField(f"p{i}", T.DoubleType()) for i in range(DIMS)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, (bucket, to) = _tokens(tokenizer), _projection()
        rid = TaskContext.get().partitionId() << 40
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids = [tok.encode(x, end) for x in part.column(1).to_pylist()]
                place = np.zeros((len(ids), DIMS))
                for i, x in enumerate(ids):
                    v = np.log1p(np.bincount(bucket[np.frombuffer(x, tok.kind) & 0xFFFF], minlength=FEATURES))
                    place[i] = (v / np.linalg.norm(v)) @ to
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(rid, rid + n)), part.column(0), pa.array([len(x) // tok.kind.itemsize for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()), *[pa.array(place[:, i]) for i in range(DIMS)]], names=schema.names)
                rid += n

    return docs.select(F.col(id_col).alias("id"), text_of(text).alias("text")).mapInArrow(run, schema)


def hilbert(grid: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of rows of ``grid`` (integers below 2 ** bits)."""
    x = grid.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations of the sub-cubes, from the coarsest
        for i in range(n):
            low = (x[i] & q) == 0
            swap = np.where(low, (x[0] ^ x[i]) & (q - 1), 0)
            x[0] ^= np.where(low, swap, q - 1)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _keyed(tokens: DataFrame) -> DataFrame:
    """``(rid, tokens, key)``."""
    names = [f"p{i}" for i in range(DIMS)]
    s = tokens.agg(*[f(n).alias(f"{k}{n}") for n in names for k, f in (("m", F.avg), ("d", F.stddev_pop))]).first()
    mean, dev = (np.array([s[f"{k}{n}"] or 0.0 for n in names]) for k in "md")

    @F.pandas_udf("long")
    def key(*p: pd.Series) -> pd.Series:
        z = (np.stack([np.asarray(x) for x in p], axis=1) - mean) / np.where(dev > 0, dev, 1.0)
        return pd.Series(hilbert(np.minimum((1 / (1 + np.exp(-1.7 * z)) * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)))

    return tokens.select("rid", "tokens", key(*names).alias("key"))


def _places(tokens: DataFrame) -> tuple[DataFrame, int]:
    """``(rid, at)``: the place of each row's first token on the line; and the line's length."""
    ranged = keep(_keyed(tokens).repartitionByRange("key", "rid").withColumn("part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("part").agg(F.sum("tokens").alias("n"))  # one row for each range
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    own = Window.partitionBy("part").orderBy("key", "rid").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("own", F.sum("tokens").over(own) - F.col("tokens")).join(before, "part")
    return placed.select("rid", (F.col("before") + F.col("own")).alias("at")), sums.agg(F.sum("n")).first()[0] or 0


def _ends(total: int, length: int) -> list[int]:
    """Where the sequences after the last full one end."""
    at, out = total // length * length, []
    for b in reversed(range(length.bit_length())):
        if (total - total // length * length) >> b & 1:
            at += 1 << b
            out.append(at)
    return out


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", length: int = 4096, end: int = 2,
         with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document: id, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` (and ``ids``, with ``with_ids``).

    ``tokenizer``: a file for the tokenizers library whose tokens end at white space;
    ``end`` closes every document, so a null or empty text is one token. Null ids and
    repeated rows are carried, each packed on its own. An empty table has no pieces. Other
    columns are not read.
    """
    tokens = keep(tokenize(docs, tokenizer, id_col, text, end), "tokens")
    places, total = _places(tokens)
    full, ends = total // length, _ends(total, length)
    starts = [full * length, *ends]
    id_type = docs.schema[id_col].dataType
    fields = [T.StructField(id_col, id_type), *[T.StructField(n, T.LongType()) for n in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def pieces(at: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        """(start in the document, length, sequence, offset in it)"""
        pos = at
        while pos < at + n:
            if pos < full * length:
                seq, first = pos // length, pos // length * length
                stop = first + length
            else:
                k = int(np.searchsorted(ends, pos, side="right"))
                seq, first, stop = full + k, starts[k], ends[k]
            stop = min(stop, at + n)
            yield pos - at, stop - pos, seq, pos - first
            pos = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            which, out, ids = [], [], []
            for i, (n, at, raw) in enumerate(zip(*(b.column(k).to_pylist() for k in (1, 2, 3)))):
                x = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4")
                for start, size, seq, offset in pieces(at, n):
                    part = x[start:start + size]
                    which.append(i)
                    out.append((start, size, zlib.crc32(part.tobytes()), n, seq, offset))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            if out:
                cols = [b.column(0).take(pa.array(which)), *[pa.array(c, pa.int64()) for c in zip(*out)]]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), names=schema.names)

    return tokens.select("rid", "id", "tokens", "ids").join(places, "rid").select("id", "tokens", "at", "ids").mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """``pack(..., with_ids=True)`` -> ``(sequence_id, ids)``, at most ``length`` ids each."""
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
