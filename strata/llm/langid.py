"""Language identification by error-correcting output codes.

Method. Each language has a codeword of +1 and -1. For every bit a binary classifier of
character n-grams (log-odds between the languages on either side, each language weighing the
same) says from -1 to 1 which side a text is on. Decoding compares these outputs with every
codeword: the exponential loss of each bit, weighted by how often that bit was right on the
language's own training texts, is added up, and the codeword of least loss wins. Where the
second is nearly as close, the text is flagged ambiguous.

Size. Training counts n-grams in ``2 ** bits`` hashed cells per language, inside the tasks,
then over them: rows shuffled are at most tasks x languages x cells. The model is one row of
weights a cell, whatever the corpus. Texts are read twice: to count, and to score.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep

ORDERS = 4  # n-grams of 1 to 4 characters
PIECE = 1 << 19  # code points without a space looked at together
HELD = 1 << 16  # code points looked at together where spaces allow
ROWS = 512  # texts decoded together
UNKNOWN = "und"


# --- features

@cache
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, 0 for anything but a letter."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, str]]:
    """``(row, part of its text)``; long texts are cut at a space, where n-grams end anyway."""
    for i, text in enumerate(texts):
        at, text, held = 0, text or "", min(HELD, PIECE)
        while len(text) - at > held:
            cut = text.rfind(" ", at, at + held) + 1 or text.find(" ", at + held, at + PIECE) + 1 or at + PIECE
            yield i, text[at:cut]
            at = cut
        yield i, text[at:]


def grams(texts: list[str | None], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row, cell)`` of every n-gram, in runs of about ``HELD`` code points.

    Words are runs of letters, lower-cased, with a mark at both ends; an n-gram lies within
    a word and its marks, and is more than a mark."""

    def run(held: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
        joined = "\n" + "\n".join(t for _, t in held) + "\n"
        code = _letters()[np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")]
        row = np.concatenate([[0], np.repeat(np.array([i for i, _ in held]), [len(t) + 1 for _, t in held])])
        on = np.append(True, (code[1:] != 0) | (code[:-1] != 0))  # one mark between words
        code, row = code[on].astype(np.uint64), row[on]
        rows, cells = [], []
        h, inner = np.zeros(len(code), np.uint64), np.ones(len(code), bool)
        for n in range(1, ORDERS + 1):
            m = len(code) - n + 1
            if m <= 0:
                break
            h = h[:m] * np.uint64(0x100000001B3) + code[n - 1 :] + np.uint64(n)
            if n > 2:
                inner = inner[:m] & (code[n - 2 : n - 2 + m] != 0)
            at = np.flatnonzero(code != 0 if n == 1 else inner[:m])
            rows.append(row[at + (n > 1)])  # its second character is surely of the text
            cells.append((h[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits))
        return np.concatenate(rows), np.concatenate(cells).astype(np.int64)

    held, size = [], 0
    for i, piece in _pieces(texts):
        if held and size + len(piece) > min(HELD, PIECE):
            yield run(held)
            held, size = [], 0
        held.append((i, piece))
        size += len(piece) + 1
    if held:
        yield run(held)


# --- codes

def codebook(languages: int, seed: int = 7) -> np.ndarray:
    """Codewords, language by bit, of +1 and -1. Up to five languages every way to part them
    is a bit; beyond, the widest of 200 random books of 10 log2(languages) bits."""
    if languages < 2:
        return np.zeros((languages, 0), np.int8)
    if languages <= 5:
        sides = [s for s in itertools.product((1, -1), repeat=languages) if s[0] == 1 and -1 in s]
        return np.array(sides, np.int8).T
    rnd, best, wide = np.random.default_rng(seed), None, -1
    for _ in range(200):
        book = rnd.choice(np.array([-1, 1], np.int8), (languages, int(np.ceil(10 * np.log2(languages)))))
        same = book.astype(int) @ book.T
        least = int((book.shape[1] - (same - 2 * book.shape[1] * np.eye(languages)).max()) // 2)
        if least > wide and (np.abs(book.sum(axis=0)) < languages).all():
            best, wide = book, least
    return best


class Model:
    """Languages, their codewords, the bits' weights a cell, and (later) the trust in each bit."""

    def __init__(self, languages: list[str], bits: int, cells: np.ndarray, trust: np.ndarray | None = None):
        self.languages, self.bits, self.cells, self.trust = languages, bits, cells, trust
        self.book = codebook(len(languages))

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Outputs of the bits' classifiers (-1 to 1), text by bit, and the number of n-grams."""
        total, n = np.zeros((len(texts), self.cells.shape[1])), np.zeros(len(texts), np.int64)
        for rows, cells in grams(texts, self.bits):
            n += np.bincount(rows, minlength=len(texts))
            for b in range(self.cells.shape[1]):
                total[:, b] += np.bincount(rows, self.cells[:, b][cells], len(texts))
        return np.tanh(total / (2 * np.sqrt(np.maximum(n, 1)))[:, None]), n

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text the nearest codeword, the second, and 1 - loss of the first / second."""
        loss = np.stack([(w * np.exp(-code * margins)).sum(axis=1) for w, code in zip(self.trust, self.book)], axis=1)
        order = np.argsort(loss, axis=1, kind="stable")
        first, second = order[:, 0], order[:, 1]
        at = np.arange(len(loss))
        return first, second, 1 - loss[at, first] / loss[at, second]


# --- over all rows

def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, ``ROWS`` at a time: a task holds the Python texts of so many only."""
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def _count(train: DataFrame, languages: list[str], bits: int) -> DataFrame:
    """``(lang, cell, n)``: n-grams of the training texts, added up inside each task first."""
    number = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(languages), 1 << bits), np.int64)
        flat = held.reshape(-1)
        for b in _few(batches):
            lang = np.array([number[x] for x in b.column(1).to_pylist()], np.int64)
            for rows, cells in grams(b.column(0).to_pylist(), bits):
                np.add.at(flat, (lang[rows] << bits) + cells, 1)  # in place: no second table
        for i, counts in enumerate(held):
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array(np.full(len(at), i, np.int32)), "cell": pa.array(at.astype(np.int32)), "n": pa.array(counts[at])})

    return train.select("text", "lang").mapInArrow(run, "lang int, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, bits: int = 18, smooth: float = 0.5) -> Model:
    """A model from all rows of ``labelled(text, lang)`` whose ``lang`` is not null.

    Null and empty texts teach nothing; repeated rows count as often as they come. Without
    rows the model knows no language and predicts none."""
    labelled = labelled.where("lang IS NOT NULL").select(F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    languages = sorted(r[0] for r in labelled.select("lang").distinct().collect())
    book = codebook(len(languages))
    if not book.size:
        return Model(languages, bits, np.zeros((1 << bits, 0), np.float32), np.zeros(book.shape))
    counts = keep(_count(labelled, languages, bits), "grams")
    size = np.full(len(languages), smooth * (1 << bits))
    for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect():
        size[r["lang"]] += r["n"]
    # a cell's share of each language's n-grams; sides of a bit are means over their languages
    share = F.col("n") / F.element_at(F.array(*map(F.lit, size.tolist())), F.col("lang") + 1)
    floor = smooth / size

    def side(b: int, sign: int) -> Column:
        own = np.flatnonzero(book[:, b] == sign)
        seen = F.sum(F.when(F.col("lang").isin(own.tolist()), share).otherwise(F.lit(0.0)))
        return (seen + F.lit(float(floor[own].sum()))) / F.lit(len(own))

    odds = F.array(*(F.log(side(b, 1) / side(b, -1)).cast("float") for b in range(book.shape[1])))
    cells = np.zeros((1 << bits, book.shape[1]), np.float32)  # unseen cells say nothing
    got = counts.groupBy("cell").agg(odds.alias("w")).toArrow()
    cells[got.column("cell").to_numpy()] = got.column("w").combine_chunks().flatten().to_numpy().reshape(-1, book.shape[1])
    return Model(languages, bits, cells)


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs(text, ...)`` with the bits' outputs in place of the text."""
    others = [c for c in docs.columns if c != "text"]
    schema = docs.select(*others, F.lit(None).cast("array<float>").alias("margins"), F.lit(None).cast("long").alias("grams")).schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _few(batches):
            m, n = model.margins(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns) if i != at), pa.array(list(m.astype(np.float32)), pa.list_(pa.float32())), pa.array(n)],
                                             names=[*others, "margins", "grams"])

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", bits: int = 18, close: float = 0.05) -> DataFrame:
    """``(<id_col>, held_out, lang_pred, score, ambiguous, second)`` of every row of
    ``docs(<id_col>, text, lang)``.

    ``learn_from`` (a condition; null counts as false) picks the rows that teach, those with a
    null ``lang`` aside; ``held_out`` is its opposite. A prediction sees the text alone. Texts
    that are null or without a letter, and all texts if no language was learned, are ``und``
    with score 0. ``score`` is 1 - loss of the nearest codeword / loss of the second (1 where
    only one language was learned), ``ambiguous`` a score under ``close``, ``second`` the
    second language. Equal losses go to the language first in the alphabet. Repeated rows and
    null ids are kept; an empty table gives an empty table; other columns are not read. A
    run of over half a million characters without a space is cut into such runs.
    """
    rows = docs.select(F.col(id_col).alias("id"), "text", F.col("lang").cast("string").alias("lang"), (~F.coalesce(learn_from, F.lit(False))).alias("held_out"))
    model = train(rows.where("NOT held_out"), bits)
    scored = keep(_scored(rows, model), "margins")
    if model.book.size:
        right = [F.avg((F.get("margins", F.lit(b)) * F.element_at(F.array(*map(F.lit, model.book[:, b].tolist())), F.col("l") + 1) > 0).cast("double")).alias(f"b{b}") for b in range(model.book.shape[1])]
        number = F.element_at(F.create_map(*(F.lit(v) for x in enumerate(model.languages) for v in (x[1], x[0]))), F.col("lang"))
        trust = np.ones(model.book.shape)
        for r in scored.where("NOT held_out AND lang IS NOT NULL AND grams > 0").withColumn("l", number).groupBy("l").agg(*right).collect():
            trust[r["l"]] = [r[f"b{b}"] for b in range(trust.shape[1])]
        total = trust.sum(axis=1, keepdims=True)
        model.trust = np.where(total > 0, trust / np.where(total > 0, total, 1), 1 / trust.shape[1])
    names, book, weights, n_bits = model.languages, model.book, model.trust, model.bits
    id_type = scored.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Model(names, n_bits, np.zeros((1, 0), np.float32), weights)
        for b in batches:
            have = b.column(3).to_numpy(zero_copy_only=False) > 0
            pred, score, second = np.full(len(have), UNKNOWN, object), np.zeros(len(have)), np.full(len(have), None, object)
            if book.size:
                m = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, book.shape[1]).astype(float)
                one, two, by = decoder.decode(m)
                named = np.array(names, object)
                pred, score, second = np.where(have, named[one], UNKNOWN), np.where(have, by, 0.0), np.where(have, named[two], None)
            elif names:
                pred, score = np.where(have, names[0], UNKNOWN), have.astype(float)
            yield pa.RecordBatch.from_pydict({"id": b.column(0), "held_out": b.column(1), "lang_pred": pa.array(pred, pa.string()), "score": pa.array(score),
                                              "ambiguous": pa.array((score < close) & have), "second": pa.array(second, pa.string())})

    out = scored.select("id", "held_out", "margins", "grams").mapInArrow(run, f"id {id_type}, held_out boolean, lang_pred string, score double, ambiguous boolean, second string")
    return out.withColumnRenamed("id", id_col)
