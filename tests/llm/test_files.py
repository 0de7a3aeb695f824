"""WARC, packing and top-k against brute-force versions."""

import glob
import gzip
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import packing, topk, warc

from .conftest import SMALL

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# --- WARC

def brute_warc(rows):
    top = defaultdict(list)
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 1000:
            top[html].append(i)
    out = []
    for i, _, html in rows:
        b = (html or "").encode()
        t = max(top.get(html, [i]) if i is not None or top.get(html) else [None], key=lambda x: (x is not None, x))
        rev = t is not None and i is not None and t != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if rev else "response", t if rev else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark, monkeypatch, tmp_path):
    a, b = "é<b>" * 400, "x" * 1000
    rows = [(1, "http://a/ \r\nX: y", a), (2, None, a), (3, "u", a), (4, "u", b), (9, "u", b), (9, "u", b), (5, "", None), (6, "u", ""), (7, "u", ""),
            (8, "u", "y" * 999), (10, "u", "y" * 999), (11, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 3), (12, "u", "z" * 300000), (None, "u", "n" * 2000), (13, "u", "x" * 999)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit("clash")).repartition(3)
    monkeypatch.setattr(warc, "CHUNK", 700)
    monkeypatch.setattr(warc.chunk_rows, "__defaults__", (700,))
    monkeypatch.setattr(warc.read_archives, "__defaults__", (700, True))
    got = warc.round_trip(pages, folder=str(tmp_path / "a")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_warc(rows)
    files = glob.glob(str(tmp_path / "a/*.warc.gz"))
    assert files and not [f for f in glob.glob(str(tmp_path / "a/*")) if f not in files]
    assert sum(gzip.open(f).read().count(b"WARC-Record-ID") for f in files) == len(rows)
    whole = warc.read_archives(spark.createDataFrame([(f,) for f in files], "file string"), f"file://{tmp_path}/a").collect()
    parts = defaultdict(dict)
    for r in whole:
        parts[r.record][r.chunk] = bytes(r.data)
        assert len(r.data) <= 700 and (not r.last or r.type == "revisit" or r.digest_so_far == r.header_digest)
    texts = {b"".join(p[k] for k in sorted(p)).decode() for p in parts.values()}
    assert texts == {r[2] or "" for r in rows}
    assert warc.round_trip(pages.where("false")).count() == 0


def test_warc_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str) == brute_warc(rows)


def test_a_damaged_archive_is_found(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 5000)], "page_id long, url string, html string")
    warc.round_trip(pages, folder=str(tmp_path / "a"))
    (f,) = glob.glob(str(tmp_path / "a/*.warc.gz"))
    data = gzip.open(f).read().replace(b"x" * 100, b"x" * 99 + b"y", 1)
    with gzip.open(f, "wb") as out:
        out.write(data)
    with pytest.raises(Exception, match="digest says"):
        warc.read_archives(spark.createDataFrame([(f,)], "file string"), f"file://{tmp_path}/a").count()


# --- packing

def brute_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    return {i: [*t.encode(x or "", add_special_tokens=False).ids, 2] for i, x in texts.items()}


def check_pieces(rows, ids, length):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.length == len(part) > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.asarray(part, "<u4").tobytes())
    for i, x in ids.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(x)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length and at & (at - 1) == 0  # full, or a power of two: nothing is padded


@pytest.mark.parametrize("length", [4096, 64])
def test_packing(docs, texts, length):
    check_pieces(packing.pack(docs, TOKENIZER, length=length).collect(), brute_ids(texts), length)


def test_packing_odd_rows(spark, odd_docs, no_docs):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "x" * 5000), (5, "a\u0301 \u0301b ΑΣ İ \x1cq\x85 it's 's 12 <|endoftext|>x \u2003y"), (6, "w " * 30000), (None, "x y")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1))
    pieces = packing.pack(d, TOKENIZER, length=256, with_ids=True)
    check_pieces(pieces.collect(), brute_ids(dict(rows)), 256)
    assert sum(len(r.ids) for r in packing.sequences(pieces).collect()) == sum(map(len, brute_ids(dict(rows)).values()))
    assert packing.pack(no_docs, TOKENIZER).count() == 0
    got = packing.pack(odd_docs, TOKENIZER)
    assert got.where("start = 0").count() == odd_docs.count()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=" \n\t\x0b\x1c\x85\u00a0\u0301\u0345aAÀÿß×÷µªΣς'srevmld1²<|>!.\x7f\xa0\xad", max_size=60))
def test_ids_by_word_are_the_text_s(t):
    own = packing._tokens(TOKENIZER)
    for text in ("It's  <|x|> don't\tstop 'S 're''ve", "İstanbul ǅ éte ÀÉ ß \x85 \x1c x\x00y", " \n ", "a" * 50000,
                 "x " * 40000 + "あい <|endoftext|> tail", "\n".join(["1234 ab'll"] * 9000), "µ ª º ÷ × ¿¡"):
        got = np.frombuffer(own.encode(text, 2), own.kind).tolist()
        assert got == [*own.of.encode(text, add_special_tokens=False).ids, 2]
    assert own.by_part
    assert np.frombuffer(own.encode(t, 2), own.kind).tolist() == brute_ids({0: t})[0]


def test_words_are_forgotten_in_turn():
    made = []
    r = packing._Remembered(lambda k: made.append(k) or k.encode(), 3)
    assert [r[k] for k in "abcabcdeabz"] == [k.encode() for k in "abcabcdeabz"] and len(r) + len(r.old) <= 6
    assert made == list("abcdez")


def test_hilbert_curve_visits_neighbours():
    bits = 3
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = packing.hilbert(grid, bits)
    assert sorted(key) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


# --- top-k

def brute_top(rows, k=5):
    v = {}
    for i, x in rows:
        if i is not None and x and all(c is not None and np.isfinite(c) for c in x):
            v.setdefault((i, tuple(int(np.floor(256 * float(c))) for c in x)), None)
    out = []
    for i, x in v:
        if i % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y in v if j != i and len(x) == len(y))
            out += [(i, n + 1, j, -z) for n, (z, j) in enumerate(s[:k])]
    return sorted(out)


def got_top(df, **o):
    return sorted(tuple(r) for r in topk.top_k(df, F.col("id") % 50 == 0, **o).collect())


def test_top_k(spark):
    e = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    for bits in (1, 6):
        assert got_top(e, bits=bits) == brute_top(rows)


def test_top_k_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 50)
    monkeypatch.setattr(topk, "RUN", 2)
    monkeypatch.setattr(topk, "BLOCK", 4)
    rnd = random.Random(8)
    vec = lambda n=4: [float(np.float32(rnd.choice([-0.5, 0.25, 0.5, rnd.random()]))) for _ in range(n)]
    hot = vec()
    rows = [(i, hot if i % 3 == 0 else vec()) for i in range(400)] + [(1000 + i, vec(3)) for i in range(3)] + [(1050, vec(3)), (1100, [])]
    rows += [(500, None), (550, [0.1, None, 0.2, 0.3]), (600, [0.1, float("nan"), 0.2, 0.3]), (650, [float("inf")] * 4), (None, vec()), (50, rows[50][1]), (7, rows[7][1])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    assert got_top(d) == brute_top(rows)
    assert got_top(d.where("vec_id IN (50, 51, 52)")) == brute_top([r for r in rows if r[0] in (50, 51, 52)])
    assert got_top(d.where("false")) == []
