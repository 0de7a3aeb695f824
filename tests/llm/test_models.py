"""Whitening, language identification and phrase mining against brute-force versions."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import langid, phrases, whitening
from strata.llm.queries import QUERIES

from .conftest import SMALL

# --- whitening


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10**6), st.sampled_from(["wide", "equal", "zero", "axis"]))
def test_a_rank_one_update_keeps_the_decomposition(dim, seed, kind):
    r = np.random.default_rng(seed)
    lam = np.sort(r.random(dim) * 10.0 ** r.integers(-8, 8, dim)) if kind == "wide" else np.repeat(2.0, dim)
    if kind == "zero":
        lam[: dim // 2] = 0
    u = np.linalg.qr(r.normal(size=(dim, dim)))[0]
    v = 3 * u[:, 0] if kind == "axis" else r.normal(size=dim) * 10.0 ** r.integers(-6, 6)
    want = u @ np.diag(lam) @ u.T + np.outer(v, v)
    got, q = whitening.rank_one(lam, u, v)
    assert (np.diff(got) >= 0).all() and np.abs(q.T @ q - np.eye(dim)).max() < 1e-12
    assert np.abs(q @ np.diag(got) @ q.T - want).max() <= 1e-12 * np.abs(want).max()


def test_roots_lie_between_the_poles():
    d, w = np.array([0.0, 1.0, 1.0 + 1e-12, 5.0]), np.array([1e-20, 1.0, 2.0, 1e-3])
    roots = d[None, :] - whitening.secular_roots(d, w)
    root = np.array([row[np.abs(row - d).argmin()] for row in roots])
    assert (root >= d).all() and (root[:-1] <= d[1:]).all() and root[-1] <= d[-1] + w.sum() + 1e-12


def test_spectra_of_parts_join_to_the_whole():
    r = np.random.default_rng(3)
    x = np.floor(64 * r.normal(size=(400, 7)) * np.linspace(0, 3, 7)).astype(np.int64) + 10**6  # one column is constant
    whole = whitening.Spectrum(7)
    for lo, hi, block in ((0, 100, 1), (100, 130, 7), (130, 400, 120)):
        part = whitening.Spectrum(7)
        for k in range(lo, hi, block):
            part.add(x[k : min(k + block, hi)])
        whole.merge(whitening.Spectrum(7, part.n, part.body()))
    c = x - x.mean(axis=0)
    want = c.T @ c
    assert whole.n == 400 and (whole.sums == x.sum(axis=0)).all()
    assert np.abs(whole.u @ np.diag(whole.lam) @ whole.u.T - want).max() < 1e-10 * np.abs(want).max()


def brute_white(vectors, components=32):
    """Rows of (deviation, whitened up to sign, explained) by exact integers and numpy."""
    x = np.array([[int(np.floor(64 * float(c))) + 10**6 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    c = n * x - s
    y = (c / n).astype(float)
    val, vec = np.linalg.eigh(y.T @ y / n)
    val, vec = val[::-1], vec[:, ::-1]
    return (c * c).sum(axis=1), y @ vec[:, :components], val


def collected(out):
    rows = defaultdict(dict)
    for r in out.collect():
        rows[r.vec_id][r.component] = r
    return rows


@pytest.mark.parametrize("block", [1, 5, 4096])
def test_whitening_matches_brute_force(spark, block):
    r = np.random.default_rng(block)
    x = (r.normal(size=(300, 6)) @ r.normal(size=(6, 6))).astype(np.float32)
    x[150:200] = x[0]  # repeated rows count
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(900, None), (901, [1.0] * 5 + [None]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("n", F.lit("clash")).repartition(40)
    got = collected(whitening.whiten(df, components=4, block=block))
    dev, y, val = brute_white(x, 4)
    assert set(got) == set(range(300))
    sign = {k: np.sign(got[int(np.abs(y[:, k]).argmax())][k + 1].whitened * y[np.abs(y[:, k]).argmax(), k]) for k in range(4)}
    for i in range(300):
        for k in range(4):
            g = got[i][k + 1]
            assert (g.n, g.deviation) == (300, dev[i])
            assert abs(g.whitened - sign[k] * y[i, k] / np.sqrt(val[k])) < 1e-9
            assert abs(g.explained - val[k] / val.sum()) < 1e-9 and g.identity_error < 1e-9


def test_odd_vectors_have_defined_results(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(1, [0.5, 0.5]), (1, [0.5, 0.5]), (None, [1.5, 0.5]), (2, [9.0]), (3, [1.0, 2.0, 3.0]), (4, [1.0, 2.0, 3.0])]
    out = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    two = [r for r in out if r.vec_id in (1, None)]
    assert len(two) == 6 and {r.n for r in two} == {3}
    assert all((r.whitened is None) == (r.component == 2) for r in two)  # no variance left for a second
    assert {round(r.explained, 12) for r in two} == {0.0, 1.0}
    alone = [r for r in out if r.vec_id in (2, 3, 4)]
    assert len(alone) == 7 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in alone)
    assert whitening.whiten(spark.createDataFrame(rows, schema).where("false")).count() == 0


def test_registered_whitening_is_white(spark):
    out = QUERIES["op11_whitening"](spark, SMALL)
    emb = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    dev, y, val = brute_white([r.embedding for r in emb])
    got = collected(out)
    assert len(got) == len(emb) and all(len(g) == 32 for g in got.values())
    w = np.array([[got[r.vec_id][k].whitened for k in range(1, 33)] for r in emb])
    assert np.abs(w.T @ w / len(w) - np.eye(32)).max() < 1e-9
    assert np.abs(np.abs(w) - np.abs(y / np.sqrt(val[:32]))).max() < 1e-6
    assert [got[r.vec_id][1].deviation for r in emb] == dev.tolist()


# --- language identification

def brute_grams(text):
    words = "".join(c.lower() if len(c.lower()) == 1 and c.isalpha() else c if c.isalpha() else " " for c in text).split()
    return [m[i : i + n] for w in words for m in [f"\0{w}\0"] for n in range(1, 5) for i in range(len(m) - n + 1) if m[i : i + n] != "\0"]


def test_grams_of_texts_match_brute_force():
    texts = ["The, cat sat", "", None, "1 2 3", "Ünïcode \U0001f600é ǅ İx", "a", "x" * 50, "one\ntwo  three", "straße!"]
    spread = lambda c: Counter(c.values())  # noqa: E731  cells are hashes: compare how often each comes
    got = defaultdict(Counter)
    for rows, cells in langid.grams(texts, 24):
        for i, c in zip(rows.tolist(), cells.tolist()):
            got[i][c] += 1
    for i, t in enumerate(texts):
        assert spread(got[i]) == spread(Counter(brute_grams(t or ""))), t


def test_long_texts_are_read_whole(monkeypatch):
    text = " ".join(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in range(5000))
    count = lambda: Counter(c for _, cells in langid.grams([text, "end"], 20) for c in cells.tolist())
    whole = count()
    monkeypatch.setattr(langid, "PIECE", 97)
    assert count() == whole


def test_few_characters_are_held_at_once():
    texts = ["two words " * 10_000] * 12 + ["x y " * 100_000]
    runs = [len(cells) for _, cells in langid.grams(texts, 20)]
    assert max(runs) <= 5 << 16
    assert sum(runs) == 12 * 10_000 * len(brute_grams("two words")) + 200_000 * len(brute_grams("x"))
    assert sum(len(cells) for _, cells in langid.grams(["a" * 300_000 + " b " * 30_000], 20)) == 4 * 300_000 + 30_000 * len(brute_grams("b"))  # the long run is not cut
    batch = pa.RecordBatch.from_pydict({"text": pa.array([str(i) for i in range(1300)])})
    parts = list(langid._few([batch]))
    assert max(p.num_rows for p in parts) <= 512 and [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()


@pytest.mark.parametrize("languages", [2, 3, 4, 5, 6, 20, 40])
def test_codewords_stand_apart(languages):
    book = langid.codebook(languages)
    apart = min((a != b).sum() for i, a in enumerate(book) for b in book[:i])
    assert apart >= (1 if languages == 2 else 2 if languages == 3 else 4)
    assert (np.abs(book.sum(axis=0)) < languages).all()
    assert (langid.codebook(languages) == book).all()


def test_decoding_weighs_the_loss_of_each_bit():
    m = langid.Model(["a", "b", "c", "d"], 4, np.zeros((16, 7), np.float32))
    r = np.random.default_rng(4)
    m.trust = r.random(m.book.shape)
    outs = r.uniform(-1, 1, (50, 7))
    first, second, score = m.decode(outs)
    for i, f in enumerate(outs):
        loss = [sum(w * np.exp(-y * x) for w, y, x in zip(m.trust[k], m.book[k], f)) for k in range(4)]
        order = sorted(range(4), key=lambda k: loss[k])
        assert (first[i], second[i]) == (order[0], order[1]) and abs(score[i] - (1 - loss[order[0]] / loss[order[1]])) < 1e-12
    one = m.book[2].astype(float)
    one[3] *= -1  # one wrong bit is corrected
    m.trust = np.ones(m.book.shape)
    assert m.decode(one[None])[0][0] == 2


def test_weights_are_log_odds_of_the_sides(spark):
    rows = [("ab ba", "x"), ("cd", "y"), ("ab", "x"), (None, "y"), ("zz", None)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), bits=12)
    counts = {}
    for lang in "xy":
        counts[lang] = np.zeros(1 << 12)
        for t, x in rows:
            for _, cells in langid.grams([t], 12):
                if x == lang:
                    np.add.at(counts[lang], cells, 1)
    p = {k: (c + 0.5) / (c.sum() + 0.5 * (1 << 12)) for k, c in counts.items()}
    seen = (counts["x"] + counts["y"]) > 0
    sign = model.book[0, 0]
    assert np.allclose(model.cells[seen, 0], sign * np.log(p["x"] / p["y"])[seen], atol=1e-5) and not model.cells[~seen].any()


def test_predictions_on_held_out_texts(spark):
    out = QUERIES["op12_language"](spark, SMALL.replace("0.001", "0.01"))
    docs = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet")
    held = out.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert out.count() == docs.count() and out.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_labels_of_held_out_rows_are_not_used(spark, docs):
    learn = F.col("doc_id") % 4 != 2
    twisted = docs.withColumn("lang", F.when(learn, F.col("lang")).otherwise(F.lit("zz"))).withColumn("source", F.lit(None).cast("string"))
    key = lambda df: sorted(map(tuple, df.select("doc_id", "held_out", "lang_pred", "score").collect()))
    assert key(langid.identify(docs, learn)) == key(langid.identify(twisted, learn))


def test_odd_texts_have_a_language(spark, odd_docs, no_docs):
    d = odd_docs.withColumn("lang", F.when(F.col("doc_id") == 5, "xx").when(F.col("doc_id") == 1, "yy")).withColumn("margins", F.lit("clash"))
    out = langid.identify(d, F.lit(True)).collect()
    assert len(out) == d.count()
    assert all(r.lang_pred in ("xx", "yy") for r in out if r.doc_id in (1, 4, 5, 7))
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in out if r.doc_id in (2, 3, 6))
    assert {r.lang_pred for r in langid.identify(d, F.col("doc_id") == 5).collect()} == {"xx", "und"}
    assert {r.lang_pred for r in langid.identify(d, F.lit(False)).collect()} == {"und"}
    assert langid.identify(d.where("false"), F.lit(True)).count() == 0


# --- phrases

def brute_phrases(rows, least, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in cand.items()):
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, i, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def mined(df, **kw):
    out = phrases.collocations(df, **kw)
    return sorted(map(tuple, out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


ODD = [(None, "A b. A\tb c"), ("und", "a b"), ("x", None), ("x", ""), ("x", ".,;:!?\r\n\v\f"), ("x", "a\x00b é É z a\x00b é"), ("x", "  a \x1c b"), ("x", "a a a a a a a")]


@pytest.mark.parametrize("bits", [7, 16])  # 7: the filters say yes to nearly all
def test_phrases_match_brute_force(spark, bits):
    r = random.Random(bits)
    vocab = [f"w{i}" for i in range(12)] + ["É", "É"]
    text = lambda: "".join(r.choice([" ", "  ", ". ", "\t"] + [" "] * 8) + (r.choice(["one Two three four five", "two three"]) if r.random() < 0.2 else r.choice(vocab)) for _ in range(r.randint(0, 40)))
    rows = [(r.choice(["x", "x", "x", "y", None]), text()) for _ in range(120)] + ODD * 3 + [("x", "same words again and again")] * 60
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("shard", F.lit("clash")).withColumn("n", F.lit(1))
    for shards in (1, 4):
        assert mined(df, least=4, shards=shards, bits=bits) == brute_phrases(rows, 4)
    assert mined(df, least=4, top=7, bits=bits) == brute_phrases(rows, 4, 7)


def test_one_long_text_and_empty_tables(spark):
    rows = [("x", " ".join(random.Random(1).choices("abcd", k=3000))), ("x", "a b"), ("y", "q " * 50)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert mined(df, least=5) == brute_phrases(rows, 5)
    assert mined(df.where("false"), least=5) == [] and mined(df, least=10**6) == []


def test_counts_added_up_on_the_way(spark, monkeypatch):
    r = random.Random(3)
    rows = [(r.choice("xy"), " ".join(r.choices("abcde", k=30))) for _ in range(60)]
    windows = lambda: [phrases._Windows("x", phrases.plain(t)) for _, t in rows]
    sums, want = phrases._Sums(), Counter()
    for w in windows():
        for n, at, h1, _ in w.by_length(None):
            sums.add(h1, w.second(at, n))
            want.update(zip(h1.view(np.int64).tolist(), w.second(at, n).tolist()))
            if sums.size > 500:
                sums.close()
    sums.close()
    b = sums.batch()
    assert Counter(dict(zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), b.column(2).to_pylist()))) == want


def test_words_of_plain_text():
    w = phrases._Windows("x", phrases.plain("  A  b. c\x0b\té\x00 b,"))
    assert [w.phrase(i, 1) for i in np.flatnonzero(w.is_word)] == [b"a", b"b", b"c", "é\x00".encode(), b"b"] and w.words == 5
    assert w.phrase(0, 2) == b"a b" and w.word[0][1] == w.word[0][6] and len(set(w.word[0].tolist())) == 5  # b twice; END is 0
    lone = phrases._Windows("x", phrases.plain(""))
    assert lone.words == 0 and [n for n, *_ in lone.by_length(None)] == [1]
