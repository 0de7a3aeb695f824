"""SimHash near-duplicates against a brute-force version."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash
from strata.llm.components import components


def brute_fp(text, k=3):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))
    grams = [b" ".join(ws[i:i + k]) for i in range(len(ws) - k + 1)] or ([b" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64(g, 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits=3):
    fps, up = sorted(set(fps)), {}
    find = lambda x: x if up.get(x, x) == x else find(up[x])
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= bits:
                ra, rb = find(a), find(b)
                up[max(ra, rb)] = min(ra, rb)
    return {f: find(f) for f in fps}


def expected(rows):
    fp = [(i, brute_fp(t)) for i, t in rows]
    root, least = brute_components([f for _, f in fp]), {}
    for i, f in fp:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted((str(i), f"{f:016x}", str(least.get(root[f]))) for i, f in fp)


def got(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_documents(docs, texts):
    assert got(simhash.near_duplicates(docs)) == expected(texts.items())


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(simhash.near_duplicates(odd_docs)) == expected(rows)
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({int(c) for _, _, c in expected(rows)})
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_pieces_of_long_texts(monkeypatch):
    text = " ".join(f"word{i % 91}" for i in range(3000)).encode()
    whole = simhash.simhash(text)
    monkeypatch.setattr(simhash, "PIECE", 100)
    assert simhash.simhash(text) == whole
    assert simhash.simhash(b"a" * 500) == simhash.simhash(b" " * 300 + b"a" * 500 + b" " * 300)


@pytest.mark.parametrize("max_bits", [1, 2, 3, 4])
def test_links_in_dense_clouds(spark, max_bits):
    """A cloud of near copies (paired by stars), a chain, and strangers."""
    rnd = random.Random(max_bits)
    base, spots = rnd.getrandbits(64), rnd.sample(range(64), 14)
    cloud = {base ^ sum(1 << b for b in rnd.sample(spots, rnd.randint(0, 14))) for _ in range(600)}
    chain, x = [], rnd.getrandbits(64)
    for b in range(0, 64, max_bits):
        chain.append(x)
        x ^= sum(1 << (b + i) for i in range(max_bits) if b + i < 64)
    fps = list(cloud) + chain + [rnd.getrandbits(64) for _ in range(200)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    nodes = spark.createDataFrame([(signed(f),) for f in set(fps)], "fp long")
    linked = {r.node: r.root for r in components(simhash.links(nodes, max_bits)).collect()}
    want = brute_components(fps, max_bits)
    classes = lambda pairs: sorted(sorted(c) for c in pairs.values())
    a, b = {}, {}
    for f, r in want.items():
        a.setdefault(r, []).append(signed(f))
        b.setdefault(linked.get(signed(f), signed(f)), []).append(signed(f))
    assert classes(a) == classes(b)


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r.node, r.root) for r in components(links).collect()} == {(i, 0) for i in range(1, n + 1)}
