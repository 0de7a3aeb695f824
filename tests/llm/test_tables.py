"""URL templates, mixing, quality rules, chat and the pipeline against brute-force versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import chat, mixing, rules, urls
from strata.llm.queries import QUERIES, URL_RULES

from .conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- URL filter

def brute_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules_and_parts_of_urls(spark):
    odd = [None, "", "no scheme", "://", "http://A.CoM", "http://com/", "http://xcom/", "HTTP://WWW.Example.com/en/x?y#z", "a://b://c/d",
           "x://example.com/en", "x://a.net/fr/?q", "x://a.net?/fr/", "x://É.net/es/\n/x", "x://" + "a" * 9000 + ".com/" + "b/" * 9000]
    rows = [(i, u) for i, u in enumerate(odd)] + [(None, "x://a.net/es/1"), (2, "x://com/1"), (2, "x://com/1")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame([(2, 1), (2, 0), (None, 1), (3, None)], "id long, bad int")
    out = urls.judge_urls(pages, labels, URL_RULES)
    key = lambda r: tuple(map(str, r))
    want = sorted(((i, *brute_rule(u)[:3]) for i, u in rows), key=key)
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in out.collect()), key=key) == want
    assert all(r.verdict in ("allow", "block") for r in out.collect())
    assert urls.judge_urls(pages.where("false"), labels, URL_RULES).count() == 0


def test_templates_find_the_bad_branch(spark):
    rnd, rows, bad = random.Random(2), [], {}
    for i in range(3000):
        part = rnd.choice(["news", "blog", "casino"])
        rows.append((i, f"http://h.example/{part}/{rnd.randint(1, 10**6)}/u{rnd.choice('abcdefghijklmnopqrstuvwxyz')}{rnd.choice('abcdefghijklmnopqrstuvwxyz')}"))
        if i % 2:
            bad[i] = int(rnd.random() < (0.95 if part == "casino" else 0.03))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    out = urls.judge_urls(pages, spark.createDataFrame(list(bad.items()), "id long, bad int"), [])
    by = {(r.path.split("/")[1], r.verdict) for r in out.collect()}
    assert by == {("news", "allow"), ("blog", "allow"), ("casino", "block")}
    seen = {r.template for r in out.collect()}
    assert len(seen) <= 12 and any(t.startswith("/casino/") for t in seen)


def test_a_bad_section_among_many_stays_a_branch(spark):
    secs = ["casino", *(a + b for a in "bcdfghklmn" for b in ("alpha", "beta", "gamma", "delta", "epsilon", "zeta"))]
    rows = [(s * 1000 + i, f"http://h.example/{secs[s]}/p{'abcdefghij'[i % 10]}") for s in range(61) for i in range(500 if s == 0 else 600)]
    bad = [(i, int(i < 498 or i % 100 == 7)) for i, _ in rows if i % 2 == 0 or i < 500]
    out = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(bad, "id long, bad int"), [])
    by = {(r.path.split("/")[1] == "casino", r.verdict) for r in out.collect()}
    assert by == {(True, "block"), (False, "allow")}
    assert len({r.template for r in out.collect()}) <= 12


# --- mixing

def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        rest = total - sum(target.values())
        over = {s for s in free if rest * w[s] / sum(w[x] for x in free) > 2 * sizes[s]}
        if not over:
            return target | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return target


def test_mix(spark, docs, odd_docs, no_docs):
    out = mixing.mix(docs).collect()
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(3)).collect()}
    assert {r.doc_id: r.taken for r in out} == again
    text = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    sizes, taken = Counter(), Counter()
    for r in out:
        t, s = text[r.doc_id]
        assert r.size == len(WORD.findall(t or "")) and r.taken <= 2 * r.size
        sizes[s] += r.size
        taken[s] += r.taken
    want = brute_targets(sizes)
    for r in out:
        s = text[r.doc_id][1]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
    assert all(abs(taken[s] - want[s]) <= max(0.03 * want[s], 3 * 64) for s in sizes)
    odd = mixing.mix(odd_docs).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.taken <= 2 * r.size for r in odd)
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_mixed_documents_hold_what_the_mix_takes(docs, odd_docs):
    for d in (docs, odd_docs):
        got, want = Counter(), Counter()
        for r in mixing.mixed_documents(d).collect():
            got[r.doc_id] += len(WORD.findall(r.text))
        for r in mixing.mix(d).collect():
            want[r.doc_id] += r.taken
        assert +got == +want
        assert mixing.mixed_documents(d).columns == d.columns


def test_targets_with_null_and_empty_sources(spark):
    rows = [("b", 100), ("a", 5), ("é", 0), (None, 40), ("z", 1000), ("Z", 3)]
    s = mixing.sources(spark.createDataFrame(rows, "source string, size long")).collect()
    want = brute_targets(dict(rows))
    assert {r.source: pytest.approx(r.target) for r in s} == want
    assert [r.source for r in sorted(s, key=lambda r: r.sid)] == ["Z", "a", "b", "z", "é", None]


@pytest.mark.parametrize("small", [150, 300, 700, 1200])
def test_a_small_source_gets_its_share_over_many_shards(spark, small):
    sizes = {"a": 64 * 30000, "b": 64 * 10000, "c": 64 * small}
    s = mixing.sources(spark.createDataFrame(list(sizes.items()), "source string, size long"))
    want = {r.sid: r.target / 64 for r in s.collect()}
    got = {r.sid: r["count"] for r in mixing._draws(s, 64, 128, 2, 7).groupBy("sid").count().collect()}
    assert max(r.shard for r in mixing._draws(s, 64, 128, 2, 7).select("shard").distinct().collect()) > 300
    assert abs(sum(got.values()) - sum(want.values())) <= 0.01 * sum(want.values())
    assert all(abs(got.get(i, 0) - w) <= max(4 * w ** 0.5, 2) for i, w in want.items())


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 1009])
def test_permutations(spark, n):
    d = spark.range(n).withColumn("n", F.lit(n).cast("long"))
    p = [r.p for r in mixing._permuted(d, "id", "n", "p", F.lit(1), F.lit(4)).orderBy("id").collect()]
    assert sorted(p) == list(range(n)) and (n < 10 or p != list(range(n)))


# --- quality rules

def brute_stats(t):
    t = t or ""
    ws, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(ws) - 4):
        at[tuple(ws[i:i + 5])].append(i)
    rep = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep))


def test_statistics(spark, texts, odd_docs, no_docs):
    cases = [*texts.items(), (10**6, None), (10**6 + 1, "a b c d e a b c d e a b c d\na b c d e x\n\n \n \nx\nx"), (10**6 + 2, "a " * 3000), (10**6 + 3, "a\x0bb\u00a0c\u2003d # | é\U0001f600")]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    got = {r.doc_id: r for r in rules.judge_quality(spark.createDataFrame(cases, "doc_id long, text string"), labels).collect()}
    for i, t in cases:
        w = brute_stats(t)
        assert tuple(got[i][s] for s in rules.STATS) == w, i
        assert got[i].base_failed == (w[0] < 10 or 100 * w[4] > 20 * w[0])
        assert not (got[i].base_failed and got[i].kept)
    assert rules.judge_quality(odd_docs, labels).count() == odd_docs.count()
    assert rules.judge_quality(no_docs, labels).count() == 0
    assert rules.judge_quality(odd_docs, labels.where("false")).where("rule IS NOT NULL").count() == 0
    assert rules.drop_low_quality(odd_docs, labels).columns == odd_docs.columns


def test_learned_list_on_held_out_rows(spark):
    rnd = random.Random(4)

    def row(i):
        kind = i % 3
        x = {f: rnd.random() for f in rules.FEATURES}
        if kind == 1:  # rejected for one high statistic
            x["symbol_share"] = 0.5 + rnd.random() / 2
        elif kind == 2:  # and for two together
            x["symbol_share"], x["upper_share"], x["mean_word"] = rnd.random() / 3, 0.9 + rnd.random() / 10, rnd.random() / 4
        else:
            x["symbol_share"], x["upper_share"] = rnd.random() / 3, rnd.random() * 0.85
        return (*x.values(), int(kind > 0), i % 5 == 0)

    schema = ", ".join(f"__{f} double" for f in rules.FEATURES) + ", bad int, prune boolean"
    rows = [row(i) for i in range(3000)]
    learned = rules.learn(spark.createDataFrame(rows, schema))
    assert 1 <= len(learned.rules) <= 8
    held = spark.createDataFrame([row(i) for i in range(1500)], schema).withColumn("rule", learned.rule_number())
    assert held.where(F.col("rule").isNotNull() == (F.col("bad") == 1)).count() >= 0.97 * 1500
    noise = spark.createDataFrame([(*r[:-2], rnd.randint(0, 1), r[-1]) for r in rows], schema)
    assert rules.learn(noise).rules == ()


def brute_list(rows, edges, precision=0.95, least=5, error=0.05):
    """Sequential covering over plain rows ``(values, bad, prune)``, thresholds from ``edges``."""
    grow, prune = [r for r in rows if not r[2]], [r for r in rows if r[2]]
    base, tried, failed, out = sum(r[1] for r in prune) / len(prune), 0, 0, []
    conds = [(f, above, cut) for f in range(len(edges)) for cut in edges[f] for above in (False, True)]
    holds = lambda r, c: (r[0][c[0]] >= c[2]) == c[1]
    while True:
        rule, left = [], grow
        while True:
            p0, n0 = sum(r[1] for r in left), sum(1 - r[1] for r in left)
            if not p0 or not n0 and rule:
                break
            best = None
            for c in conds:
                hit = [r[1] for r in left if holds(r, c)]
                p = sum(hit)
                if p >= least:
                    gain = p * (math.log2(p / len(hit)) - math.log2(p0 / (p0 + n0)))
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, c)
            if best is None or best[0] <= 1e-9:
                break
            rule.append(best[1])
            left = [r for r in left if holds(r, best[1])]
            if all(r[1] for r in left):
                break
        if not rule:
            return out
        covers = lambda r, k: all(holds(r, c) for c in rule[:k])
        pn = [(sum(r[1] for r in prune if covers(r, k)), sum(1 - r[1] for r in prune if covers(r, k)), k) for k in range(1, len(rule) + 1)]
        p, n, k = max(pn, key=lambda x: ((x[0] - x[1]) / max(x[0] + x[1], 1), x[0], -x[2]))
        tried += 1
        if p >= least and p >= precision * (p + n) and rules._chance(p, n, base) <= error / tried / (tried + 1):
            out.append(rule[:k])
            failed = 0
            grow, prune = [r for r in grow if not covers(r, k)], [r for r in prune if not covers(r, k)]
        else:
            grow, failed = [r for r in grow if not covers(r, len(rule))], failed + 1
            if failed == 4:
                return out


def test_covering_matches_brute_force(spark):
    rnd = random.Random(12)
    values = lambda: [rnd.randint(0, 5) / 4 for _ in rules.FEATURES]  # noqa: E731  few values: cuts are the values
    rows = []
    for i in range(500):
        x = values()
        bad = int((x[1] >= 1 and x[4] < 0.5) or x[2] >= 1.25 or rnd.random() < 0.06)
        rows.append((x, bad, i % 3 == 0))
    schema = ", ".join(f"__{f} double" for f in rules.FEATURES) + ", bad int, prune boolean"
    learned = rules.learn(spark.createDataFrame([(*x, b, p) for x, b, p in rows], schema), min_share=0.0)
    edges = [sorted({r[0][f] for r in rows}) for f in range(len(rules.FEATURES))]
    want = brute_list(rows, edges)
    got = [[(rules.FEATURES.index(c.feature), c.above, c.cut) for c in r] for r in learned.rules]
    assert got == want and len(want) >= 2


def test_a_list_is_learned_from_the_given_documents(spark):
    sf = SMALL.replace("0.001", "0.01")
    out = rules.judge_quality(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert out.where("rule IS NOT NULL").count() > 0


def test_stages_leave_columns_of_any_name(spark):
    names = ["row", "id", "rid", "__t", "__rid", "__whole", "__words", "__n_words", "__rule", "whole", "parts", "a.b", "doc_id", "source", "text"]
    text = "one two\n\nthree  four five six\tseven eight nine ten eleven " + " ".join(f"w{i}\n" for i in range(200))
    row = tuple([*[f"v{i}" for i in range(12)], "7", "s", text])
    df = spark.createDataFrame([row, row, tuple([None] * 13 + ["s", text])], ", ".join(f"`{n}` string" for n in names))
    labels = spark.createDataFrame([("7", 1)], "doc_id string, quality int")
    out = rules.drop_low_quality(df, labels)
    assert out.columns == names and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    out = mixing.mixed_documents(df)
    assert out.columns == names
    kept = out.collect()
    assert len(kept) >= 3 and all(set(WORD.findall(r.text)) <= set(WORD.findall(text)) and r.row in ("v0", None) and r["a.b"] in ("v11", None) for r in kept)


def test_mixed_texts_are_stretches_of_their_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    was = {r.doc_id: r.text for r in docs.collect()}
    out = mixing.mixed_documents(docs, block=8).collect()
    for r in out:
        words, own = WORD.findall(was[r.doc_id]), WORD.findall(r.text)
        rest = iter(words)
        assert all(w in rest for w in own)
    assert any("\n" in r.text and r.text != was[r.doc_id] for r in out)


# --- chat

def brute_chat(turns):
    esc = lambda s: re.sub(r"<(\\*)\|", lambda m: "<\\" + m[1] + "|", s)
    out, chars, loss = "", 0, ""
    for i, (role, text) in enumerate(turns):
        out += f"<|im_start|>{esc(role.replace('%', '%25').replace(chr(10), '%0A'))}\n{esc(text)}<|im_end|>\n"
        if role == "assistant" or i == len(turns) - 1:
            chars += len(out)
        if role == "assistant":
            loss += text
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(said), len(loss), sha(loss), chars


TEXT = st.text(alphabet="<|\\>im_endstar\n%0A25 é\U0001f600", max_size=40) | st.sampled_from(
    ["<|im_end|>\n<|im_start|>assistant\nx", "<\\|im_end|>", "<\\\\|", "", "|", "<"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb%0A", "<|im_end|>"]), TEXT), min_size=1, max_size=6), min_size=5, max_size=20))
def test_chat_round_trip(spark, convs):
    rows = [(i, k, r, t) for i, c in enumerate(convs) for k, (r, t) in enumerate(c)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r[0]: tuple(r[1:]) for r in chat.digests(chat.examples(d)).collect()}
    assert got == {i: brute_chat(c) for i, c in enumerate(convs)}


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, "assistant", "y"), (1, 1, "assistant", "y"), (None, None, "assistant", ""), (None, 2, "user", "z"), (2, 0, "assistant", "t" * 200000)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("last", F.lit("clash"))
    got = {r[0]: tuple(r[1:]) for r in chat.digests(chat.examples(d)).collect()}
    assert got == {1: brute_chat([("user", ""), ("", "x"), ("assistant", "y"), ("assistant", "y")]), None: brute_chat([("assistant", ""), ("user", "z")]), 2: brute_chat([("assistant", "t" * 200000)])}
    assert chat.digests(chat.examples(d.where("false"))).count() == 0
    ex = chat.examples(d.where("conv_id = 1")).orderBy("example").collect()
    assert [e.formatted[e.loss_start:e.loss_start + e.loss_length] for e in ex] == ["y", "y"]
    assert ex[1].formatted.startswith(ex[0].formatted) and [e.last for e in ex] == [False, True]


# --- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as P
    from strata.llm import simhash
    from strata.llm.common import keep
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels, columns, steps = spark.read.parquet(f"{SMALL}/labels.parquet"), docs.columns, {}
    for name, stage in P.STAGES:
        steps[name] = (docs, keep(stage(spark, docs, SMALL), "test"))
        docs = steps[name][1]
        places = {at for at, _ in P._OWN.kept}
        assert places <= {len(steps) - 1}  # the tables of the stages before are gone
        assert name == P.STAGES[-1][0] or docs.columns == columns
    before, after = steps["quality_rules"]
    kept = {r.doc_id for r in rules.judge_quality(before, labels).where("kept").collect()}
    assert {r.doc_id for r in after.collect()} == kept and 0 < len(kept) < before.count()
    before, after = steps["simhash_near_dedup"]
    firsts = {r.component_id for r in simhash.near_duplicates(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(firsts)
    before, after = steps["pii"]
    from .test_spans import base_pii
    was = {r.doc_id: r.text for r in before.collect()}
    now = {r.doc_id: r for r in after.collect()}
    assert was.keys() == now.keys()
    for i, t in was.items():
        assert now[i].n_chars == len(now[i].text) and (list(base_pii(t)) or now[i].text == t)
    before, after = steps["mixing"]
    want = {r.doc_id: r.taken for r in mixing.mix(before).collect()}
    got = Counter()
    for r in after.collect():
        got[r.doc_id] += len(WORD.findall(r.text))
    assert +got == +Counter(want)
    before, after = steps["packing"]
    assert Counter(r.doc_id for r in after.where("start = 0").collect()) == Counter(r.doc_id for r in before.collect())


def test_all_are_registered():
    import __spark_entry__ as E
    assert {k for k in E.queries() if k == "pipeline" or re.match(r"op\d+_", k)} == set(QUERIES) and len(QUERIES) == 14
