"""Secrets in texts: patterns, and strings that read like random characters.

Base: assignments to a secret-like name, cloud access keys and long hex runs.

Method. Two first-order Markov chains over characters, one of random strings and one of
ordinary ones, are counted from labelled samples (each distinct string once): what the
patterns catch in the corpus is labelled secret; ordinary are the unbroken tokens of all
documents, outside the patterns, that are too short to be judged. A candidate is a token
of ``min_chars`` or more outside the base spans; it is reported when its mean
log-likelihood ratio a character (bits) is above a threshold learned from the samples, each
half of them scored by the counts of the other: what all but ``false_rate`` of the ordinary
strings stay below, and where the samples lie apart, the middle between that and what all
but ``false_rate`` of the secrets exceed. No string under judgment is a sample, so findings
have no share as their limit.

Size. Counting is a distinct and two grouped counts; the model is a table of the alphabet
squared (some 4,600 numbers), which goes into the plan as a literal.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, let, text_of
from .spans import Kind, covers, find, matches, written

ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = [
    Kind("assign", ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12, hint=r"[:=]"),
    # the same matches as for a run of any length that is dropped when too short
    Kind("access", r"AKIA[A-Z0-9]{14,}", hint="AKIA"),
    Kind("hex", r"[0-9a-f]{16,}", hint=r"[0-9a-f]{16}"),
]
NAMES = [k.name for k in KINDS] + ["random"]
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
SIDE = len(LETTERS) + 1  # place 0: any other character


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio (bits) of each character pair, and the ratio to exceed."""

    ratios: tuple[float, ...]
    least: float

    def score(self, token: Column) -> Column:
        """Mean ratio over the pairs of ``token`` (null for fewer than two characters)."""
        return _score(token, self.ratios)


def _chars(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.instr(F.lit(LETTERS), c))


def _score(token: Column, ratios: tuple[float, ...]) -> Column:
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    pairs = lambda cs: F.aggregate(
        F.sequence(F.lit(0), F.size(cs) - 2), F.lit(0.0),
        lambda s, i: s + F.get(table, F.get(cs, i) * SIDE + F.get(cs, i + 1))) / (F.size(cs) - 1)
    return F.when(F.length(token) > 1, let(_chars(token), pairs))


def train(samples: DataFrame, min_chars: int = 16, false_rate: float = 0.001) -> Model | None:
    """Model from ``samples(token, secret)``; each distinct token counts once, one that is
    labelled both ways as secret. Each half of the tokens is scored by the counts of the
    other half; of these scores, those of ``min_chars`` or more set the ratio to exceed
    (where a kind has none, those of half that, then any). None without samples of both kinds."""
    samples = samples.where(F.length("token") > 1).groupBy("token").agg(F.max("secret").alias("secret"))
    samples = keep(samples.withColumn("part", F.pmod(F.xxhash64("token"), F.lit(2)).cast("int")), "samples")
    step = F.explode(let(_chars(F.col("token")), lambda cs: F.transform(
        F.sequence(F.lit(0), F.size(cs) - 2), lambda i: F.get(cs, i) * SIDE + F.get(cs, i + 1))))
    counts = samples.select("secret", "part", step.alias("pair")).groupBy("secret", "part", "pair").count().collect()  # alphabet squared, four times
    seen = {(kind, part): [0.0] * SIDE * SIDE for kind in (True, False) for part in (0, 1)}
    for r in counts:
        seen[r["secret"], r["part"]][r["pair"]] = float(r["count"])
    both = {kind: [x + y for x, y in zip(seen[kind, 0], seen[kind, 1])] for kind in (True, False)}
    if not all(map(any, both.values())):
        return None

    def logs(n: list[float]) -> list[float]:
        rows = [sum(n[a * SIDE:(a + 1) * SIDE]) for a in range(SIDE)]
        return [math.log2((x + 1) / (rows[i // SIDE] + SIDE)) for i, x in enumerate(n)]

    ratios_of = lambda part: tuple(a - b for a, b in zip(logs(seen[True, part]), logs(seen[False, part])))
    token = F.col("token")
    unseen = F.when(F.col("part") == 0, _score(token, ratios_of(1))).otherwise(_score(token, ratios_of(0)))
    scored = samples.select("secret", F.length(token).alias("size"), unseen.alias("score"))

    def level(secret: bool, at: float) -> Column:
        of = lambda least: F.percentile_approx(F.when((F.col("secret") == secret) & (F.col("size") >= least), F.col("score")), at, 10000)
        return F.coalesce(of(min_chars), of(min_chars // 2), of(0))

    top, low = scored.agg(level(False, 1 - false_rate), level(True, false_rate)).first()
    ratios = tuple(a - b for a, b in zip(logs(both[True]), logs(both[False])))
    return Model(ratios, max(top, (top + low) / 2))


def _samples(docs: DataFrame, found: DataFrame, min_chars: int) -> DataFrame:
    value = lambda s: F.when(s["kind"] == 0, F.regexp_extract(s["m"], ASSIGN, 2)).otherwise(s["m"])
    secret = found.select(F.explode(F.transform("__base", value)).alias("token"), F.lit(True).alias("secret"))
    # tokens cut as the candidates are, from half their least length up to it
    short = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{min_chars // 2},{min_chars - 1}}}(?![A-Za-z0-9+/_-])"
    rest = F.regexp_replace(text_of("text"), "|".join([ASSIGN, *(k.pattern for k in KINDS[1:])]), " ")
    ordinary = docs.select(F.explode(F.regexp_extract_all(rest, F.lit(short), F.lit(0))).alias("token"), F.lit(False).alias("secret"))
    return secret.union(ordinary.distinct())


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = 16,
                 false_rate: float = 0.001, model: Model | None = None) -> DataFrame:
    """``id`` and ``spans``: ``(start, kind, end)`` by start, then kind. ``model``: one
    trained before; else it is trained on these documents."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    t = F.col("__t")
    d = docs.select("id", text_of("text").alias("__t")).withColumn("__base", find(t, KINDS))
    loose = rf"[A-Za-z0-9+/_-]{{{min_chars},}}"
    none = F.expr("cast(array() as array<struct<start:int,end:int,m:string>>)")
    found = keep(d.select("id", "__base", F.when(
        t.rlike(loose), F.filter(matches(t, loose), lambda x: ~covers(F.col("__base"), x["start"], x["end"])))
        .otherwise(none).alias("__loose")), "secrets")
    model = model or train(_samples(docs, found, min_chars), min_chars, false_rate)
    span = lambda s, kind: F.struct(s["start"].alias("start"), kind.alias("kind"), s["end"].alias("end"))
    base = F.transform("__base", lambda s: span(s, s["kind"]))
    if model:
        more = F.filter("__loose", lambda s: model.score(s["m"]) > model.least)
        base = F.concat(base, F.transform(more, lambda s: span(s, F.lit(len(KINDS)))))
    return found.select("id", F.sort_array(base).alias("spans"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row for each row of ``docs``: id, ``n_assign, n_access, n_hex, n_random``,
    ``base_sha256`` (of the base spans as written) and ``spans`` (all, as written).

    A null text counts as empty. Null ids and repeated rows are carried. Other columns are
    not read. An empty table gives an empty table; without samples of both kinds only the
    base is reported.
    """
    d = secret_spans(docs, id_col, text, **options)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return d.select(
        F.col("id").alias(id_col), *[count(i).alias(f"n_{k}") for i, k in enumerate(NAMES)],
        F.sha2(written(F.filter("spans", lambda s: s["kind"] < len(KINDS)), NAMES), 256).alias("base_sha256"),
        written(F.col("spans"), NAMES).alias("spans"))
