"""Quality rules: fixed floors, and a decision list learned from labelled documents.

Method (sequential covering). Statistics of each labelled document are cut at quantiles.
A rule grows by adding the threshold condition with the largest information gain on the
growing part of the labels, is pruned to the prefix of conditions that does best on the
pruning part, and joins the list if it is precise enough there; what it covers is set
aside, and the next rule is grown. A rule that fails there only sets its growing rows aside,
so that another one can grow; the list ends when none does, or after some failures in a
row. The list is emitted as one ordered Spark conditional
expression, first rule that holds decides.

Size. Labelled rows are reduced to counts by cut number once; every step is one grouped
count over them, and the driver sees only counts by statistic and cut. All labelled rows
are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, keep, let, text_of, words

FEATURES = ("mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "n_words", "mean_line")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # >= cut, else < cut
    cut: float

    def holds(self) -> Column:
        x = F.col(f"__{self.feature}")
        return x >= F.lit(self.cut) if self.above else x < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.cut:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Conjunctions in order; a document that one of them covers is rejected."""

    rules: tuple[tuple[Condition, ...], ...]

    def rule_number(self) -> Column:
        """Number of the first rule that covers the document, else null."""
        out = F.lit(None).cast("int")
        for i, rule in reversed(list(enumerate(self.rules))):
            all_hold = rule[0].holds()
            for c in rule[1:]:
                all_hold = all_hold & c.holds()
            out = F.when(all_hold, i).otherwise(out)
        return out


def with_stats(docs: DataFrame, text: str, width: int = 5) -> DataFrame:
    """``docs`` with columns ``__<name>`` for each of STATS and FEATURES."""
    d = docs.withColumn("__t", text_of(text)).withColumn("__w", words(F.col("__t")))
    n = F.size("__w")
    d = d.withColumn("__n_words", n.cast("long"))
    d = d.withColumn("__word_chars", F.aggregate("__w", F.lit(0).cast("long"), lambda s, w: s + F.length(w)))
    d = d.withColumn("__n_symbols", F.regexp_count("__t", F.lit(r"[#*$%&|<>]")).cast("long"))
    lines = F.filter(F.split("__t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("__lines", lines)
    d = d.withColumn("__n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    d = d.withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w)))
    seen = let(F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get("__h", i + k) for k in range(width)])),
               lambda g: F.size(F.array_distinct(g)) < F.size(g))
    d = d.withColumn("__again", F.when(n >= width, seen).otherwise(False))
    d = d.withColumn("__n_repeat_words", F.when(F.col("__again"), _repeated(width)).otherwise(F.lit(0)).cast("long"))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0)).cast("double")
    w = F.col("__word_chars")
    upper = F.length(F.regexp_replace("__t", r"[^\p{Lu}]+", ""))
    return d.withColumns({
        "__mean_word": share(w, F.col("__n_words")), "__symbol_share": share(F.col("__n_symbols"), w),
        "__dup_line_share": share(F.col("__n_dup_lines"), F.size("__lines")),
        "__repeat_share": share(F.col("__n_repeat_words"), F.col("__n_words")),
        "__upper_share": share(upper, w), "__mean_line": share(F.col("__n_words"), F.size("__lines")),
    }).drop("__t", "__w", "__lines", "__h", "__again")


def _repeated(width: int) -> Column:
    """Words inside windows of ``width`` words that occur twice or more (compared by their
    words; windows come here only where two hashes were equal)."""
    key = F.transform(F.sequence(F.lit(0), F.size("__w") - width), lambda i: F.struct(
        F.array_join(F.slice("__w", i + 1, width), " ").alias("k"), i.alias("at")))

    def twice(s: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(s, a)["k"] == F.get(s, b)["k"], F.lit(False))
        return F.sort_array(F.transform(
            F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: same(i, i - 1) | same(i, i + 1)), lambda i: F.get(s, i)["at"]))

    start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
    return let(F.sort_array(key), lambda s: F.aggregate(
        twice(s), start, lambda a, at: F.struct(at.alias("last"), (a["n"] + F.least(F.lit(width), at - a["last"])).alias("n")),
        lambda a: a["n"]))


def _chance(p: int, n: int, base: float) -> float:
    """Bound on the probability of ``p`` or more hits among ``p + n`` rows of share ``base``."""
    q = p / (p + n)
    if q <= base:
        return 1.0
    kl = q * math.log(q / base) + ((1 - q) * math.log((1 - q) / (1 - base)) if q < 1 else 0.0)
    return math.exp(-(p + n) * kl)


def learn(labelled: DataFrame, cuts: int = 64, precision: float = 0.95, min_cover: int = 5, min_share: float = 0.002,
          error: float = 0.05, patience: int = 4) -> DecisionList:
    """Decision list from ``labelled``: columns of FEATURES (as from ``with_stats``), ``bad``
    (0 or 1) and ``prune`` (boolean: the row is for pruning). An empty table gives no rules.
    A rule must cover ``min_cover`` bad rows of the pruning part, and a share of ``min_share``
    of them (so a list has a bounded length), and be right on a share of ``precision`` of
    what it covers there, more often than chance would have it: of the k rules tried so far
    the last may be as good as it is by chance with a probability of ``error / k / (k + 1)``
    (Chernoff bound), so all together stay below ``error``. Thresholds are the ``cuts``
    quantiles of each class; ``patience`` failures in a row end the list."""
    names = [f"__{f}" for f in FEATURES]
    at = [i / cuts for i in range(cuts + 1)]
    qs = labelled.groupBy("bad").agg(*[F.percentile_approx(n, at, 10000).alias(n) for n in names]).collect()
    if len(qs) < 2:
        return DecisionList(())
    edges = {n: sorted({x for r in qs for x in r[n] or []}) for n in names}
    bucket = lambda n: F.size(F.filter(F.array(*map(F.lit, edges[n])), lambda e: e <= F.col(n)))
    cells = keep(labelled.where(F.col("bad").isNotNull()).groupBy("bad", "prune", *[bucket(n).alias(n) for n in names])
                 .agg(F.count(F.lit(1)).alias("n")), "cells")

    def holds(c: tuple[str, bool, int]) -> Column:
        return F.col(c[0]) >= c[2] if c[1] else F.col(c[0]) < c[2]

    def all_of(rule: list) -> Column:
        out = F.lit(True)
        for c in rule:
            out = out & holds(c)
        return out

    rest, rules = cells, []
    good, bad = (cells.where(f"prune AND bad = {y}").agg(F.sum("n")).first()[0] or 0 for y in (0, 1))
    tried = failed = 0
    least = max(min_cover, math.ceil(min_share * bad))
    while True:
        rule: list = []
        best_p = best_n = None
        while True:
            one = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names])).alias("x")
            rows = (rest.where(~F.col("prune") & all_of(rule)).select("bad", "n", one)
                    .groupBy("x.f", "x.b", "bad").agg(F.sum("n").alias("n")).collect())  # statistics x cuts x 2
            count = {(r["f"], r["b"], r["bad"]): r["n"] for r in rows}
            total = [sum(v for k, v in count.items() if k[0] == names[0] and k[2] == y) for y in (0, 1)]
            if not total[1] or not total[0] and rule:
                break
            if best_p is None:
                best_p, best_n = total[1], total[0]
            best = None
            for n in names:
                low = [0, 0]
                for cut in range(1, len(edges[n]) + 1):
                    for y in (0, 1):
                        low[y] += count.get((n, cut - 1, y), 0)
                    for above, (neg, pos) in ((False, low), (True, [total[0] - low[0], total[1] - low[1]])):
                        if pos >= least:
                            gain = pos * (math.log2(pos / (pos + neg)) - math.log2(best_p / (best_p + best_n)))
                            if best is None or gain > best[0] + 1e-9:
                                best = (gain, (n, above, cut), pos, neg)
            if best is None or best[0] <= 1e-9:
                break
            rule.append(best[1])
            best_p, best_n = best[2], best[3]
            if not best_n:
                break
        if not rule:
            break
        prefix = [F.sum(F.when(all_of(rule[:k]) & (F.col("bad") == y), F.col("n")).otherwise(0)).alias(f"{k}_{y}")
                  for k in range(1, len(rule) + 1) for y in (0, 1)]
        r = rest.where("prune").agg(*prefix).first()
        pn = [(r[f"{k}_1"] or 0, r[f"{k}_0"] or 0, k) for k in range(1, len(rule) + 1)]
        p, n, k = max(pn, key=lambda x: ((x[0] - x[1]) / max(x[0] + x[1], 1), x[0], -x[2]))
        tried += 1
        if p >= least and p >= precision * (p + n) and _chance(p, n, bad / (good + bad)) <= error / tried / (tried + 1):
            rules.append(rule[:k])
            rest, failed = rest.where(~all_of(rule[:k])), 0
        else:  # what it covers of the growing part no longer attracts rules
            rest, failed = rest.where(F.col("prune") | ~all_of(rule)), failed + 1
            if failed == patience:
                break
    return DecisionList(tuple(tuple(Condition(f[2:], above, edges[f][cut - 1]) for f, above, cut in rule) for rule in rules))


def _labelled(stats: DataFrame, id_col: str, labels: DataFrame) -> DataFrame:
    """Statistics of the labelled rows; a document labelled both ways counts as bad."""
    lab = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("__label_id"))
           .agg((1 - F.min(F.when(F.col("quality") > 0, 1).otherwise(0))).alias("bad")))
    names = [f"__{f}" for f in FEATURES]
    return (stats.select(F.col(id_col).alias("__id"), *names).join(lab, F.col("__id") == F.col("__label_id"))
            .select(*names, "bad", (F.pmod(F.xxhash64("__id"), F.lit(3)) == 0).alias("prune")))


def _judged(docs: DataFrame, labels: DataFrame, id_col: str, text: str, **options) -> DataFrame:
    """``docs`` (written and reread, without the text) with the statistics, ``__base_failed``
    and ``__rule``."""
    stats = keep(with_stats(docs, text).drop(text), "stats")
    floor = (F.col("__n_words") < 10) | (100 * F.col("__n_repeat_words") > 20 * F.col("__n_words"))
    listed = learn(_labelled(stats.where(~floor), id_col, labels), **options)
    return stats.withColumn("__base_failed", floor).withColumn("__rule", listed.rule_number())


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row for each row of ``docs``: id, the statistics, ``base_failed``, ``kept`` and
    ``rule`` (number of the learned rule that rejects it, else null).

    A null text has no words and fails the base. Null ids are judged like any other (they
    have no label). Repeated rows stay. Without labels of both kinds no rule is learned.
    An empty table gives an empty table. Other columns are not read.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    d = _judged(d, labels, "id", "text", **options)
    return d.select(F.col("id").alias(id_col), *[F.col(f"__{s}").alias(s) for s in STATS],
                    F.col("__base_failed").alias("base_failed"),
                    (~F.col("__base_failed") & F.col("__rule").isNull()).alias("kept"), F.col("__rule").alias("rule"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps. Columns are unchanged, whatever they
    are called; repeated rows stay; an empty table gives an empty table."""
    row = free_name(docs, "row")
    one = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns])
    d = docs.select(one.alias(row), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    d = _judged(d, labels, "id", "text", **options).where(~F.col("__base_failed") & F.col("__rule").isNull())
    return d.select(*[F.col(row)[c].alias(c) for c in docs.columns])
