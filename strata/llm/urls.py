"""URL filter: listed rules, and templates of paths learned for each host.

Method (path-template tree). A path is cut into segments; runs of digits and long hex
strings inside a segment become placeholders. Down the tree of each host, a segment

* whose labelled pages are bad at a rate significantly different from its siblings' stays
  a branch of its own, however rare it is (two-proportion z-test; for one that is rare
  among many siblings, where labels are few and tests many, the Chernoff bound of the
  binomial tail, times the number of siblings);
* else (no labels: no difference) is merged with its siblings under ``*``.

The path of nodes is a URL's template. A template's purity is the smoothed share of good
pages among its labelled ones; templates below ``purity`` are rejected.

Size. The tree is built over distinct (host, generalised path) rows with counts, level by
level; a level is two grouped sums and two joins on the node. Hot hosts are summed before
the shuffle; AQE splits their joins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

Rule = tuple[str, str, str]  # host, path, verdict


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(url, URL, 2)


def longest_rule(host: Column, path: Column, rules: list[Rule], part: int | None = None) -> Column:
    """The longest rule (``host + path``) that fits; ``part`` 2 gives its verdict instead."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == r[0]) | host.endswith("." + r[0])) & path.startswith(r[1])
        out = F.when(fits, r[0] + r[1] if part is None else r[part]).otherwise(out)
    return out


def shape_of(path: Column) -> Column:
    """A path with the parts that vary by their spelling generalised."""
    return F.regexp_replace(F.regexp_replace(path, r"[0-9a-fA-F]{16,}", "{h}"), r"[0-9]+", "{n}")


def templates(nodes: DataFrame, depth: int = 6, many: int = 20, rare: float = 0.02, z: float = 2.58) -> DataFrame:
    """``nodes(host, shape, n, good, bad)`` -> ``(host, shape, template, n, good, bad)``.
    Segments past ``depth`` stand as one last segment."""
    segs = F.split(F.regexp_replace("shape", "^/", ""), "/", depth)
    t = keep(nodes.withColumn("segs", segs).withColumn("template", F.lit("")), "tree")
    levels = t.agg(F.max(F.size("segs"))).first()[0] or 0  # at most depth
    for level in range(levels):
        seg = F.get("segs", F.lit(level))
        here = t.where(F.size("segs") > level).withColumn("seg", seg)
        kids = here.groupBy("host", "template", "seg").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])
        all_kids = kids.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("kids"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "good", "bad")])
        a, b = F.col("good") + F.col("bad"), F.col("all_good") + F.col("all_bad") - F.col("good") - F.col("bad")
        pooled = F.col("all_bad") / (a + b)
        apart = F.abs(F.col("bad") / a - (F.col("all_bad") - F.col("bad")) / b)
        differs = F.when((a > 0) & (b > 0), apart > z * F.sqrt(pooled * (1 - pooled) * (1 / a + 1 / b))).otherwise(False)
        variable = (F.col("kids") > many) & (F.col("n") < rare * F.col("all_n"))
        # of labelled pages as bad as all of the node's, so many or more (or fewer) by chance
        share = F.col("bad") / a
        part = lambda x, q: F.when(x > 0, x * F.log(x / q)).otherwise(0.0)
        chance = a * (part(share, F.col("all_bad") / (a + b)) + part(1 - share, F.col("all_good") / (a + b)))
        certain = F.when((a > 0) & (b > 0), chance > F.log(F.col("kids") / F.lit(math.erfc(z / math.sqrt(2))))).otherwise(False)
        own = F.when(variable, certain).otherwise(differs)
        node = F.when((F.col("kids") > 1) & ~own, "*").otherwise(F.col("seg"))
        named = kids.join(all_kids, ["host", "template"]).select("host", "template", "seg", node.alias("node"))
        on = ["host", "template", "seg"]
        t = keep(t.withColumn("seg", F.coalesce(seg, F.lit(""))).join(named, on, "left")
                 .withColumn("template", F.when(F.size("segs") > level, F.concat("template", F.lit("/"), "node")).otherwise(F.col("template")))
                 .select("host", "shape", "n", "good", "bad", "segs", "template"), "tree")
    return t.drop("segs")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[Rule], id_col: str = "page_id", url: str = "url",
               purity: float = 0.5, prior_rows: float = 5.0, **tree) -> DataFrame:
    """One row for each row of ``pages``: id, ``host, path, rule, verdict, template``.

    ``labels(id, bad)`` marks pages as good (0) or bad (1); null ids or marks are ignored,
    a page marked both ways is bad. A rule's verdict wins over the template's. Null urls
    and urls without ``://`` have empty host and path and share one template. Repeated rows
    stay. Without labels every template is allowed. Other columns are not read.
    """
    u = text_of(url)
    p = pages.select(F.col(id_col).alias("id"), host_of(u).alias("host"), path_of(u).alias("path")).withColumn("shape", shape_of(F.col("path")))
    marks = labels.where("id IS NOT NULL AND bad IS NOT NULL").groupBy(F.col("id").alias("mark_id")).agg(F.max("bad").alias("bad"))
    count = lambda c: F.count(F.when(c, 1))
    nodes = keep(p.join(marks, F.col("id") == F.col("mark_id"), "left").groupBy("host", "shape")
                 .agg(F.count(F.lit(1)).alias("n"), count(F.col("bad") == 0).alias("good"), count(F.col("bad") == 1).alias("bad")), "nodes")
    total = nodes.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    seen = (total["good"] or 0) + (total["bad"] or 0)
    prior = (total["good"] or 0) / seen if seen else 1.0
    t = templates(nodes, **tree)
    by = t.groupBy("host", "template").agg(
        ((F.sum("good") + prior_rows * prior) / (F.sum("good") + F.sum("bad") + prior_rows)).alias("purity"))
    judged = (t.select("host", "shape", "template").join(by, ["host", "template"])
              .select("host", "shape", "template", F.when(F.col("purity") < purity, "block").otherwise("allow").alias("learned")))
    return p.join(judged, ["host", "shape"], "left").select(
        F.col("id").alias(id_col), "host", "path", longest_rule(F.col("host"), F.col("path"), rules).alias("rule"),
        F.coalesce(longest_rule(F.col("host"), F.col("path"), rules, 2), "learned").alias("verdict"), "template")
