"""Personal data: patterns, and terms that reveal what the patterns protect.

Base: e-mail addresses, IP addresses, card and phone numbers, by pattern and check.

Method (information-theoretic sanitisation). Every base match names protected entities c: the
match itself and what it belongs to (mail domain, network, card issuer, number without its
last four digits), and the name parts of a mail address. A term t of a text that holds c
discloses it as far as the corpus says that seeing t makes c likely:

    share = log2(P(c | t) / P(c)) / log2(1 / P(c)),
    P(c) = D(c) / N,  P(c | t) = (T + P(c)) / (E + 1),

with D counted over the N documents, whole texts each, T the number of different texts that
hold both (copies are one observation), and E = T * D(t) / D(c, t), the texts with t that
this stands for. The share nears 1 when t says as much as c itself. In texts that hold c,
terms with a share of ``generalise_at`` or more are generalised to a class of their shape, of
``remove_at`` or more removed, wherever they stand. A pair counts only when its coincidence
is significant: under independence, T of E texts have a chance below 2 ** -(E * KL(T / E,
P(c))) (Chernoff), and that, times the number of pairs looked at, must stay below ``error``.
A term that is itself a name part of an address in the same text was not searched for among
all pairs; such pairs are a family of their own, so a name in a single text can count.

Size. Classes that no term could be significant for are dropped before pairs are made; the
others meet the distinct terms of their texts, each different text once. Everything is
added up inside the tasks before it is sent on; of all documents only a count a term and
task is. Terms and classes are held by their 64-bit hashes, texts only for documents with a
match.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, keep, let, text_of
from .spans import Kind, covers, find, matches, written

# A run of local characters starts a match only where no such character (or the end of the
# last match) stands before it: the leftmost match is the same, and long runs stay linear.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"[\p{L}\p{N}]+"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _is_ip(m: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return m.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _is_card(m: Column) -> Column:
    def luhn(d: Column) -> Column:
        def add(s: Column, i: Column) -> Column:
            x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int") * (i % 2 + 1)
            return s + x - F.when(x > 9, 9).otherwise(0)
        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add) % 10 == 0
    return let(_digits(m), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))


KINDS = [
    Kind("email", EMAIL, hint="@"),
    Kind("ip", IP, _is_ip, hint=r"[0-9]\.[0-9]"),
    Kind("card", CARD, _is_card, hint=r"[0-9](?:[\x20-]?[0-9]){15}"),
    Kind("phone", PHONE, lambda m: F.length(_digits(m)).between(8, 15), hint=r"\+[0-9]"),
]
NAMES = [k.name for k in KINDS] + ["term"]
LABELS = ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]"]


def _term(m: Column) -> Column:
    return F.xxhash64(F.lower(m))


def _found(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``row`` (the ``carry`` columns), ``base`` spans, and of texts with any ``key`` and ``t``
    (the text)."""
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in carry])
    d = docs.select(row.alias("row"), text_of(F.col(f"`{text}`")).alias("t")).withColumn("base", find(F.col("t"), KINDS))
    some = F.size("base") > 0
    return d.select("row", "base", F.when(some, F.md5("t")).alias("key"), F.when(some, F.col("t")).alias("t"))


def _entities(s: Column) -> Column:
    """The match, and what it belongs to."""
    low, digits = F.lower(s["m"]), _digits(s["m"])
    whole = F.when(s["kind"] >= 2, digits).otherwise(low)
    wider = (F.when(s["kind"] == 0, F.substring_index(low, "@", -1)).when(s["kind"] == 1, F.regexp_extract(low, r"^[0-9]+\.[0-9]+", 0))
             .when(s["kind"] == 2, F.substring(digits, 1, 6)).otherwise(F.substring(digits, F.lit(1), F.length(digits) - 4)))
    return F.array(F.xxhash64(s["kind"], F.lit(0), whole), F.xxhash64(s["kind"], F.lit(1), wider))


def _held(found: DataFrame) -> DataFrame:
    """Of each different text with a match: its copies ``n``, its ``classes`` (entities), the
    ``terms`` outside the base, the name ``parts`` of its addresses."""
    base = F.col("base")
    near = F.filter(matches(F.col("t"), TERM), lambda x: ~covers(base, x["start"], x["end"]))
    names = F.flatten(F.transform(F.filter(base, lambda s: s["kind"] == 0), lambda s: F.filter(
        F.split(F.substring_index(s["m"], "@", 1), r"[^\p{L}]+"), lambda x: F.length(x) > 1)))
    one = found.where("key IS NOT NULL").groupBy("key").agg(F.first("base").alias("base"), F.first("t").alias("t"), F.count(F.lit(1)).alias("n"))
    return keep(one.select("key", "n", F.array_distinct(F.flatten(F.transform(base, _entities))).alias("classes"),
                           F.array_distinct(F.transform(near, lambda x: _term(x["m"]))).alias("terms"),
                           F.array_distinct(F.transform(names, _term)).alias("parts")), "held")


def _disclosing(held: DataFrame, docs: DataFrame, text: str, generalise_at: float, error: float) -> DataFrame:
    """``(key, hits)``: for each text its disclosing terms ``(t, share)``."""
    t = text_of(F.col(f"`{text}`"))
    n = docs.count()
    own = held.select("key", "n", F.explode(F.array_intersect("parts", "terms")).alias("t"))
    sums = held.agg(F.sum(F.size("classes").cast("long") * F.size("terms")).alias("pairs"),
                    F.sum(F.size(F.array_intersect("parts", "terms"))).alias("own")).first()
    # bits of surprise that a pair needs, of those looked at in its family
    need, need_own = (math.log2(max(sums[c] or 0, 1) / error) for c in ("pairs", "own"))
    ic, texts = -F.log2(F.col("d_c") / n), F.count(F.lit(1))
    # no pair is more surprising than if all texts with t held c
    counted = lambda df, least: (df.groupBy("c").agg(F.sum("n").alias("d_c"), texts.alias("texts"))
                                 .where((F.col("d_c") < n) & (F.col("texts") * ic >= least)).select("c", "d_c"))
    both = lambda df, keys: df.groupBy(*keys).agg(F.sum("n").alias("d_ct"), texts.alias("texts"))
    classes = keep(counted(held.select("n", F.explode("classes").alias("c")), need), "classes")
    names = counted(held.select("n", F.explode("parts").alias("c")), need_own)
    said = held.select("key", "n", F.explode("classes").alias("c"), "terms").join(classes.select("c"), "c", "left_semi")
    said = said.select("key", "n", "c", F.explode("terms").alias("t"))
    pairs = both(said, ["c", "t"]).join(classes, "c").withColumn("need", F.lit(need)).withColumn("own", F.lit(False))
    literal = both(own, ["t"]).withColumn("c", F.col("t")).join(names, "c").withColumn("need", F.lit(need_own)).withColumn("own", F.lit(True))
    p, q = F.col("d_c") / n, F.col("d_ct") / F.col("d_t")
    stands_for = F.col("texts") / q
    surprise = stands_for * (q * F.log2(q / p) + F.when(q < 1, (1 - q) * F.log2((1 - q) / (1 - p))).otherwise(F.lit(0.0)))
    share = F.log2((F.col("texts") + p) / (stands_for + 1) / p) / ic
    passing = lambda df: df.where((q > p) & (surprise >= F.col("need"))).withColumn("share", share).where(F.col("share") >= generalise_at)
    # both fall as D(t) grows, so what fails with the texts that hold a match fails with all
    near = held.select("n", F.explode("terms").alias("t")).groupBy("t").agg(F.sum("n").alias("d_t"))
    pairs = pairs.where(F.col("texts") * ic >= F.col("need")).unionByName(literal.where(F.col("texts") * ic >= F.col("need")))
    pairs = keep(passing(pairs.join(near, "t")).drop("d_t", "share"), "pairs")
    every = F.array_distinct(F.transform(F.split(t, r"[^\p{L}\p{N}]+", -1), _term))
    terms = docs.select(F.explode(every).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("d_t"))  # a row a term and task is sent
    rated = keep(passing(pairs.join(terms, "t")).select("c", "t", "share", "own"), "rated")
    hits = (said.join(rated.where("NOT own").select("c", "t", "share"), ["c", "t"]).select("key", "t", "share")
            .unionByName(own.join(rated.where("own").select("t", "share"), "t").select("key", "t", "share")))
    hits = hits.groupBy("key", "t").agg(F.max("share").alias("share"))
    return hits.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("t", "share"))).alias("hits"))


def _spans(docs: DataFrame, text: str, carry: list[str], generalise_at: float, remove_at: float, error: float) -> DataFrame:
    """``row`` (the ``carry`` columns) and ``spans``: ``(kind, start, end, label)`` by kind,
    then start."""
    found = keep(_found(docs, text, carry), "found")
    hits = _disclosing(_held(found), docs, text, generalise_at, error)
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                  F.get(F.array(*map(F.lit, LABELS)), s["kind"]).alias("label")))

    def shape(m: Column) -> Column:
        return (F.when(m.rlike(r"^\p{N}+$"), "[NUMBER]").when(m.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]"))

    def term(x: Column) -> Column:
        share = let(_term(x["m"]), lambda h: F.get(F.filter("hits", lambda k: k["t"] == h), F.lit(0))["share"])
        return let(share, lambda s: F.struct(
            F.when(s.isNotNull(), len(KINDS)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            F.when(s >= remove_at, "").otherwise(shape(x["m"])).alias("label")))

    placed = F.filter(matches(F.col("t"), TERM), lambda x: ~covers(F.col("base"), x["start"], x["end"]))
    more = F.filter(F.transform(placed, term), lambda s: s["kind"].isNotNull())
    clean = found.where("key IS NULL").select("row", base.alias("spans"))
    rest = (found.where("key IS NOT NULL").join(hits, "key", "left")
            .select("row", F.when(F.col("hits").isNull(), base).otherwise(F.concat(base, more)).alias("spans")))
    return clean.unionByName(rest)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                       generalise_at: float = 0.8, remove_at: float = 0.95, error: float = 0.05) -> DataFrame:
    """One row for each row of ``docs``: id, ``n_email, n_ip, n_card, n_phone, n_term``,
    ``base_sha256`` (of the base spans as written) and ``spans`` (base, then terms).

    A null text counts as empty and has no spans. Null ids and repeated rows are carried (a
    repeated text is one observation of its terms). Other columns are not read. An empty
    table gives an empty table.
    """
    d = _spans(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), "text", ["id"], generalise_at, remove_at, error)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return d.select(
        F.col("row.id").alias(id_col), *[count(i).alias(f"n_{k}") for i, k in enumerate(NAMES)],
        F.sha2(written(F.filter("spans", lambda s: s["kind"] < len(KINDS)), NAMES), 256).alias("base_sha256"),
        written(F.col("spans"), NAMES).alias("spans"))


def _redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its label (spans that overlap: the first's)."""
    empty = F.expr("cast(array() as array<struct<start:int,end:int,label:string>>)")
    item = lambda a, e, x: F.struct(a.alias("start"), e.alias("end"), x.alias("label"))
    by_start = F.array_sort(F.transform(spans, lambda s: item(s["start"], s["end"], s["label"])))
    last = lambda m: F.get(m, F.size(m) - 1)
    merged = F.aggregate(by_start, empty, lambda m, s: F.when(
        (F.size(m) > 0) & (s["start"] < last(m)["end"]),
        F.concat(F.slice(m, 1, F.size(m) - 1), F.array(item(last(m)["start"], F.greatest(last(m)["end"], s["end"]), last(m)["label"])))
    ).otherwise(F.concat(m, F.array(s))))

    def joined(m: Column) -> Column:
        before = lambda i: F.when(i > 0, F.get(m, i - 1)["end"]).otherwise(0)
        parts = F.transform(m, lambda s, i: F.concat(F.substring(text, before(i) + 1, s["start"] - before(i)), s["label"]))
        return F.concat(F.array_join(parts, ""), F.substring(text, last(m)["end"] + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(let(merged, joined))


def redact(docs: DataFrame, text: str = "text", generalise_at: float = 0.8, remove_at: float = 0.95,
           error: float = 0.05) -> DataFrame:
    """``docs`` with base matches and disclosing terms replaced in ``text``. Rows and columns
    stay, whatever the columns are called; a null text stays null, an empty one empty,
    repeated rows are treated alike. An empty table gives an empty table."""
    d = _spans(docs, text, docs.columns, generalise_at, remove_at, error)
    row = free_name(docs, "row")
    own, d = F.col(row)[text], d.withColumnRenamed("row", row)
    new = F.when(own.isNotNull(), _redacted(own.cast("string"), F.col("spans")))
    fresh = free_name(docs, "new")
    return d.select(row, new.alias(fresh)).select(*[F.col(fresh).alias(c) if c == text else F.col(row)[c].alias(c) for c in docs.columns])
