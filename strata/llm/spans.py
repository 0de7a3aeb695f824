"""Pattern matches with their places, from SQL functions alone.

Spark's regular-expression functions give the matches and the text between them but no
places; a place is the running sum of those lengths (in code points).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import let


@dataclass(frozen=True)
class Kind:
    """A pattern (Java syntax), what a match must pass, and a string or pattern that a text
    must hold for the pattern to be worth running."""

    name: str
    pattern: str
    passes: Callable[[Column], Column] = lambda m: F.lit(True)
    hint: str | None = None


def running(lengths: Column) -> Column:
    """Sum of the items before each item of a non-empty array. In blocks of about the root
    of the size, so n items cost n times its root and not its square."""
    plus = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)

    def blocked(a: Column, b: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), ((F.size(a) - 1 - (F.size(a) - 1) % b) / b).cast("int")),
                           lambda k: plus(F.slice(a, k * b + 1, b)))
        return let(sums, lambda s: let(
            F.transform(s, lambda x, k: plus(F.slice(s, 1, k))),
            lambda base: F.transform(a, lambda x, i: F.get(base, ((i - i % b) / b).cast("int"))
                                     + plus(F.slice(a, i - i % b + 1, i % b)))))

    return let(lengths, lambda a: let(F.ceil(F.sqrt(F.size(a))).cast("int"), lambda b: blocked(a, b)))


def matches(text: Column, pattern: str) -> Column:
    """Array of ``(start, end, m)``: the matches of ``pattern`` in ``text``, leftmost and
    not overlapping; ``start`` and ``end`` in code points, end exclusive."""
    none = F.expr("cast(array() as array<struct<start:int,end:int,m:string>>)")

    def placed(ms: Column, gaps: Column) -> Column:
        both = F.zip_with(F.slice(gaps, 1, F.size(ms)), ms, lambda g, m: F.length(g) + F.length(m))
        return F.transform(
            F.zip_with(running(both), F.zip_with(F.slice(gaps, 1, F.size(ms)), ms, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m"))),
                       lambda at, x: F.struct((at + x["g"]).alias("start"), x["m"].alias("m"))),
            lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.length(x["m"])).alias("end"), x["m"].alias("m")))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda ms: F.when(F.size(ms) == 0, none).otherwise(
        let(F.split(text, pattern, -1), lambda gaps: placed(ms, gaps))))


def find(text: Column, kinds: list[Kind]) -> Column:
    """Array of ``(kind, start, end, m)`` (kind: its number) of the matches that pass, by
    kind, then start."""
    none = F.expr("cast(array() as array<struct<kind:int,start:int,end:int,m:string>>)")

    def of_kind(i: int, k: Kind) -> Column:
        own = F.transform(F.filter(matches(text, k.pattern), lambda x: k.passes(x["m"])), lambda x: F.struct(
            F.lit(i).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["m"].alias("m")))
        return own if k.hint is None else F.when(text.rlike(k.hint), own).otherwise(none)

    found = [of_kind(i, k) for i, k in enumerate(kinds)]
    return F.concat(*found)


def written(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    name = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def covers(spans: Column, start: Column, end: Column) -> Column:
    """Does any span overlap ``[start, end)``?"""
    return F.exists(spans, lambda s: (s["start"] < end) & (s["end"] > start))
