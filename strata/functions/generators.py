"""Test-data generation as Spark jobs over the ids of a given table.

Every value is computed from a digest of the row id and a salt (``mix``), so the same
numbers can be recomputed by any SQL engine, and a generator grows with the table
it is keyed on. A generator is immutable: deriving one (other columns, other
ranges) never changes the one it came from.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def mix(salt: int, id_col: str = "id") -> Column:
    """A number below 2 ** 32 from the MD5 digest of ``salt:id``: columns with different salts
    are independent, and any SQL engine can recompute them."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), F.col(id_col).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def mix_sql(salt: int, id_col: str = "id") -> str:
    return f"CAST('0x' || substr(md5('{salt}:' || CAST({id_col} AS VARCHAR)), 1, 8) AS BIGINT)"


def choice(values: list, salt: int, id_col: str = "id") -> Column:
    """One of ``values`` per row (``values=[...], random=True``)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (mix(salt, id_col) % len(values) + 1).cast("int"))


def numeric_range(lo, hi, step, salt: int, type_: str = "decimal(10,2)") -> Column:
    """``lo + k * step`` for k in ``0 .. (hi - lo) / step`` (``minValue/maxValue/step``)."""
    steps = int(round((hi - lo) / step)) + 1
    return (F.lit(lo).cast(type_) + (mix(salt) % steps).cast(type_) * F.lit(step).cast(type_)).cast(type_)


def integer_range(lo: int, hi: int, salt: int) -> Column:
    return (F.lit(lo) + mix(salt) % (hi - lo + 1)).cast("int")


def _epoch(s: str) -> int:
    return int(dt.datetime.fromisoformat(s).replace(tzinfo=dt.timezone.utc).timestamp())


def timestamp_range(lo: str, hi: str, salt: int) -> Column:
    """A second in ``[lo, hi]`` (``minValue/maxValue`` on a timestamp)."""
    a, b = _epoch(lo), _epoch(hi)
    return F.timestamp_seconds(F.lit(a) + mix(salt) % (b - a + 1)).cast("timestamp_ntz")


def with_nulls(col: Column, fraction: float, salt: int) -> Column:
    """NULL in a ``fraction`` of the rows (``percentNulls=0.01`` is one row in a hundred)."""
    return F.when(mix(salt) % 10000 < int(round(fraction * 10000)), F.lit(None)).otherwise(col)


# Fixed word lists of our own for the text generator (not taken from any source).
ADJECTIVES = ["Amber", "Bright", "Cedar", "Delta", "Eastern", "Frontier", "Granite", "Harbor",
              "Iron", "Juniper", "Keystone", "Lakeside", "Maple", "Northern", "Orchard", "Pioneer"]
NOUNS = ["Analytics", "Builders", "Foods", "Freight", "Holdings", "Labs", "Logistics", "Media",
         "Metals", "Outfitters", "Systems", "Textiles"]
SUFFIXES = ["Inc", "LLC", "Group", "Partners", "Co"]


STREETS = ["Birch Road", "Canal Street", "Dock Lane", "Elm Avenue", "Field Way", "Grove Court"]
CITIES = ["Ashford", "Brookton", "Clearwater", "Dunmore", "Eastfield", "Fairview", "Glenrock"]


def _join_batches(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Text column from a Python function with one set-up per task, then Arrow batches."""
    adj, noun, suf = (np.array(x, dtype=object) for x in (ADJECTIVES, NOUNS, SUFFIXES))  # set-up
    for a, n, x in batches:
        pick = lambda words, k: words[k.to_numpy(dtype="int64", na_value=0) % len(words)]
        yield pd.Series(pick(adj, a) + " " + pick(noun, n) + " " + pick(suf, x), index=a.index, dtype=object).where(a.notna(), None)


def company_name_udf(id_col: str = "id") -> Column:
    """Company-like name per id, by a vectorised pandas UDF over an iterator of batches."""
    return F.pandas_udf(_join_batches, "string")(mix(11, id_col), mix(12, id_col), mix(13, id_col))


def company_name(id_col: str = "id") -> Column:
    """The same names from built-in functions (NULL for a NULL id)."""
    name = F.concat_ws(" ", *[choice(w, salt, id_col) for w, salt in ((ADJECTIVES, 11), (NOUNS, 12), (SUFFIXES, 13))])
    return F.when(F.col(id_col).isNotNull(), name)


def address(salt: int, id_col: str = "id") -> Column:
    """``number street`` and city on two lines (``multiLine`` CSV needs such a column)."""
    return F.concat((mix(salt, id_col) % 9900 + 100).cast("string"), F.lit(" "), choice(STREETS, salt + 1, id_col), F.lit("\n"),
                    choice(CITIES, salt + 2, id_col))


def phone(salt: int, id_col: str = "id") -> Column:
    return F.concat(F.lit("555-"), F.lpad((mix(salt, id_col) % 10000).cast("string"), 4, "0"))


def pick_sql(words: list[str], salt: int, id_col: str = "id") -> str:
    return "list_value(" + ", ".join(f"'{w}'" for w in words) + f")[1 + ({mix_sql(salt, id_col)}) % {len(words)}]"


def address_sql(salt: int, id_col: str = "id") -> str:
    return (f"CAST(({mix_sql(salt, id_col)}) % 9900 + 100 AS VARCHAR) || ' ' || {pick_sql(STREETS, salt + 1, id_col)} || chr(10) || "
            f"{pick_sql(CITIES, salt + 2, id_col)}")


def phone_sql(salt: int, id_col: str = "id") -> str:
    return f"'555-' || lpad(CAST(({mix_sql(salt, id_col)}) % 10000 AS VARCHAR), 4, '0')"


def company_name_sql(id_col: str = "id") -> str:
    """The same names as SQL, for an oracle."""
    return f"{pick_sql(ADJECTIVES, 11, id_col)} || ' ' || {pick_sql(NOUNS, 12, id_col)} || ' ' || {pick_sql(SUFFIXES, 13, id_col)}"


class DataGenerator:
    """Rows = the ids of ``base``; columns added by rules over the id. Immutable."""

    def __init__(self, base: DataFrame, id_col: str = "id", columns: tuple = ()):
        self.base = base.select(F.col(id_col).alias("id"))
        self._id_col = "id"
        self.columns = tuple(columns)

    def with_column(self, name: str, column: Column) -> "DataGenerator":
        """A new generator with ``name`` added, or replaced in place."""
        if any(n == name for n, _ in self.columns):
            cols = tuple((n, column if n == name else c) for n, c in self.columns)
        else:
            cols = self.columns + ((name, column),)
        return DataGenerator(self.base, "id", cols)

    def with_rows(self, base: DataFrame, id_col: str) -> "DataGenerator":
        """Same columns over the ids of another table (``withRowCount``)."""
        return DataGenerator(base, id_col, self.columns)

    def build(self) -> DataFrame:
        df = self.base
        for n, c in self.columns:
            df = df.withColumn(n, c)
        return df
