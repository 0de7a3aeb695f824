"""Pipeline parameters: named, typed values used in definitions.

``${name}`` substitution in SQL text raises on an unset name (an unset Spark conf
would become an empty string and fail later as a cast error). ``sql`` binds values as
typed literals (a value is never parsed as SQL), so a comparison stays a pushable
predicate; ``substitute`` pastes text, for places where SQL takes no parameter.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_REF = re.compile(r"\$\{([^}]+)\}")


class MissingParameter(KeyError):
    pass


class Params(dict):
    def require(self, name: str):
        if name not in self or self[name] is None:
            raise MissingParameter(f"pipeline parameter '{name}' is not set")
        return self[name]

    def substitute(self, text: str) -> str:
        """Replace every ``${name}`` by its value; unset names raise before planning."""
        return _REF.sub(lambda m: str(self.require(m.group(1))), text)

    def sql(self, spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
        """Run ``text`` with every ``${name}`` bound as a parameter."""
        args: dict = {}
        keys: dict = {}  # a number a name: names may differ in punctuation alone

        def bind(m: re.Match) -> str:
            key = keys.setdefault(m.group(1), f"p{len(keys)}")
            args[key] = self.require(m.group(1))
            return f":{key}"
        return spark.sql(_REF.sub(bind, text), args=args, **frames)

    def literal(self, name: str, type_: str | None = None) -> Column:
        v = F.lit(self.require(name))
        return v.cast(type_) if type_ else v

    def timestamp(self, name: str) -> Column:
        return F.to_timestamp_ntz(F.lit(str(self.require(name))))
