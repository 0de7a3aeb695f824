"""Scalar column functions used by the pipeline definitions (all built-in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def email_from_name(name: str | Column, domain: str = "@example.com") -> Column:
    """Address made from a name: other characters than letters and digits separate its words,
    each word is capitalised, and they are run together before ``domain``. NULL gives NULL."""
    c = F.col(name) if isinstance(name, str) else name
    cleaned = F.regexp_replace(c, "[^0-9A-Za-z]", " ")
    return F.concat(F.replace(F.initcap(cleaned), F.lit(" "), F.lit("")), F.lit(domain))


def json_path(col: str, path: str) -> Column:
    """``col:a:b`` on a JSON string, as text."""
    return F.get_json_object(F.col(col), "$." + path.replace(":", "."))


def json_path_typed(col: str, path: str, type_: str) -> Column:
    """``parse_json(col):a:b::type`` through a variant."""
    return F.variant_get(F.parse_json(F.col(col)), "$." + path.replace(":", "."), type_)
