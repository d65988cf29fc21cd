"""Campaign tags of a landing URL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.scalars import blank_to_null

FIELDS = ("utm_source", "utm_medium", "utm_campaign")


def raw_param(url: Column, name: str) -> Column:
    """First value as written in the URL, not decoded; null when absent or empty."""
    return blank_to_null(F.regexp_extract(url, rf"[?&]{name}=([^&]+)", 1))


def decoded_param(url: Column, name: str) -> Column:
    """First value after percent and plus decoding, the fragment left out; null when absent or blank."""
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    value = F.regexp_extract(query, rf"(?:^|&){name}=([^&]*)", 1)
    return blank_to_null(F.coalesce(F.try_url_decode(value), value))


def resolved(name: str, landing: str = "landing_site") -> Column:
    """The stored column, else the value in the landing URL."""
    return F.coalesce(F.col(name), raw_param(F.col(landing), name))
