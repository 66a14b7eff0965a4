"""Parts of URLs as column expressions.

Null and malformed URLs (without ``scheme://host``) have an empty host.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_START = "^[A-Za-z][A-Za-z0-9+.-]*://"
HOST = _START + "(?:[^/?#@]*@)?([^/:?#]+)"
PATH = _START + "[^/?#]*([^?#]*)"
REST = _START + "[^/?#]*([^#]*)"


def host(url: Column) -> Column:
    """Lower case, without user, port and closing dots."""
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)), F.lit("."))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


def reversed_key(url: Column) -> Column:
    """Host labels from the last to the first, then path and query; a URL without host is its own key."""
    text = F.coalesce(url, F.lit(""))
    name = host(url)
    return F.when(name == "", text).otherwise(F.concat(F.concat_ws(",", F.reverse(F.split(name, "\\."))), F.lit(")"), F.regexp_extract(text, REST, 1)))
