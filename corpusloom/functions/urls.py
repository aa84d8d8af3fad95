"""Hosts and comparable forms of URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_host(url: Column | str) -> Column:
    """Lower-case host without user, port, a leading ``www.`` and a trailing dot; NULL where there is none."""
    authority = F.regexp_extract(F.trim(_col(url)), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r"\.$", "")
    return F.when(host != "", host)


def canonical_url(url: Column | str) -> Column:
    """Host and path, slashes collapsed, without a trailing slash, query and fragment; NULL where there is no host."""
    path = F.regexp_extract(F.trim(_col(url)), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, "/{2,}", "/"), "/$", "")
    return F.concat(url_host(url), path)
