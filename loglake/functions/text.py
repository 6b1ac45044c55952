"""Scalar helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim(x: Column) -> Column:
    """Without leading and trailing white space of any script."""
    return F.regexp_replace(x, r"(?U)\A\s+|\s+\z", "")


def integer(x: Column) -> Column:
    """A whole decimal number with an optional sign that fits 64 bits, else null."""
    return F.when(x.rlike(r"\A[+-]?[0-9]+\z"), x.try_cast("bigint"))


def blank_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


HOST_PORT = r"\A(?:\[([^\[\]]*)\]|([^:\[\]]*)):([+-]?[0-9]+)\z"


def split_ip_port(x: Column) -> tuple[Column, Column]:
    """(host, port) of host:port or [host]:port; other values stay whole, without a port."""
    port = integer(F.regexp_extract(x, HOST_PORT, 3))
    host = F.when(x.startswith("["), F.regexp_extract(x, HOST_PORT, 1)).otherwise(F.regexp_extract(x, HOST_PORT, 2))
    return F.when(port.isNotNull(), host).otherwise(x), port


def bsd_time(x: Column, year: int, now: str) -> Column:
    """A syslog time such as `Aug 28 18:30:12` in that year as RFC 3339; now, if it isn't one."""
    whole = F.concat(F.lit(f"{year} "), F.regexp_replace(x, r"\s+", " "))
    at = F.try_to_timestamp(whole, F.lit("yyyy MMM dd HH:mm:ss"))
    return F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(now))


def first_of(*choices: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in choices])


def last_where(array: Column, test) -> Column:
    """The last element that passes, or null."""
    return F.try_element_at(F.filter(array, test), F.lit(-1))
