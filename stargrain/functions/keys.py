"""Business keys, surrogate keys and date keys (§1.4, F13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stargrain.functions.text import ColLike, _c


def business_key(*parts: ColLike, sep: str = "|", skip_nulls: bool = True) -> Column:
    """md5 of the parts joined by ``sep``.

    ``skip_nulls=True`` is ``concat_ws`` (a NULL part is left out, so keys
    with NULL parts can collide with shorter keys — trap §4.3-5);
    ``False`` is ``concat`` (any NULL part makes the key NULL).
    """
    cols = [_c(p).cast("string") for p in parts]
    if len(cols) == 1:
        return F.md5(cols[0])
    if skip_nulls:
        return F.md5(F.concat_ws(sep, *cols))
    joined = []
    for i, c in enumerate(cols):
        if i:
            joined.append(F.lit(sep))
        joined.append(c)
    return F.md5(F.concat(*joined))


def surrogate_key(bk: ColLike, method: str = "md5_60") -> Column:
    """Deterministic surrogate key derived from a business key.

    * ``murmur31``: ``abs(hash(bk)) % 2147483647`` as in the reference, widened
      to bigint before ``abs`` so INT_MIN does not overflow under ANSI mode.
      31 bits: collisions are expected from a few 10^4 keys on.
    * ``md5_60``: the first 15 hex digits of ``md5(bk)`` as a bigint (60 bits);
      the same number can be computed by any SQL engine with ``md5``.  Collisions
      are expected from about 10^9 keys on.
    * ``md5_120``: the first 30 hex digits as a decimal(38,0) (120 bits), for facts of
      any size.
    """
    bk = _c(bk)
    if method == "murmur31":
        return (F.abs(F.hash(bk).cast("bigint")) % F.lit(2147483647)).cast("int")
    if method == "md5_60":
        return F.conv(F.substring(F.md5(bk.cast("string")), 1, 15), 16, 10).cast("bigint")
    if method == "md5_120":
        digest = F.md5(bk.cast("string"))
        half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(19,0)")
        return (half(1) * F.lit(1 << 60).cast("decimal(19,0)") + half(16)).cast("decimal(38,0)")
    raise ValueError(f"unknown surrogate key method {method!r}")


def date_key(d: ColLike) -> Column:
    """yyyymmdd as int; NULL date gives NULL."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def epoch_micros(c: ColLike, type_name: str) -> Column:
    """Microseconds since 1970-01-01 00:00, independent of the session time zone.

    ``timestamp`` is an instant (``unix_micros``); ``timestamp_ntz`` is wall-clock
    time, read as UTC from its calendar parts (a cast to ``timestamp`` would
    use the session zone); ``date`` is midnight of that day.
    """
    c = _c(c)
    if type_name == "timestamp":
        return F.unix_micros(c)
    day = F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86_400_000_000)
    if type_name == "date":
        return day
    clock = (F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("bigint") * F.lit(1_000_000)
    return day + clock + F.date_format(c, "SSSSSS").cast("bigint")
