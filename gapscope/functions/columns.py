"""Scalar expressions used by the operators.

Every helper returns a Catalyst expression, so it stays inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: str | Column, type_name: str) -> Column:
    """Cast that turns malformed text (``2020-Q1``, ``n/a``, empty) into null.

    Spark 4 runs with ANSI mode on, where a plain ``cast`` raises; the data
    contract here is "bad text becomes null and is dropped or counted".
    """
    return _c(c).try_cast(type_name)


def composite_key(*parts: str | Column, sep: str = "_") -> Column:
    """``concat_ws`` key, e.g. ``{jurisdiction}_{year}``; null parts are skipped."""
    return F.concat_ws(sep, *[_c(p).cast("string") for p in parts])


def sha256_key(*parts: str | Column, sep: str = "|") -> Column:
    """Stable hex key from one or more columns (deterministic across runs)."""
    return F.sha2(F.concat_ws(sep, *[_c(p).cast("string") for p in parts]), 256)


def guarded_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """``numerator / denominator`` only where the denominator is non-null and > 0.

    No ``otherwise``: anything else is null (three-valued, like the source).
    """
    den = _c(denominator)
    return F.when(den.isNotNull() & (den > 0), _c(numerator) / den)


def any_keyword(c: str | Column, keywords: Iterable[str]) -> Column:
    """True when ``c`` contains any keyword (case-sensitive substring).

    Folded from ``lit(False)``, so an empty keyword list matches nothing.
    """
    out = F.lit(False)
    for kw in keywords:
        out = out | _c(c).contains(kw)
    return out


def lookback_cutoff(as_of: str | _dt.date | Column | None, days: int) -> Column:
    """``date_sub(as_of, days)``; ``as_of=None`` means today (folded to a literal)."""
    if as_of is None:
        base = F.current_date()
    elif isinstance(as_of, Column):
        base = F.to_date(as_of)
    else:
        base = F.lit(as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)))
    return F.date_sub(base, days)
