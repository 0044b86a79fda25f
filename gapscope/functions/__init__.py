"""Column-level helpers: pure ``Column -> Column`` builders, all JVM-side."""

from gapscope.functions.columns import (
    any_keyword,
    composite_key,
    guarded_ratio,
    lookback_cutoff,
    safe_cast,
    sha256_key,
)

__all__ = [
    "any_keyword",
    "composite_key",
    "guarded_ratio",
    "lookback_cutoff",
    "safe_cast",
    "sha256_key",
]
