"""gapscope: Spark-native tax-reporting analytics.

Long-form tax facts are checked, cast, deduplicated and merged with late
rows; measures are pivoted per jurisdiction and year, joined to statutory
rates and turned into effective rates, gaps, top-N lists, per-year audit
signals, dimensions, quality reports and an append-only flag log.
"""

__version__ = "0.1.0"
