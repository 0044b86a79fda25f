"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

A source gets ``target`` words: its weight's share of the budget, held to
``most_copies`` times what it has, the excess shared again by weight. Every
document of a source is expected ``m = target / source_size`` times. The
whole part of ``m`` is taken with certainty; the rest, a fraction ``p``, is
a fixed-size sample: documents are ranked by ``(u / (1 - u)) / (p / (1 - p))``
- random odds over inclusion odds - and taken in that order until the
source's remaining words are reached. ``u`` comes from a digest of the
document's id, so reruns and recomputed tasks agree.

The ranking never sorts a source in one task. Ranks are binned, the bins are
summed with map-side combine, and only the rows of the one bin in which the
words run out are put in order.

Defined results: a null or empty text has size 0 and is taken 0 words; a
null source is a source of its own, listed last; a source without words has
target 0; rows with one id share their rank, so they are taken or left
together; an empty table gives an empty table. Columns of the input that
clash with the added names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapscope.llm.common import WORD_PATTERN, read, stored

WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
MOST_COPIES = 2
#: Bins of a source's ranks; the rows of one bin are ordered together.
BINS = 1 << 16
SEED = "mix"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) that depends on the key alone: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget_percent: int = BUDGET_PERCENT, most_copies: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size): the one table of sources, not of documents.

    Sources fill up in the order of size per weight, so the resharing has a
    closed form: the first k sources are full where the share of the others
    per weight is below the k-th's limit. Sums stay whole numbers; a target is
    one division of two of them.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    listed = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("long"))
    )
    everything = Window.partitionBy()
    by_limit = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    number = "decimal(38,0)"
    open_words = F.lit(budget_percent).cast(number) * F.sum("source_size").over(everything) - F.lit(100 * most_copies).cast(number) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shares = listed.select(
        "source", "source_size", "weight",
        open_words.cast(number).alias("open_words"), open_weight.alias("open_weight"),
        F.row_number().over(by_limit).alias("place"),
    )
    is_open = F.col("weight") * F.col("open_words") <= F.lit(100 * most_copies) * F.col("source_size").cast("decimal(20,0)") * F.col("open_weight")
    first = F.first(F.when(is_open, F.struct("place", "open_words", "open_weight")), ignorenulls=True).over(
        Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    split = shares.withColumn("split", first)
    share = (F.col("weight") * F.col("split.open_words")).cast("double") / (F.col("split.open_weight") * 100).cast("double")
    full = (F.col("source_size") * most_copies).cast("double")
    return split.select("source", "source_size", F.when(F.col("place") >= F.col("split.place"), share).otherwise(full).alias("target"))


def pareto_cuts(ranked: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``cut``: ranks up to it are taken once more in each source, or below it where ``under`` is set."""
    source = F.col("source").eqNullSafe(F.col("p_source"))
    wanted = plan.select(F.col("source").alias("p_source"), (F.col("target") - F.col("whole") * F.col("source_size")).alias("wanted"))
    bins = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        bins.join(wanted, source).withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        .where("before < wanted and before + words >= wanted")
        .select(F.col("source").alias("b_source"), F.col("bin").alias("b_bin"), "before", "wanted")
    )
    peers = Window.partitionBy("b_source").orderBy("rank")
    inside = (
        ranked.join(last, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bin") == F.col("b_bin")))
        .groupBy("b_source", "rank").agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("wanted").alias("wanted"))
        .withColumn("through", F.col("before") + F.sum("words").over(peers))
        .withColumn("gap", F.abs(F.col("through") - F.col("wanted")))
        .groupBy("b_source").agg(
            F.min(F.struct("gap", "rank")).alias("best"),
            F.min(F.struct(F.col("rank"), (F.col("wanted") - F.col("before")).alias("empty"))).alias("none"),
        )
        # ending just before the bin's first rank can be the nearest, too
        .select("b_source", F.when(F.col("none.empty") <= F.col("best.gap"), F.col("none.rank")).otherwise(F.col("best.rank")).alias("cut"),
                (F.col("none.empty") <= F.col("best.gap")).alias("under"))
    )
    joined = plan.join(inside, F.col("source").eqNullSafe(F.col("b_source")), "left")
    return joined.select("source", "source_size", "target", "whole", "odds", "cut", F.coalesce("under", F.lit(False)).alias("under"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, budget_percent: int = BUDGET_PERCENT, most_copies: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken``.

    A document in the mix ``copies`` times brings ``taken = copies * size`` words.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    base = docs.drop(*[c for c in docs.columns if c in added])
    slim = stored(base.select(F.col(key).alias("key"), F.col(source).alias("source"), words_in(F.col(text)).alias("size")), "mix-sizes")
    plan = stored(
        source_targets(slim.select("source", "size"), weights, budget_percent, most_copies)
        .withColumn("times", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
        .withColumn("whole", F.floor("times"))
        .withColumn("p", F.col("times") - F.col("whole"))
        .select("source", "source_size", "target", "whole", (F.col("p") / (1 - F.col("p"))).alias("odds")),
        "mix-plan")
    u = uniform(F.col("key"), seed)
    rank = (u / (1 - u)) / F.col("p_odds")
    ranked = (
        slim.where("size > 0")
        .join(plan.where("odds > 0").select(F.col("source").alias("p_source"), F.col("odds").alias("p_odds")), F.col("source").eqNullSafe(F.col("p_source")))
        .select("source", "size", rank.alias("rank"))
        .withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))
    )
    cuts = stored(pareto_cuts(ranked, plan), "mix-cuts").select(
        F.col("source").alias("c_source"), "source_size", "target", "whole", "odds", "cut", "under")
    return taken_rows(base, cuts, key, text, source, seed)


def taken_rows(base: DataFrame, cuts: DataFrame, key: str, text: str, source: str, seed: str) -> DataFrame:
    """Apply the per-source cuts to the documents: one join on the source, no other shuffle.

    The table of cuts has a row per source; Spark broadcasts it if its stored
    size is below the session's threshold and else joins by sort and merge,
    where AQE splits a hot source.
    """
    u = uniform(F.col(key), seed)
    rank = (u / (1 - u)) / F.col("odds")
    drawn = (F.col("odds") > 0) & F.col("cut").isNotNull() & F.when(F.col("under"), rank < F.col("cut")).otherwise(rank <= F.col("cut"))
    names = base.columns
    return (
        base.withColumn("size", words_in(F.col(text)))
        .join(cuts, F.col(source).eqNullSafe(F.col("c_source")))
        .withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.when(drawn, 1).otherwise(0)).otherwise(0).cast("long"))
        .select(*names, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mixed_corpus(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the input's columns."""
    copies = F.array_repeat(F.lit(0), F.col("copies").cast("int"))
    return mix(docs, **how).withColumn("copy", F.explode(copies)).select(*docs.columns)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op10_mixing": op10_mixing}

ORACLE = {"op10_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
listed AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM sized GROUP BY source),
shares AS (
  SELECT source, source_size, weight, row_number() OVER lim AS place,
         150 * sum(source_size) OVER () - 200 * coalesce(sum(source_size) OVER (lim ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_words,
         sum(weight) OVER () - coalesce(sum(weight) OVER (lim ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_weight
  FROM listed WINDOW lim AS (ORDER BY source_size / weight ASC, source ASC NULLS LAST)),
split AS (
  SELECT place AS s_place, open_words AS s_words, open_weight AS s_weight FROM shares
  WHERE weight * open_words <= 200 * source_size * open_weight ORDER BY place LIMIT 1),
plan AS (
  SELECT source, source_size,
         CASE WHEN place >= s_place THEN CAST(weight * s_words AS DOUBLE) / CAST(100 * s_weight AS DOUBLE) ELSE CAST(2 * source_size AS DOUBLE) END AS target
  FROM shares LEFT JOIN split ON true),
odds AS (
  SELECT *, floor(times) AS whole, (times - floor(times)) / (1 - (times - floor(times))) AS odds,
         target - floor(times) * source_size AS wanted
  FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS times FROM plan)),
uni AS (
  SELECT doc_id, source, size, (CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u
  FROM sized),
ranked AS (
  SELECT s.*, p.source_size, p.target, p.whole, p.odds, p.wanted,
         CASE WHEN p.odds > 0 THEN (u / (1 - u)) / p.odds END AS rank
  FROM uni s JOIN odds p ON s.source IS NOT DISTINCT FROM p.source),
through AS (
  SELECT *, sum(CASE WHEN odds > 0 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank) AS upto FROM ranked),
nearest AS (
  SELECT source AS n_source, min(wanted) AS n_wanted, arg_min(rank, struct_pack(g := abs(upto - wanted), r := rank)) AS cut, min(abs(upto - wanted)) AS gap
  FROM through WHERE odds > 0 AND size > 0 GROUP BY source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size > 0 THEN (whole + CASE WHEN odds > 0 AND rank <= cut AND gap < n_wanted THEN 1 ELSE 0 END) * size ELSE 0 END AS BIGINT) AS taken
FROM through LEFT JOIN nearest ON source IS NOT DISTINCT FROM n_source
"""}
