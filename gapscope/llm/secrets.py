"""Secret scans (DataFrame functions only): fixed patterns and a randomness test battery.

Three kinds come from patterns: ``assign`` (a name like ``password`` and a
value of 6 or more characters), ``access`` (``AKIA`` keys of 20 or more) and
``hex`` (24 or more lower-case hex digits). The battery adds ``random``:
runs of 20 or more key-like characters, with a digit and a letter or letters
of both cases, that look like uniform draws from the alphabet of the encoding
inferred for them. Spans of the other kinds are cut out of a run; what is left
on either side is tested. Besides a whole run, its parts between ``/`` and its
parts between ``/``, ``_`` and ``-`` are tested, so a path or a prefix does
not hide a key; of runs within each other, the outermost that is reported
stands for all. Per run it computes a chi-squared test of
alphabet uniformity, a runs test and a lag-one serial correlation test, and
takes three times the smallest p-value. Ordinary identifiers are then
*rejected* as random by the Benjamini-Hochberg rule over all candidates of
the corpus, separately for each encoding and length band; the allowed rate
falls with length, because the tests of a short run have little power. What
is not rejected is reported.

The corpus-wide step needs only a histogram of p-values (encodings x bands x
cells, a bounded table), summed with map-side combine. Positions are code
points, end exclusive. No step gathers or shuffles documents.

Defined results: null and empty texts have no spans; repeated rows are
scanned alike; an empty table gives an empty table; an input column named
``secrets`` is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapscope.llm.common import let, read, stored

# Fixed patterns of the contract.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGNED = 6

LEAST_RUN = 20
RUN = rf"[A-Za-z0-9+/_-]{{{LEAST_RUN},}}"
#: A run's parts between slashes, and between any separators.
PARTS = (rf"[A-Za-z0-9+_-]{{{LEAST_RUN},}}", rf"[A-Za-z0-9+]{{{LEAST_RUN},}}")
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {"hex": DIGITS + LOWER[:6], "base32": UPPER + "234567", "base36": DIGITS + LOWER, "letters": UPPER + LOWER, "base64": UPPER + LOWER + DIGITS + "+/"}
BANDS = (32, 48, 80)
#: Allowed share of falsely rejected runs: RATE at RATE_LENGTH characters, more for shorter runs.
RATE, RATE_LENGTH, MOST_RATE = 0.05, 64, 0.25
CELLS_PER_DECADE, LAST_CELL = 8, 240
MASK = "[SECRET]"
_BLOCK = 256


# --- positions ------------------------------------------------------------------


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>> of the leftmost non-overlapping matches.

    Splitting on the pattern gives the stretches between the matches, so the
    offsets are running sums of lengths. They are summed in blocks, which
    keeps a text with very many matches cheap.
    """
    found = F.struct(F.split(text, pattern, -1).alias("parts"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")

    def offsets(b: Column) -> Column:
        steps = F.zip_with(F.slice(b["parts"], 1, F.size(b["hits"])), b["hits"],
                           lambda p, h: F.struct(F.length(p).cast("long").alias("lead"), F.length(h).cast("long").alias("size"), h.alias("hit")))
        return F.when(F.size(b["hits"]) == 0, none).otherwise(let(steps, placed))

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x["lead"] + x["size"])

    def placed(steps: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")), lambda k: total(F.slice(steps, k * _BLOCK + 1, F.lit(_BLOCK))))
        return let(blocks, lambda sums: let(
            F.transform(sums, lambda _, k: F.aggregate(F.slice(sums, F.lit(1), k), F.lit(0).cast("long"), lambda a, x: a + x)),
            lambda before: F.transform(steps, lambda x, i: at(steps, before, x, i))))

    def at(steps: Column, before: Column, x: Column, i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        start = F.element_at(before, block + 1) + total(F.slice(steps, block * _BLOCK + 1, i % _BLOCK)) + x["lead"]
        return F.struct(start.alias("start"), (start + x["size"]).alias("end"), x["hit"].alias("hit"))

    return let(found, offsets)


def base_spans(text: Column) -> Column:
    """array<struct<start, kind_no, end>> of the pattern kinds, in order."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")
    lower = F.lower(text)
    named = lower.contains(ASSIGN_NAMES[0])
    for name in ASSIGN_NAMES[1:]:
        named = named | lower.contains(name)
    assign = F.when(named, F.filter(located(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= LEAST_ASSIGNED)).otherwise(none)
    access = F.when(text.contains("AKIA"), located(text, ACCESS)).otherwise(none)
    hexes = F.when(text.rlike(HEX), located(text, HEX)).otherwise(none)
    return F.array_sort(F.concat(*[of_kind(n, spans) for n, spans in enumerate((assign, access, hexes))]))


def of_kind(kind_no: int, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind_no).alias("kind_no"), s["end"].alias("end")))


# --- the battery ----------------------------------------------------------------


def normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal; a rational approximation of erfc (error below 2e-7), relative in the tail."""
    # Coefficients of the Chebyshev fit of erfc, lowest power first.
    fit = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)

    def upper(x: Column, t: Column) -> Column:
        power = F.lit(fit[-1])
        for c in reversed(fit[:-1]):
            power = power * t + c
        return t * F.exp(-x * x + power) / 2

    tail = lambda v: let(F.abs(v) / math.sqrt(2), lambda x: let(1 / (1 + x / 2), lambda t: upper(x, t)))
    return let(z, lambda v: let(tail(v), lambda p: F.when(v >= 0, p).otherwise(1 - p)))


def chi_squared_tail(x: Column, freedom: Column) -> Column:
    """P(chi-squared > x), by the cube-root normal approximation."""
    v = 2.0 / (9.0 * freedom)
    return normal_tail((F.pow(x / freedom, F.lit(1.0 / 3)) - (1 - v)) / F.sqrt(v))


def inferred_encoding(run: Column) -> Column:
    """Name of the smallest alphabet that fits; null for runs of digits only or of letters of one case."""
    mixed = (run.rlike("[0-9]") & run.rlike("[A-Za-z]")) | (run.rlike("[a-z]") & run.rlike("[A-Z]"))
    return F.when(mixed, F.when(run.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(run.rlike("^[A-Z2-7]+$"), "base32")
                  .when(run.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), "base36").when(run.rlike("^[A-Za-z]+$"), "letters").otherwise("base64"))


def p_value(run: Column, encoding: Column) -> Column:
    """Three times the smallest of the battery's p-values, under uniform independent characters."""
    alphabet = F.element_at(F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair]), encoding)
    plain = F.when(encoding.isin("hex", "base36"), F.lower(run)).when(encoding == "base64", F.translate(run, "-_", "+/")).otherwise(run)
    given = F.struct(F.split(plain, "", -1).alias("chars"), alphabet.alias("alphabet"))
    digits = let(given, lambda g: F.transform(F.filter(g["chars"], lambda c: c != ""), lambda c: F.position(c, g["alphabet"]).cast("double") - 1))
    sums = let(F.struct(digits.alias("x"), F.length(alphabet).cast("double").alias("a")), _battery)
    return F.least(F.lit(1.0), 3 * sums)


def _battery(g: Column) -> Column:
    x, a = g["x"], g["a"]
    n = F.size(x).cast("double")
    return let(F.greatest(F.lit(2.0), F.least(a, F.floor(n / 5).cast("double"))), lambda bins: _smallest(x, a, n, bins))


def _smallest(x: Column, a: Column, n: Column, bins: Column) -> Column:
    zero = F.lit(0.0)

    def deviation(k: Column) -> Column:
        wide = F.ceil((k + 1) * a / bins) - F.ceil(k * a / bins)
        expected = n * wide / a
        seen = F.size(F.filter(x, lambda v: F.floor(v * bins / a) == k))
        return F.pow(seen - expected, F.lit(2.0)) / expected

    chi = F.aggregate(F.sequence(F.lit(0), (bins - 1).cast("int")), zero, lambda s, k: s + deviation(k))
    uniformity = chi_squared_tail(chi, bins - 1)

    neighbours = F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), lambda u, v: F.struct(u.alias("u"), v.alias("v")))

    def runs_test(high: Column, pairs: Column) -> Column:
        runs = 1 + F.size(F.filter(pairs, lambda p: (p["u"] >= a / 2) != (p["v"] >= a / 2)))
        return let(2 * high * (n - high), lambda both: let(
            both * (both - n) / (n * n * (n - 1)),
            lambda spread: F.when(spread <= 0, zero).otherwise(2 * normal_tail(F.abs(runs - (both / n + 1)) / F.sqrt(spread)))))

    def serial_test(mean: Column, pairs: Column) -> Column:
        power = F.aggregate(x, zero, lambda s, v: s + (v - mean) * (v - mean))
        lagged = F.aggregate(pairs, zero, lambda s, p: s + (p["u"] - mean) * (p["v"] - mean))
        return let(power, lambda w: F.when(w <= 0, zero).otherwise(2 * normal_tail(F.abs(lagged / w + 1 / n) * F.sqrt(n))))

    high = F.size(F.filter(x, lambda v: v >= a / 2)).cast("double")
    mean = F.aggregate(x, zero, lambda s, v: s + v) / n
    return let(neighbours, lambda pairs: F.least(
        uniformity, let(high, lambda h: runs_test(h, pairs)), let(mean, lambda m: serial_test(m, pairs))))


def free_of(run: Column, base: Column) -> Column:
    """array<struct<start, end, hit>>: the stretches of ``run`` outside the base spans, of ``LEAST_RUN`` characters or more."""
    kind = "array<struct<start:bigint,end:bigint,hit:string>>"

    def stretch(g: Column, end: Column) -> Column:
        hit = F.substr(run["hit"], (g["at"] - run["start"] + 1).cast("int"), (end - g["at"]).cast("int"))
        long = F.array(F.struct(g["at"].alias("start"), end.alias("end"), hit.alias("hit")))
        return F.when(end - g["at"] >= LEAST_RUN, F.concat(g["out"], long)).otherwise(g["out"])

    def cut(spans: Column) -> Column:
        start = F.struct(run["start"].alias("at"), F.array().cast(kind).alias("out"))
        step = lambda g, b: F.struct(F.greatest(g["at"], b["end"]).alias("at"), stretch(g, b["start"]).alias("out"))
        return F.aggregate(spans, start, step, lambda g: stretch(g, run["end"]))

    touching = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    return let(touching, lambda spans: F.when(F.size(spans) == 0, F.array(run)).otherwise(cut(spans)))


def candidates(text: Column, base: Column) -> Column:
    """array<struct<start, end, hit>>: runs and their parts outside the base spans, each once, by position."""
    levels = [F.flatten(F.transform(located(text, pattern), lambda s: free_of(s, base))) for pattern in (RUN, *PARTS)]
    return let(F.array_sort(F.concat(*levels)), lambda all_: F.filter(all_, lambda s, i: (i == 0) | (F.get(all_, i - 1) != s)))


def outermost(runs: Column) -> Column:
    """array<struct<start, end>>: ``runs`` without those inside another one."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out"))

    def step(g: Column, r: Column) -> Column:
        own = F.array(F.struct(r["start"].alias("start"), (-r["back"]).alias("end")))
        return F.struct(F.greatest(g["at"], -r["back"]).alias("at"), F.when(-r["back"] > g["at"], F.concat(g["out"], own)).otherwise(g["out"]).alias("out"))

    return F.aggregate(F.array_sort(F.transform(runs, lambda r: F.struct(r["start"].alias("start"), (-r["end"]).alias("back")))), start, step, lambda g: g["out"])


def tested_runs(text: Column, base: Column) -> Column:
    """array<struct<start, end, stratum, cell>> of the candidates."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,stratum:string,cell:int>>")

    def tested(s: Column) -> Column:
        size = s["end"] - s["start"]
        band = F.lit(len(BANDS))
        for k in reversed(range(len(BANDS))):
            band = F.when(size < BANDS[k], k).otherwise(band)
        cell = F.floor(-F.log10(F.greatest(p_value(s["hit"], s["encoding"]), F.lit(1e-300))) * CELLS_PER_DECADE)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat_ws(":", s["encoding"], band.cast("string")).alias("stratum"),
                        F.least(cell, F.lit(LAST_CELL)).cast("int").alias("cell"))

    named = F.transform(candidates(text, base), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"), inferred_encoding(s["hit"]).alias("encoding")))
    return F.when(text.rlike(RUN), F.transform(F.filter(named, lambda s: s["encoding"].isNotNull()), tested)).otherwise(none)


def rejection_cells(runs: DataFrame) -> DataFrame:
    """(stratum, cut): runs whose cell is ``cut`` or more are rejected as ordinary; one row per stratum that rejects any.

    Benjamini-Hochberg on a grid: a cell's edge stands for its p-values, which
    errs towards keeping a run. The table has at most encodings x bands x
    cells rows before the cut is taken.
    """
    histogram = runs.groupBy("stratum", "cell").count()
    of_stratum = F.collect_list(F.struct("cell", "count"))  # at most LAST_CELL + 1 entries
    lengths = dict(enumerate((20, *BANDS)))
    rate = F.element_at(F.create_map(*[F.lit(x) for k, v in lengths.items() for x in (str(k), min(MOST_RATE, RATE * RATE_LENGTH / v))]), F.element_at(F.split("stratum", ":"), 2))

    def passes(h: Column, cells: Column) -> Column:
        reached = F.aggregate(cells, F.lit(0).cast("long"), lambda s, c: s + F.when(c["cell"] >= h["cell"], c["count"]).otherwise(0))
        everything = F.aggregate(cells, F.lit(0).cast("long"), lambda s, c: s + c["count"])
        edge = F.pow(F.lit(10.0), -h["cell"] / F.lit(float(CELLS_PER_DECADE)))
        return edge * everything <= F.col("rate") * reached

    return (histogram.groupBy("stratum").agg(of_stratum.alias("cells")).withColumn("rate", rate)
            .select("stratum", F.array_min(F.transform(F.filter("cells", lambda h: passes(h, F.col("cells"))), lambda h: h["cell"])).alias("cut"))
            .where("cut is not null"))


# --- operators ------------------------------------------------------------------


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: array<struct<start, kind_no, end>> by start, then kind (``KINDS`` order).

    Two passes over the texts: one for the corpus-wide p-value histogram,
    one for the spans.
    """
    names = [c for c in docs.columns if c != "secrets"]
    base = docs.select(*names)
    value = F.coalesce(F.col(text), F.lit(""))
    runs = base.select(F.explode(let(base_spans(value), lambda b: tested_runs(value, b))).alias("run")).select("run.stratum", "run.cell")
    cuts = stored(rejection_cells(runs), "secret-cells")
    limits = cuts.agg(F.map_from_entries(F.collect_list(F.struct("stratum", "cut"))).alias("m")).scalar()
    found = let(base_spans(value), lambda b: F.struct(b.alias("base"), tested_runs(value, b).alias("runs")))
    random = F.filter("_found.runs", lambda r: r["cell"] < F.coalesce(F.try_element_at(F.col("_limits"), r["stratum"]), F.lit(LAST_CELL + 1)))
    added = of_kind(KINDS.index("random"), outermost(random))
    return (base.withColumn("_found", found).withColumn("_limits", limits)
            .withColumn("secrets", F.array_sort(F.concat("_found.base", added))).drop("_found", "_limits"))


def span_list(secrets: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(secrets, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, secrets: Column, mask: str = MASK) -> Column:
    """``text`` with each span, or run of overlapping spans, replaced by ``mask``."""
    def step(g: Column, s: Column) -> Column:
        fresh = s["start"] >= g["at"]
        piece = F.concat(F.substr(text, (g["at"] + 1).cast("int"), (s["start"] - g["at"]).cast("int")), F.lit(mask))
        return F.struct(F.greatest(g["at"], s["end"]).alias("at"), F.when(fresh, F.concat(g["out"], F.array(piece))).otherwise(g["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    whole = F.aggregate(secrets, start, step, lambda g: F.concat(F.concat_ws("", g["out"]), F.substr(text, (g["at"] + 1).cast("int"), F.length(text))))
    return F.when(text.isNull() | (F.size(secrets) == 0), text).otherwise(whole)


def without_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every document, with its secrets masked; same columns."""
    found = scan(docs, text)
    clean = found.withColumn(text, redacted(F.col(text), F.col("secrets")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda n: F.size(F.filter("secrets", lambda s: s["kind_no"] == n)).cast("long")
    base = F.filter("secrets", lambda s: s["kind_no"] < KINDS.index("random"))
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("secrets")).alias("spans"))


QUERIES = {"op8_secrets": op8_secrets}
