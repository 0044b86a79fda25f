"""Headered, all-string CSV landings (statistics-office style labels).

Source files carry human labels as headers (``Reference area``,
``TIME_PERIOD``) and sometimes two headers that differ only by case
(``Measure`` and ``MEASURE``). With Spark's default case-insensitive
analysis such twins are ambiguous, and toggling ``spark.sql.caseSensitive``
around the read does not hold because the scan re-resolves names lazily.
So the files' first lines are read (a few bytes each, like Spark's own header
inference), and the files are scanned with a positional all-string schema;
labels are mapped to positions on the driver, never data.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapscope.labels import MISSING_COLUMNS_MESSAGE
from gapscope.sources.tables import require_path


#: A landing's side file is one short record.
MOST_SIDE_BYTES = 1 << 20
#: Bytes of a file read for its header at first, and at most; files read at a time.
HEADER_BYTES, MOST_HEADER_BYTES = 1 << 12, 1 << 20
HEADER_READS = 16


def landed_files(spark: SparkSession, path: str) -> list[str]:
    """The files that a scan of ``path`` reads; listed, not opened."""
    require_path(spark, path)
    return sorted(spark.read.schema("_c0 string").csv(path).inputFiles())


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line with anything in it of a (possibly compressed) file, from its first bytes; None if there is none.

    Grows from ``HEADER_BYTES`` to at most ``MOST_HEADER_BYTES``, whatever the file's length.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(hpath)
    size = HEADER_BYTES
    while True:
        stream = hpath.getFileSystem(conf).open(hpath)
        try:
            data = bytes((codec.createInputStream(stream) if codec else stream).readNBytes(size))
        finally:
            stream.close()
        text = data.removeprefix(b"\xef\xbb\xbf").lstrip(b"\r\n")
        line, end, _ = text.partition(b"\n")
        if end or len(data) < size:
            return line.rstrip(b"\r").decode("utf-8", "replace") or None
        if size >= MOST_HEADER_BYTES:
            raise ValueError(f"{file} has no line end in its first {size} bytes: no CSV header")
        size *= 16


def file_headers(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(file, first line) of every file of a landing that has one.

    A short read per file, ``HEADER_READS`` at a time: what is read does not grow with
    the files' length, and a header line per file is all that reaches the driver.
    """
    files = landed_files(spark, path)
    with ThreadPoolExecutor(HEADER_READS) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f), files))
    return [(f, line) for f, line in zip(files, lines) if line is not None]


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Labels of the landed CSV files; raises, naming two files, if their headers differ, as columns are read by place."""
    headers = file_headers(spark, path)
    if not headers:
        raise ValueError(f"No CSV header found under {path}")
    (least, low), (most, high) = (pick(headers, key=lambda h: (h[1], h[0])) for pick in (min, max))
    if low != high:
        raise ValueError(f"Files of one landing have different headers: {least} has {low!r}, {most} has {high!r}")
    return next(csv.reader([low]))


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, n): lines with more or fewer fields than the header, which a scan pads or cuts; files without any are absent."""
    lines = read_labelled_csv(spark, path, rejects="_line").select("_line", F.col("_metadata.file_path").alias("file"))
    return lines.where(F.col("_line").isNotNull()).groupBy("file").agg(F.count("*").alias("n"))


def require_columns(available: list[str], required) -> None:
    """Raise naming the missing and the available columns (exact, case-sensitive)."""
    missing = [c for c in required if c not in available]
    if missing:
        raise ValueError(MISSING_COLUMNS_MESSAGE.format(missing=missing, available=available))


def unique_names(labels: list[str]) -> list[str]:
    """Labels kept as they are, except later case-insensitive twins get ``_<pos>``."""
    seen: set[str] = set()
    out = []
    for i, lab in enumerate(labels):
        name = lab or f"_c{i}"
        if name.lower() in seen:
            name = f"{name}_{i}"
        seen.add(name.lower())
        out.append(name)
    return out


def read_labelled_csv(
    spark: SparkSession,
    path: str,
    select: Mapping[str, str] | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """Scan headered CSV files as all-string columns.

    ``select`` maps source labels to clean names: the labels are checked
    (error names missing and available ones), only those columns are kept
    (pruned at the scan) and renamed. Without it every column is returned,
    case twins disambiguated by position. All files must have one header.

    A line with more or fewer fields than the header is padded or cut.
    ``rejects`` names one more column that holds such a line whole, and null
    for others; the scan then splits all fields of a line, so that none
    passes because the fields it lacks were not asked for.
    """
    labels = read_header(spark, path)
    fields = [T.StructField(f"_c{i}", T.StringType(), True) for i in range(len(labels))]
    reader = spark.read.option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
    if rejects is not None:
        fields.append(T.StructField(rejects, T.StringType(), True))
        reader = reader.option("columnNameOfCorruptRecord", rejects).option("columnPruning", False)
    raw = reader.schema(T.StructType(fields)).csv(path)
    # Spark refuses plans that read nothing but the corrupt line, so it is tied to a field, of which it takes no character
    more = [] if rejects is None else [F.concat(F.substring(F.coalesce("_c0", F.lit("")), 1, 0), F.col(rejects)).alias(rejects)]
    if select is None:
        return raw.select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(unique_names(labels))], *more)
    require_columns(labels, select.keys())
    return raw.select(*[F.col(f"_c{labels.index(lab)}").alias(new) for lab, new in select.items()], *more)


def read_ingest_stamp(spark: SparkSession, folder: str, name: str = "_ingest_metadata.json") -> DataFrame:
    """The landing's side file as a one-row frame ``(ingested_at timestamp)``.

    ``_``-prefixed files are skipped by Spark's scans, so the side file can
    sit next to the landed data. For the same reason a plain side file is
    read through the Hadoop FileSystem (one small metadata document); a
    folder of that name (as Spark writes it) is read by Spark. A plain side
    file over ``MOST_SIDE_BYTES`` is refused.
    """
    path = f"{folder.rstrip('/')}/{name}"
    require_path(spark, path)
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(hpath).isDirectory():
        raw = spark.read.schema("ingested_at_utc string").json(path)
    else:
        size = fs.getFileStatus(hpath).getLen()
        if size > MOST_SIDE_BYTES:
            raise ValueError(f"{path} has {size} bytes: no side file of a landing")
        stream = fs.open(hpath)
        try:
            text = jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A").next()
        finally:
            stream.close()
        raw = spark.createDataFrame([(text,)], "doc string").select(
            F.get_json_object("doc", "$.ingested_at_utc").alias("ingested_at_utc")
        )
    return raw.select(F.to_timestamp("ingested_at_utc").alias("ingested_at"))
