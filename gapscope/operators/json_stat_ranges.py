"""JSON-stat cubes larger than a task: one document read by many tasks.

``read_json_stat_ranges`` reads a document as the pieces between its commas, so
Spark splits the file into byte ranges like any text file. A piece has the range
it lies in and a row number that ascends within the range. Here the pieces are
put in place and sorted into values and the rest:

1. Per range: the number of pieces and of quotes. Summed over the ranges before,
   they give the place of a range's first piece and whether it begins in a string.
2. Ranges that hold a quote are read for what lies outside strings: the depth
   of brackets, keys ``value``, closing brackets. Only pieces with a bracket or an
   odd number of quotes can change any of these, so only they are exchanged: a
   number, a whole entry of a map, a whole label are not.
3. The ``value`` key at depth one and the bracket that closes it bound the
   values. A value's place in a list is the number of commas since then; a map
   states it.

The rest of the text, with the values cut out, is an ordinary small document:
its dimensions and categories must fit a task, its values need not. No group
holds more than one range of a file.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapscope.operators.json_stat import dimension_ids, parsed_documents, placed_cells, shape_columns, usable
from gapscope.sources.tables import stored

_KEY = r'^\s*"value"\s*:\s*([\[{])'
_FIRST_KEY = r'^\s*\{\s*"value"\s*:\s*([\[{])'


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _holds(text: Column, marks: str) -> Column:
    """Does ``text`` hold one of the characters? Most pieces hold none, which spares them the steps below."""
    return reduce(or_, [F.contains(text, F.lit(m)) for m in marks])


def _unescaped(text: Column) -> Column:
    """``text`` without its backslash escapes, so that every quote left begins or ends a string."""
    return F.when(_holds(text, "\\"), F.regexp_replace(text, r"\\.", "")).otherwise(text)


def _outside(inside: Column, text: Column) -> Column:
    """What of ``text`` lies outside strings, given whether it begins inside one."""
    whole = F.when(inside, F.concat(F.lit('"'), text)).otherwise(text)
    return F.regexp_replace(whole, r'"[^"]*("|$)', "")


def _steps(text: Column) -> Column:
    """Opened minus closed brackets."""
    opened = F.length(text) - F.length(F.translate(text, "[{", ""))
    return F.when(_holds(text, "[]{}"), opened - (F.length(text) - F.length(F.translate(text, "]}", "")))).otherwise(0)


def marking_pieces(pieces: DataFrame) -> DataFrame:
    """The pieces that open or close a string or a bracket: with a bracket, or an odd number of quotes."""
    return pieces.where((_quotes(_unescaped(F.col("piece"))) % 2 == 1) | _holds(F.col("piece"), "[]{}"))


def value_bounds(pieces: DataFrame) -> DataFrame:
    """(doc, block, first, before, start, stop): each range of a document with the places of its values.

    ``first`` is the least row of the range and ``before`` the number of
    pieces of the document ahead of it. ``start`` and ``stop`` are the places of
    the pieces that hold the opening and closing bracket of the values; both are
    null for a document that lacks either.
    """
    bare = _unescaped(F.col("piece"))
    ahead = Window.partitionBy("doc").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy("doc", "block").agg(
        F.min("row").alias("first"), F.count("*").alias("n"), F.sum(_quotes(bare)).alias("quotes"),
        F.sum(_steps(bare)).alias("steps"), F.min(F.when(_holds(F.col("piece"), "]}"), F.col("row"))).alias("closes"),
    )
    blocks = stored(
        blocks.select("doc", "block", "first", "quotes", "steps", "closes", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"),
                      (F.coalesce(F.sum("quotes").over(ahead), F.lit(0)) % 2 == 1).alias("inside")),
        "json_stat_ranges",
    )
    # ranges with strings: depth and marks, by the pieces that bear on them
    quoted = marking_pieces(pieces).join(blocks.where("quotes > 0").select("doc", "block", "first", "before", "inside"), ["doc", "block"])
    earlier = Window.partitionBy("doc", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    parity = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) + F.col("inside").cast("int")
    quoted = quoted.withColumn("quotes", _quotes(bare)).withColumn("within", parity % 2 == 1)
    quoted = quoted.withColumn("steps", _steps(_outside(F.col("within"), bare)))
    quoted = quoted.withColumn("depth", F.coalesce(F.sum("steps").over(earlier), F.lit(0)))
    place = F.col("before") + F.col("row") - F.col("first")
    key = (~F.col("within")) & (F.col("piece").rlike(_KEY) | ((place == 0) & F.col("piece").rlike(_FIRST_KEY)))
    # a key in the document's first piece has the bracket of the document before it
    key_depth = F.when(place == 0, F.lit(1)).otherwise(F.col("depth"))
    marks = quoted.groupBy("doc", "block").agg(  # a range without such pieces has no steps and no marks
        F.sum("steps").alias("steps"),
        F.collect_list(F.when(key, F.struct(place.alias("place"), key_depth.alias("depth")))).alias("keys"),
        # the least depth a piece reaches outside strings is that after its closing brackets
        F.collect_list(F.when(_outside(F.col("within"), bare).rlike(r"[\]}]"), place)).alias("closing"),
    )
    plain = blocks.where("quotes = 0").select(
        "doc", "block", F.when(F.col("inside"), F.lit(0)).otherwise(F.col("steps")).alias("steps"),
        F.expr("cast(array() AS array<struct<place: bigint, depth: bigint>>)").alias("keys"),
        F.expr("CASE WHEN closes IS NOT NULL AND NOT inside THEN array(before + closes - first) ELSE cast(array() AS array<bigint>) END").alias("closing"),
    )
    marks = marks.unionByName(plain).withColumn("deep", F.coalesce(F.sum("steps").over(ahead), F.lit(0)))
    marks = stored(marks.select("doc", "deep", "keys", "closing"), "json_stat_marks")
    keys = marks.select("doc", "deep", F.explode("keys").alias("k")).where("k.place = 0 OR deep + k.depth = 1")
    start = keys.groupBy("doc").agg(F.min("k.place").alias("start"))
    closing = marks.select("doc", F.explode("closing").alias("place")).join(start, "doc").where("place >= start")
    bounds = closing.groupBy("doc").agg(F.min("start").alias("start"), F.min("place").alias("stop"))
    return stored(blocks.select("doc", "block", "first", "before").join(bounds, "doc", "left"), "json_stat_bounds")


def split_documents(pieces: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents, values, bounds)``: (doc, text) with the values cut out, (doc, block, place, raw), and ``value_bounds``.

    ``raw`` is the value's text, null for a null of a map; nulls of a list
    are left out. ``place`` is null for what is no entry of a map.
    """
    bounds = value_bounds(pieces)
    at = pieces.join(bounds, ["doc", "block"]).withColumn("at", F.expr("before + row - first"))
    opening = F.expr(r"""CASE WHEN at = start THEN regexp_extract(piece, r'^(\s*\{?\s*"value"\s*:\s*[\[{])', 1) ELSE '' END""")
    at = at.withColumn("opening", opening).withColumn("listed", F.expr("CASE WHEN at = start THEN right(opening, 1) = '[' END"))
    body = F.expr("substr(piece, length(opening) + 1)")
    at = at.withColumn("body", body).withColumn("shut", F.expr(r"CASE WHEN at = stop THEN regexp_extract(body, r'^[^\]}]*', 0) END"))
    value = F.expr("CASE WHEN at = stop THEN shut WHEN at >= start AND at < stop THEN body END")
    rest = F.expr(
        "CASE WHEN start IS NULL OR at < start OR at > stop THEN concat(if(at = 0, '', ','), piece)"
        " WHEN at = stop THEN concat(if(at = start AND at > 0, ',', ''), opening, substr(body, length(shut) + 1))"
        " WHEN at = start THEN concat(if(at = 0, '', ','), opening) END"
    )
    # nulls of a list say no more than the count of pieces does
    at = at.where("start IS NULL OR at <= start OR at >= stop OR piece != 'null'")
    plain = F.when(_holds(value, "\t\r\n"), F.regexp_replace(value, r"[\t\r\n]", " ")).otherwise(value)
    parts = stored(at.select("doc", "block", "at", "start", F.trim(plain).alias("value"), rest.alias("rest")), "json_stat_parts")
    documents = parts.where("rest is not null").groupBy("doc").agg(
        F.expr("array_join(transform(array_sort(collect_list(struct(at, rest))), x -> x.rest), '')").alias("text")
    )
    entry = r'^"((?:[^"\\]|\\.)*)"\s*:\s*(.*)$'
    values = parts.where("value not in ('', 'null')").select(
        "doc", "block", (F.col("at") - F.col("start")).alias("nth"),
        F.regexp_extract("value", entry, 1).alias("key"), F.regexp_extract("value", entry, 2).alias("keyed"), "value",
    )
    values = values.withColumn("in_map", F.col("value").rlike(entry))
    text = F.regexp_replace(F.when(F.col("in_map"), F.col("keyed")).otherwise(F.col("value")), '^"(.*)"$', "$1")
    values = values.select(
        "doc", "block", "in_map",
        F.when(F.col("in_map"), F.col("key").try_cast("bigint")).otherwise(F.col("nth")).alias("offset"),
        F.when(text != "null", text).alias("raw"),
    )
    return documents, values.where("in_map or raw is not null").drop("in_map"), bounds


def decode_json_stat_ranges(pieces: DataFrame, dimensions: Sequence[str] | None = None, keep_doc: bool = False, on_error: str = "fail") -> DataFrame:
    """``read_json_stat_ranges`` -> the rows of ``decode_json_stat``, a document's values spread over as many tasks as it has ranges.

    Values must be numbers or nulls: a string that holds a comma or a
    bracket makes its cell, or the document, one that ``on_error`` names or
    leaves out. Steps are stored in the scratch folder as this is called.
    """
    if on_error not in ("fail", "reject"):
        raise ValueError("on_error is 'fail' or 'reject'")
    documents, values, bounds = split_documents(pieces)
    parsed = stored(parsed_documents(documents), "json_stat_parsed")
    dims = list(dimensions) if dimensions is not None else dimension_ids(parsed)
    parsed = usable(parsed, on_error)
    # a document's shape goes to each of its ranges, so its values never meet in one task
    shapes = bounds.select("doc", "block").join(parsed.select("doc", *shape_columns(dims)), "doc")
    return placed_cells(values.join(shapes, ["doc", "block"]).drop("block"), parsed, dims, keep_doc, on_error)
