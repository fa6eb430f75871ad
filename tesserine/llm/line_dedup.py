"""Line deduplication by site-relative frequency (operator 2).

A line is boilerplate on a host when it is repeated, that is, on two pages at least, and the
share of the host's pages that contain it is above `ratio`. Only DataFrame functions. Lines are
counted by 64-bit hash, once a page, and combined before the shuffle, so a line on every
page of a host costs a row a task. The lines of a host above the ratio number at most its
mean lines a page over the ratio, so one array a host holds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: The table of boilerplate lines is broadcast up to so many lines, else joined by host.
BROADCAST_LINES = 100_000
EDGE = " \t\r\x0b\x0c"


def host_of(url: Column) -> Column:
    """The host that a URL names, in lower case without its port; null where it names none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)), F.lit(""))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(EDGE)))


def boilerplate(docs: DataFrame, ratio: float) -> DataFrame:
    """docs (host, text) -> host, lines: the hashes of its boilerplate lines."""
    filled = F.filter(_lines(F.col("text")), lambda x: F.btrim(x, F.lit(EDGE)) != "")
    keys = docs.select("host", F.explode(F.array_distinct(F.transform(filled, _key))).alias("line"))
    seen = keys.groupBy("host", "line").agg(F.count("*").alias("n"))
    pages = docs.groupBy("host").agg(F.count("*").alias("pages")).withColumnRenamed("host", "_host")
    often = seen.filter("n >= 2").join(pages, F.col("host").eqNullSafe(F.col("_host"))).filter(F.col("n") > ratio * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(docs: DataFrame, text_col: str = "text", host_col: str = "source", ratio: float = 0.1) -> DataFrame:
    """docs with two more columns, _n_lines and _n_dropped, and boilerplate lines taken out
    of the text. Lines end at a line feed and are compared without ASCII space around them.

    Blank lines are never counted or dropped. Null text stays null with 0 lines, empty text
    has one blank line. A null host is a host of its own; a line of a host with one page always
    stays. A line repeated on a page counts
    once and is dropped wherever it stands. Repeated rows are pages of their own. An empty
    table gives an empty result. All other columns stay.
    """
    found = written(boilerplate(docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text")), ratio), "boilerplate")
    small = (found.agg(F.sum(F.size("lines"))).first()[0] or 0) <= BROADCAST_LINES
    found = found.select(F.col("host").alias("_host"), F.col("lines").alias("_boilerplate"))
    out = docs.join(F.broadcast(found) if small else found, F.col(host_col).eqNullSafe(F.col("_host")), "left")
    lines = _lines(F.col(text_col))
    keep = F.filter(lines, lambda x: (F.btrim(x, F.lit(EDGE)) == "") | ~F.array_contains(F.col("_boilerplate"), _key(x)))
    out = out.withColumn("_kept", F.when(F.col("_boilerplate").isNotNull(), keep))
    return (
        out.withColumn("_n_lines", F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).cast("long"))
        .withColumn("_n_dropped", F.coalesce(F.col("_n_lines") - F.when(F.col("_kept").isNotNull(), F.size("_kept")), F.lit(0)).cast("long"))
        .withColumn(text_col, F.when(F.col("_n_dropped") > 0, F.array_join("_kept", "\n")).otherwise(F.col(text_col)))
        .drop("_host", "_boilerplate", "_kept")
    )


def query(docs: DataFrame) -> DataFrame:
    return drop_boilerplate(docs).select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), "text")


ORACLE_SQL = """
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS key FROM l),
n AS (SELECT source, key, count(DISTINCT doc_id) AS n FROM k WHERE key <> '' GROUP BY source, key),
p AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
b AS (SELECT n.source, n.key FROM n JOIN p ON n.source IS NOT DISTINCT FROM p.source WHERE n.n >= 2 AND n.n > 0.1 * p.pages),
j AS (SELECT k.doc_id, k.pos, k.line, b.key IS NOT NULL AS drop FROM k LEFT JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.key = b.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drop) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT drop), '') AS text
FROM j GROUP BY doc_id
"""
