"""Line dedup by site-relative frequency.

Pages are grouped by the host of their url.  A line's ratio is the number of
the host's pages that contain it divided by the host's pages; lines whose ratio
exceeds ``ratio`` are boilerplate and go from every page of the host, however small the host is.  A line
on one page alone (fewer than ``least`` pages) recurs nowhere and is no boilerplate.

Counts are grouped sums, combined before the shuffle; the table of boilerplate
lines is stored before it is joined back, so a host or line that a third of all
rows share is split over tasks.  Lines are compared trimmed, by 128 bits of hash.

Defined cases: NULL text has no lines; a url without a host (NULL included) belongs to the
host of the empty string; blank lines are neither counted nor dropped, but a page
left with blank lines alone becomes empty.  Repeated rows count as one page and are repeated in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.llm.common import discard, stored

RATIO = 0.3
LEAST = 2                     # pages a line must be on


def host(url: Column) -> Column:
    """Host of a url in lower case, without user and port."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def _line_keys(line: Column) -> tuple[Column, Column]:
    return F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(1)).alias("b")


def drop_lines(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "text",
               ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """(id_col, host, n_lines, n_dropped, text) for every row; n_lines counts
    lines with something on them."""
    rows = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.withColumns({"k": F.xxhash64("t"), "k2": F.xxhash64("t", F.lit(1))})
    # a page once, with the number of times it is there
    rows = stored(rows.groupBy("id", "host", "k", "k2").agg(F.min("t").alias("t"), F.count("*").alias("copies")), "site-pages")
    lines = rows.select("id", "host", "k", "k2", F.posexplode(F.split("t", "\n")).alias("at", "raw")).withColumn(
        "line", F.trim("raw")).filter("line <> ''")
    a, b = _line_keys(F.col("line"))
    found = rows.select("host", F.explode(F.array_distinct(F.transform(F.split("t", "\n"), F.trim))).alias("line")).filter(
        "line <> ''").select("host", a, b).groupBy("host", "a", "b").agg(F.count("*").alias("n"))
    totals = stored(rows.groupBy("host").agg(F.count("*").alias("pages")), "site-totals")
    # most lines are on one page and go here
    common = stored(found.filter(F.col("n") >= least), "site-common")
    bad = stored(common.join(totals, "host").filter(F.col("n") > F.lit(ratio) * F.col("pages")).select(
        "host", "a", "b", F.lit(True).alias("bad")), "site-boilerplate")
    discard(totals, common)
    # only places and hashes travel, not the lines
    hits = lines.select("id", "host", "k", "k2", "at", a, b).join(bad, ["host", "a", "b"]).groupBy(
        "id", "host", "k", "k2").agg(F.collect_list("at").alias("gone"))
    counted = rows.alias("r").join(
        hits.alias("p"), F.col("r.id").eqNullSafe(F.col("p.id")) & (F.col("r.host") == F.col("p.host"))
        & (F.col("r.k") == F.col("p.k")) & (F.col("r.k2") == F.col("p.k2")), "left").select(
        "r.id", "r.host", "r.copies", F.split("r.t", "\n").alias("ls"),
        F.coalesce("p.gone", F.array().cast("array<int>")).alias("gone"))
    left = F.array_except(F.sequence(F.lit(0), F.size("ls") - 1), "gone")
    counted = counted.withColumn("stay", F.transform(left, lambda i: F.get("ls", i)))
    out = counted.select(
        F.col("id").alias(id_col), "host", F.size(F.filter("ls", lambda x: F.trim(x) != "")).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.when(F.exists("stay", lambda x: F.trim(x) != ""), F.array_join("stay", "\n")).otherwise("").alias("text"), "copies")
    return out.withColumn("_c", F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))).drop("_c", "copies")
