"""Lines that much of a site repeats, by the share of its pages that hold them.

The share of a line is the number of pages of the host that hold it over the number of pages of the host. Pages with the
same text count once: otherwise a copied page would make boilerplate of its own content. Lines are compared without
leading and trailing spaces, by a 64-bit hash within their host.

Defined results: a null text stays null and counts as no page; empty lines are never dropped; a null host is a host of
its own; a text of which every line is dropped becomes empty, its row stays. Repeated rows are treated alike; there are
no ties. Texts are read whole, whatever their length. Other columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, query, table
from tidemark.session import cut_lineage

#: A line is boilerplate if it is on more than this share of the pages of its host, and on so many pages at least.
MAX_SHARE = 0.05
MIN_PAGES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _keys(text: Column) -> Column:
    """Hashes of the different lines of a text that are not empty."""
    return F.array_distinct(F.array_remove(F.transform(_lines(text), _key), F.xxhash64(F.lit(""))))


def boilerplate(
    pages: DataFrame, host: str, text: str, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(host, lines): hashes of the boilerplate lines of each host.

    Counting combines before each shuffle, first by line and page, so that neither a large host nor a line on very many
    pages falls to one task. A host has at most (mean number of lines of its pages / ``max_share``) boilerplate lines.
    """
    rows = pages.where(F.col(text).isNotNull()).select(
        F.col(host).alias("host"), F.xxhash64(text).alias("page"), F.col(text).alias("text")
    )
    totals = rows.groupBy("host").agg(F.countDistinct("page").alias("total"))
    counted = rows.select("host", "page", F.explode(_keys(F.col("text"))).alias("line"))
    counted = counted.groupBy("host", "line").agg(F.countDistinct("page").alias("pages"))
    counted = counted.where(F.col("pages") >= min_pages).alias("c")
    joined = counted.join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
    frequent = joined.where(F.col("pages") > F.col("total") * max_share)
    return frequent.groupBy(F.col("c.host").alias("host")).agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    pages: DataFrame, host: str, text: str, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES
) -> tuple[DataFrame, str, str]:
    """The pages with ``text`` reduced to the other lines, and the names of two new columns: lines there were, and dropped.

    The boilerplate of all hosts is written to the shared folder first. Spark then knows its size: it is broadcast if
    small, else joined by host with large hosts split.
    """
    key, lines, n_lines, n_dropped, gone = fresh(pages, "host_key", "host_lines", "n_lines", "n_dropped", "gone")
    frequent = cut_lineage(boilerplate(pages, host, text, max_share, min_pages))
    frequent = frequent.select(F.col("host").alias(key), F.col("lines").alias(lines))
    joined = pages.join(frequent, F.col(host).eqNullSafe(F.col(key)), "left")
    none = F.array().cast("array<bigint>")
    found = joined.withColumn(gone, F.array_intersect(_keys(F.col(text)), F.coalesce(F.col(lines), none)))
    kept = F.filter(_lines(F.col(text)), lambda line: ~F.array_contains(F.col(gone), _key(line)))
    count = F.coalesce(F.size(_lines(F.col(text))), F.lit(0))
    some = F.coalesce(F.size(gone), F.lit(0)) > 0
    columns = [F.when(some, F.array_join(kept, "\n")).otherwise(F.col(text)).alias(text) if c == text else F.col(c) for c in pages.columns]
    dropped = F.when(some, count - F.size(kept)).otherwise(0)
    return found.select(*columns, count.alias(n_lines), dropped.alias(n_dropped)), n_lines, n_dropped


def drop_site_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the boilerplate of their source. ``n_chars`` follows the text where that changes."""
    cleaned, _, dropped = drop_boilerplate(docs, "source", "text")
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col(dropped) > 0, length).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


OP8_SQL = f"""
WITH pages AS (SELECT source AS host, text FROM documents WHERE text IS NOT NULL GROUP BY 1, 2),
totals AS (SELECT host, count(*) AS total FROM pages GROUP BY 1),
held AS (SELECT host, unnest(list_distinct([trim(x) for x in string_split(text, chr(10))])) AS line FROM pages),
counted AS (SELECT host, line, count(*) AS pages FROM held WHERE line <> '' GROUP BY 1, 2),
bad AS (SELECT c.host, list(line) AS lines FROM counted c JOIN totals t ON c.host IS NOT DISTINCT FROM t.host
  WHERE pages >= {MIN_PAGES} AND pages > total * CAST({MAX_SHARE} AS DOUBLE) GROUP BY 1),
split AS (SELECT doc_id, text, string_split(text, chr(10)) AS all_lines, coalesce(lines, []::VARCHAR[]) AS lines
  FROM documents d LEFT JOIN bad b ON d.source IS NOT DISTINCT FROM b.host),
kept AS (SELECT *, [x for x in all_lines if NOT list_contains(lines, trim(x))] AS kept FROM split)
SELECT doc_id, CASE WHEN len(kept) < len(all_lines) THEN coalesce(array_to_string(kept, chr(10)), '') ELSE text END AS text,
  CAST(coalesce(len(all_lines), 0) AS INTEGER) AS n_lines,
  CAST(coalesce(len(all_lines) - len(kept), 0) AS INTEGER) AS n_dropped FROM kept"""


@query("op8_linefreq", OP8_SQL)
def op8_linefreq(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the lines that over a twentieth of their source's pages hold."""
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    cleaned, n_lines, n_dropped = drop_boilerplate(documents, "source", "text")
    return cleaned.select("doc_id", "text", F.col(n_lines).alias("n_lines"), F.col(n_dropped).alias("n_dropped"))
