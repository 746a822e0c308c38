"""Line dedup by site-relative frequency.

A line is boilerplate of its host if more than a share of the host's pages hold it. Menus,
notices and footers go; a line that is common on one host stays on all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmeter.llm.common import fresh
from lexmeter.operators.skew import join_heavy_light
from lexmeter.sources.scratch import new_folder, written

#: Share of a host's pages beyond which a line goes, and pages that hold it at least: a line seen once stays.
RATIO = 0.3
LEAST_HOLDING = 2

# Fixed values.
HOST = r"://(?:[^/?#@]*@)?([^/?#:]*)"
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
BREAK = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>|[\r\n]+"
TAG = r"<[^>]*>"
GAP = r"[\x20\t\x0b\f]+"


def host(url: Column) -> Column:
    """Host of a URL in small letters, without port; empty for NULL or where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def page_lines(html: Column) -> Column:
    """Lines of the text a page shows: cut at block tags, inline tags dropped, blanks collapsed."""
    shown = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    broken = F.regexp_replace(F.regexp_replace(shown, BREAK, "\n"), TAG, "")
    lines = F.split(F.regexp_replace(broken, GAP, " "), "\n")
    return F.filter(F.transform(lines, lambda line: F.trim(line)), lambda line: line != "")


def boilerplate(
    pages: DataFrame, host_name: str, lines: str, ratio: float = RATIO, least_holding: int = LEAST_HOLDING
) -> DataFrame:
    """For every host, ``_drop``: digests of the lines that exceed the ratio on enough pages.

    A line counts once for a page, and each row is a page. The lists are bounded: a host
    has fewer such lines than lines on a mean page, divided by the ratio.
    """
    totals = pages.groupBy(host_name).agg(F.count(F.lit(1)).alias("_pages"))
    each = pages.select(host_name, F.explode(F.array_distinct(lines)).alias("_line"))
    each = each.select(host_name, F.unhex(F.md5("_line")).alias("_digest"))
    counts = each.groupBy(host_name, "_digest").agg(F.count(F.lit(1)).alias("_holding"))
    held = counts.where(F.col("_holding") >= least_holding).join(totals, host_name)
    often = held.where(F.col("_holding") > ratio * F.col("_pages"))
    lists = often.groupBy(host_name).agg(F.collect_list("_digest").alias("_drop"))
    return totals.select(host_name).join(lists, host_name, "left")


def drop_boilerplate(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    ratio: float = RATIO,
    least_holding: int = LEAST_HOLDING,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """Add ``host``, ``text`` without boilerplate lines, ``n_lines`` and ``n_dropped``.

    ``n_lines`` counts the lines before. Pages without a URL share the empty host. NULL and
    empty pages have no lines and an empty text, but count as pages. Lines equal within
    a page all stay or all go. All columns are carried, or those of ``carry``; columns with the
    added names are replaced. The lines are cut once, and written before they are counted.
    """
    added = ("host", "text", "n_lines", "n_dropped")
    kept = [c for c in (pages.columns if carry is None else carry) if c.lower() not in added]
    name, lines = fresh(pages.columns, "_host"), fresh(pages.columns, "_lines")
    placed = pages.select(*kept, host(F.col(url)).alias(name), page_lines(F.col(html)).alias(lines))
    placed = written(placed, f"{new_folder(pages.sparkSession)}/lines")
    joined = join_heavy_light(placed, boilerplate(placed, name, lines, ratio, least_holding), name)
    drop = F.coalesce("_drop", F.array().cast("array<binary>"))
    stays = F.filter(lines, lambda line: ~F.array_contains(drop, F.unhex(F.md5(line))))
    staged = joined.withColumn("_stays", F.when(F.size(drop) > 0, stays).otherwise(F.col(lines)))
    return staged.select(
        *kept,
        F.col(name).alias("host"),
        F.array_join("_stays", "\n").alias("text"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size("_stays")).cast("long").alias("n_dropped"),
    )


def op3_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every page without the boilerplate of its host."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    cleaned = drop_boilerplate(pages, carry=("page_id",))
    return cleaned.select("page_id", "host", "text", "n_lines", "n_dropped")


OP3_SQL = f"""
WITH p AS (
  SELECT row_number() OVER () AS rid, page_id,
    coalesce(lower(regexp_extract(url, '{HOST}', 1)), '') AS host,
    list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      coalesce(html, ''), '{HIDDEN}', ' ', 'g'), '{BREAK}', chr(10), 'g'), '{TAG}', '', 'g'),
      '{GAP}', ' ', 'g'), chr(10)), lambda line: trim(line)), lambda line: line <> '') AS lines
  FROM pages
), totals AS (
  SELECT host, count(*) AS pages FROM p GROUP BY host
), often AS (
  SELECT host, line
  FROM (SELECT host, line, count(DISTINCT rid) AS holding
        FROM (SELECT rid, host, unnest(lines) AS line FROM p) GROUP BY host, line)
  JOIN totals USING (host) WHERE holding >= {LEAST_HOLDING} AND holding > {RATIO} * pages
), cut AS (
  SELECT host, list(line) AS gone FROM often GROUP BY host
), stays AS (
  SELECT page_id, host, lines,
    list_filter(lines, lambda line: NOT list_contains(coalesce(gone, []), line)) AS kept
  FROM p LEFT JOIN cut USING (host)
)
SELECT page_id, host, coalesce(array_to_string(kept, chr(10)), '') AS text,
  len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped
FROM stays
"""
