"""Line dedup by site-relative frequency: drop the lines that most pages of a host share.

For each host, the pages that contain a line are divided by the host's pages; a line beyond the
boilerplate ratio goes, on a host of enough pages and if enough pages hold it. All with DataFrame functions: a page counts once for a line
however often it repeats it, counts are aggregated before they are shuffled, and each occurrence
meets its verdict in a join on the line's hash and host.

Defined cases: a null text has no lines; blank lines don't count and stay where they are between
kept lines; a null host is a host of its own; repeated rows are pages of their own; hosts below the least number of
pages keep everything; an empty table gives an empty result; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize

#: Share of a host's pages beyond which a line is boilerplate, least pages of a host, least pages that hold the line.
RATIO, LEAST_PAGES, LEAST_HITS = 0.1, 10, 3

# Elements whose start or end breaks a line, and elements whose content is no text.
BLOCKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
HIDDEN = "script|style|noscript|template"


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without user and port; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


_BREAK = f"(?is)<(?:!--.*?-->|({HIDDEN})\\b.*?</\\1\\s*>|/?(?:{BLOCKS})(?:[\\s/][^>]*)?>)"


def html_lines(html: Column) -> Column:
    """Text of an HTML page, a line for each block; comments and hidden elements end a line too. Character references stay as they are."""
    for space in "\t\n\x0b\f\r":  # few pages have any; regular expressions cost more
        html = F.replace(html, F.lit(space), F.lit(" "))
    t = F.regexp_replace(F.regexp_replace(html, _BREAK, "\n"), "<[^>]*>", "")
    return F.trim(F.regexp_replace(F.regexp_replace(t, " {2,}", " "), " ?\n[ \n]*", "\n"), F.lit(" \n"))


def drop_site_lines(pages: DataFrame, host: Column, text_col: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, least_hits: int = LEAST_HITS) -> DataFrame:
    """pages with the text without its host's boilerplate lines, and n_lines, n_dropped."""
    names = ("__host", "__lines", "n_lines", "n_dropped", "__hashes", "__bad", "__bad_host")
    h, lines, n_lines, n_dropped, hashes, bad, of_host = (free_name(pages, c) for c in names)
    split = pages.withColumns({h: F.coalesce(host, F.lit("\u0000")), lines: F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n", -1)})
    split = split.withColumn(hashes, F.transform(F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != ""), lambda x: F.xxhash64(x)))
    slim = split.select(F.col(h).alias("host"), F.col(hashes).alias("hashes"))
    totals = slim.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least_pages)
    held = slim.select("host", F.explode(F.array_distinct("hashes")).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    # A line must be on several pages to exceed the ratio: most lines are gone before the join.
    held = held.where((F.col("n") > F.lit(ratio * least_pages)) & (F.col("n") >= least_hits)).join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("pages"))
    # A host's list is bounded by 1 / ratio times the average lines of its pages, however many pages it has.
    bads = materialize(held.groupBy("host").agg(F.collect_list("line").alias("bad")), "boilerplate").withColumnRenamed("host", of_host).withColumnRenamed("bad", bad)
    out = split.join(bads, split[h] == F.col(of_host), "left")
    goes = lambda x: F.coalesce(F.array_contains(F.col(bad), F.xxhash64(F.trim(x))), F.lit(False)) & (F.trim(x) != "")
    kept = F.when(F.col(bad).isNull(), F.col(lines)).otherwise(F.filter(lines, lambda x: ~goes(x)))
    text = F.when(F.col(text_col).isNull(), None).otherwise(F.array_join(kept, "\n"))
    out = out.withColumns({n_lines: F.size(lines), n_dropped: F.size(lines) - F.size(kept), text_col: text})
    return out.select(*[F.col(f"`{c}`") for c in pages.columns], n_lines, n_dropped)
