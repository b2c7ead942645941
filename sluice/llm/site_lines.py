"""Line dedup by site-relative frequency (operator 10), in Spark functions only.

Pages are grouped by host; a line's ratio is the number of the host's pages that hold it, divided by the
host's pages.  Lines above the ratio are boilerplate and go from every page of that host.

Counts are summed by map tasks first, so a hot host or line is no hot group.  A host has at most
(lines per page) / ratio boilerplate lines, so its list is short whatever its number of pages.  The lists
are measured: up to ``broadcast_bytes`` of text go to the tasks and pages stay where they are; beyond that
pages and lists are joined by host, and AQE splits hot hosts.

The patterns for hidden text and tags look for an end from every start.  A start that has no end would read the page to
its last character, and a page full of them would take time with the square of its length.  So what follows the last
``>`` is kept as it is, and in pages of many openers those without an end are marked first, in one pass a kind: an opener
has an end if it is complete before the last closer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import written

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
#: What is not text, and the tags that end a line (fixed values).
HIDDEN = r"<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
BREAKS = r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)(?:[ \t\r\n/][^>]*)?>"


def host_of(url: Column) -> Column:
    """Lower-cased host; null where there is none."""
    return F.nullif(F.regexp_extract(F.lower(url), HOST, 1), F.lit(""))


#: So many openers may each read a page to its end; with more, those without an end are marked first.
FEW_OPENERS = 64
#: By kind: the part of a page before its last closer in which an opener is complete, and the openers.
_CLOSED = {"script": (r"(?is)^(.*>)[^>]*</script>", "(?i)<(?=script)"), "style": (r"(?is)^(.*>)[^>]*</style>", "(?i)<(?=style)"), "comment": (r"(?s)^(.*)-->", "<(?=!--)")}
_MARK, _ESCAPE = "\u0001", "\u0001\u0002"  # put after an opener's bracket; what stands for that character itself


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _rest(text: Column, start: Column) -> Column:
    return F.substring(text, F.char_length(start) + 1, F.char_length(text))


def _bare(head: Column) -> Column:
    """A part of a page that ends with ``>``, or is empty, without hidden text and tags."""
    shown = F.regexp_replace(head, f"(?is){HIDDEN}", " ")
    return F.regexp_replace(F.regexp_replace(shown, f"(?i){BREAKS}", "\n"), "<[^>]*>", "")


def _marked_bare(head: Column) -> Column:
    """The same for a part with many openers."""
    def marked(closed: str, opener: str):
        return lambda text: _let(F.regexp_extract(text, closed, 1), lambda safe: F.concat(safe, F.regexp_replace(_rest(text, safe), opener, f"<{_MARK}")))

    head = F.replace(head, F.lit(_MARK), F.lit(_ESCAPE))
    for closed, opener in _CLOSED.values():
        head = _let(head, marked(closed, opener))
    return F.replace(F.regexp_replace(_bare(head), f"{_MARK}(?!\u0002)", ""), F.lit(_ESCAPE), F.lit(_MARK))


def html_lines(html: Column) -> Column:
    """The non-empty lines of a page's visible text, spaces around them cut; null gives none."""
    text = F.coalesce(html, F.lit(""))
    tail = F.substring_index(text, ">", -1)  # what follows the last >
    head = F.left(text, F.char_length(text) - F.char_length(tail))
    many = F.regexp_count(text, F.lit("(?i)<(?:!--|script|style)")) > FEW_OPENERS
    whole = F.concat(F.when(many, _marked_bare(head)).otherwise(_bare(head)), tail)
    return F.filter(F.transform(F.split(whole, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def drop_site_boilerplate(pages: DataFrame, host: str, lines: str, ratio: float = 0.2, min_pages: int = 5,
                          kept: str = "kept", dropped: str = "n_dropped", broadcast_bytes: int = 16 << 20) -> DataFrame:
    """``pages`` with ``kept`` (array of lines) and ``dropped`` (their number), for an array column ``lines``.

    A line goes when more than ``ratio`` of its host's pages hold it.  Hosts with fewer than ``min_pages``
    pages, and pages without a host, keep all lines: they are no site to compare with.  A page counts once
    for a line it repeats, and all its copies of the line go; a repeated page is a page of its own.  Null
    ``lines`` count as none and give an empty array; null lines in an array are kept.  Columns named as the
    outputs are replaced, all others are kept.
    """
    pages = pages.drop(kept, dropped)
    held = F.coalesce(F.col(lines), F.expr("cast(array() as array<string>)"))
    base = pages.where(F.col(host).isNotNull()).select(F.col(host).alias("h"), held.alias("ls"))
    totals = base.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    counts = base.select("h", F.explode(F.array_distinct("ls")).alias("line")).groupBy("h", "line").agg(F.count("*").alias("c"))
    counts = counts.where((F.col("c") > ratio * min_pages) & F.col("line").isNotNull())
    common = counts.join(totals, "h").where(F.col("c") > ratio * F.col("n")).groupBy("h").agg(F.collect_list("line").alias("common"))
    common = written(common.select(F.col("h").alias("__h"), F.col("common").alias("__common")), "boilerplate")
    held_bytes = F.octet_length("__h") + F.aggregate("__common", F.lit(64), lambda n, x: n + F.octet_length(x) + 16)
    if (common.agg(F.sum(held_bytes)).first()[0] or 0) <= broadcast_bytes:
        common = F.broadcast(common)
    out = pages.join(common, F.col(host) == F.col("__h"), "left")
    rest = F.when(F.col("__common").isNull(), held).otherwise(F.filter(held, lambda x: x.isNull() | ~F.array_contains(F.col("__common"), x)))
    out = out.withColumn(kept, rest)
    return out.withColumn(dropped, (F.size(held) - F.size(kept)).cast("long")).drop("__h", "__common")
