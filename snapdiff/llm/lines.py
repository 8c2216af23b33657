"""Line dedup by site-relative frequency (native DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdiff.llm.text import free_names

#: A line is boilerplate on a host when more than this share of the host's pages has it ...
MAX_RATIO = 0.05
#: ... and so many of its pages at least (a host with two pages has no boilerplate to speak of).
MIN_PAGES = 5


def _key(line):
    return F.md5(F.trim(line).cast("binary"))


def line_frequencies(docs: DataFrame, host: str = "source", text: str = "text", copies_once: bool = False) -> DataFrame:
    """``host, line_key, pages, host_pages``: pages of the host holding each line.

    A line is a ``\\n``-split piece without outer blanks; a page counts once for
    a line however often it repeats it, and blank lines are not counted. Every
    row is a page (repeated rows count each); a null host is a host of its own;
    null texts count in ``host_pages`` only. Counting is partial per map task,
    so a hot host or line sends one row a task.

    With ``copies_once`` a page is a distinct text of its host (the null text is
    one), so a group of exact copies counts once for its lines and its host. The
    texts' md5 sums are counted, not the texts, and are dealt out with the line.
    """
    if copies_once:
        return _distinct_frequencies(docs, host, text)
    rows = docs.select(F.col(host).alias("host"), F.col(text).alias("text"))
    lines = rows.select(
        "host",
        F.explode(F.array_distinct(F.transform(F.split("text", "\n", -1), lambda x: F.trim(x)))).alias("line"),
    ).where(F.length("line") > 0)
    seen = lines.groupBy("host", _key(F.col("line")).alias("line_key")).agg(F.count(F.lit(1)).alias("pages"))
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    return (
        seen.alias("s")
        .join(totals.alias("t"), F.col("s.host").eqNullSafe(F.col("t.host")))
        .select("s.host", "line_key", "pages", "host_pages")
    )


def _distinct_frequencies(docs: DataFrame, host: str, text: str) -> DataFrame:
    rows = docs.select(
        F.col(host).alias("host"), F.col(text).alias("text"),
        F.coalesce(F.unhex(F.md5(F.col(text).cast("binary"))), F.lit(b"")).alias("page"),
    )
    lines = rows.select(
        "host", "page",
        F.explode(F.array_distinct(F.transform(F.split("text", "\n", -1), lambda x: F.trim(x)))).alias("line"),
    ).where(F.length("line") > 0)
    # two steps: copies fall together by (host, line, page), so no hot line meets in one task
    held = lines.select("host", F.unhex(_key(F.col("line"))).alias("line_key"), "page").distinct()
    seen = held.groupBy("host", "line_key").agg(F.count(F.lit(1)).alias("pages"))
    totals = rows.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    return (
        seen.alias("s")
        .join(totals.alias("t"), F.col("s.host").eqNullSafe(F.col("t.host")))
        .select("s.host", F.lower(F.hex("line_key")).alias("line_key"), "pages", "host_pages")
    )


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text",
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """``host, line_key`` of the lines on more than ``max_ratio`` of their host's pages.

    Rare lines are filtered before the join with the host totals.
    """
    found = line_frequencies(docs, host, text, copies_once)
    return found.where((F.col("pages") >= min_pages) & (F.col("pages") > F.col("host_pages") * max_ratio)).select(
        "host", "line_key"
    )


def dedup_lines(docs: DataFrame, host: str = "source", text: str = "text", id_col: str = "doc_id",
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, stats: bool = False,
                copies_once: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``; every row stays.

    Columns and their order are kept (working columns take names that no column
    has). Other lines, blank ones included, stay in order. A text that is all
    boilerplate becomes the empty text; null texts stay null; an empty table
    gives an empty table. Repeated rows get the same result each. With
    ``copies_once``, exact copies in a host count as one page. With ``stats``,
    two columns ``n_lines`` (lines, blank ones too) and ``n_dropped`` follow
    (their names must be free).

    The few (row, line) pairs that hit boilerplate are grouped by row, which is
    bounded by a text's lines, and joined back on (id, host); texts are shuffled once.
    """
    bad = boilerplate(docs, host, text, max_ratio, min_pages, copies_once)
    rows = docs.select(F.col(id_col).alias("id"), F.col(host).alias("host"), F.col(text).alias("text"))
    lines = rows.select(
        "id", "host", F.explode(F.array_distinct(F.transform(F.split("text", "\n", -1), lambda x: F.trim(x)))).alias("line")
    ).where(F.length("line") > 0)
    keyed = lines.select("id", "host", _key(F.col("line")).alias("line_key"))
    hits = (
        keyed.alias("k")
        .join(bad.alias("b"),
              F.col("k.host").eqNullSafe(F.col("b.host")) & (F.col("k.line_key") == F.col("b.line_key")), "left_semi")
        .groupBy("id", "host").agg(F.collect_set("line_key").alias("cut"))
    )
    k_id, k_host, k_cut, k_lines = free_names(docs, "_cut_id", "_cut_host", "_cut_keys", "_cut_lines")
    hits = hits.select(F.col("id").alias(k_id), F.col("host").alias(k_host), F.col("cut").alias(k_cut))
    joined = docs.join(
        hits, docs[id_col].eqNullSafe(hits[k_id]) & docs[host].eqNullSafe(hits[k_host]), "left"
    )
    kept = F.when(F.col(k_cut).isNull(), F.col(text)).otherwise(
        F.array_join(
            F.filter(F.split(F.col(text), "\n", -1),
                     lambda line: (F.length(F.trim(line)) == 0) | ~F.array_contains(F.col(k_cut), _key(line))),
            "\n",
        )
    )
    columns = [kept.alias(c) if c == text else F.col(c) for c in docs.columns]
    if not stats:
        return joined.select(*columns)
    n = F.coalesce(F.size(F.split(F.col(text), "\n", -1)), F.lit(0))
    n = F.when(F.col(text).isNull(), 0).otherwise(n).cast("long")
    dropped = F.when(F.col(k_cut).isNull() | F.col(text).isNull(), 0).otherwise(
        F.size(F.filter(F.split(F.col(text), "\n", -1),
                        lambda line: (F.length(F.trim(line)) > 0) & F.array_contains(F.col(k_cut), _key(line))))
    ).cast("long")
    return joined.select(*columns, n.alias("n_lines"), dropped.alias("n_dropped"))
