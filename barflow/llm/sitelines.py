"""Line dedup by site-relative frequency: lines on too large a share of a host's pages are boilerplate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barflow.session import stage

# A line on more than this share of a host's pages goes, if on no fewer pages than these. A host mixes languages, so
# that a line on a fifth of the pages of one language is on a few hundredths of all.
RATIO, LEAST_PAGES = 0.01, 3

LINES = "split({text}, '\\n', -1)"
# The key of a line: blank lines have none and are neither counted nor dropped.
KEY = "IF(btrim({line}, ' \\t\\r') = '', CAST(NULL AS BIGINT), xxhash64(btrim({line}, ' \\t\\r')))"


def boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """(host, lines): the 64-bit keys of the lines on more than ``ratio`` of the host's pages.

    A page counts once for each of its lines, white space at its ends aside. Only keys are shuffled, added
    up before the shuffle; a page has at most 1 / ratio such lines per line of an average page, which bounds
    the list of a host. Two lines are confused if their keys agree within one host and one of the few
    frequent keys is involved: some 10**12 * 400 / 2**64 cases for 10**12 lines.
    """
    pages = docs.select(F.col(host).alias("host"), F.col(text).alias("text"))
    keys = F.expr(f"array_distinct(transform({LINES.format(text='text')}, l -> {KEY.format(line='l')}))")
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = (
        pages.select("host", F.explode(keys).alias("key")).where(F.col("key").isNotNull())
        .groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_pages)
    )
    same = F.col("c.host").eqNullSafe(F.col("t.host"))
    frequent = counts.alias("c").join(totals.alias("t"), same).where(F.col("n") > F.lit(ratio) * F.col("pages"))
    return frequent.groupBy("c.host").agg(F.sort_array(F.collect_list("key")).alias("lines"))


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """``docs`` with the boilerplate lines cut from ``text``, and ``n_lines`` and ``n_removed`` behind it.

    The other lines stay as they are, in order, joined by line feeds; blank lines always stay. Null texts stay
    null with 0 lines, empty texts empty; rows without a host count as one host; a table without rows gives
    none. Repeated rows count as pages of their own. A line on exactly the ratio stays. Lines of any length count by
    their key. Columns of ``docs`` may have any names but the two added ones. Texts are not shuffled while the staged list of lines
    is under Spark's broadcast threshold; beyond it the join by host splits skewed hosts (AQE).
    """
    for name in ("n_lines", "n_removed"):
        if name in docs.columns:
            raise ValueError(f"column {name} exists already")
    found = stage(boilerplate(docs, host, text, ratio, least_pages), "boilerplate")
    rows = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    page, body = (f"c{docs.columns.index(c)}" for c in (host, text))
    joined = rows.join(found, F.col(page).eqNullSafe(F.col("host")), "left")
    pieces = LINES.format(text=body)
    dropped = f"coalesce(array_contains(lines, {KEY.format(line='l')}), false)"
    nonblank = "btrim(l, ' \\t\\r') <> ''"
    cleaned = joined.withColumn("kept", F.expr(f"filter({pieces}, l -> NOT {dropped})")).withColumns({
        "n_lines": F.coalesce(F.expr(f"size(filter({pieces}, l -> {nonblank}))"), F.lit(0)),
        "n_removed": F.coalesce(F.expr(f"size({pieces})") - F.size("kept"), F.lit(0)),
    })
    none = F.col(body).isNull()
    return cleaned.select(
        *((F.array_join("kept", "\n") if c == body else F.col(c)).alias(name) for c, name in zip(rows.columns, docs.columns)),
        F.when(none, 0).otherwise(F.col("n_lines")).alias("n_lines"),
        F.when(none, 0).otherwise(F.col("n_removed")).alias("n_removed"),
    )


def clean_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the remaining text of every document; its source is its host."""
    chosen = docs.select("doc_id", "source", "text")
    return drop_boilerplate(chosen).select("doc_id", "n_lines", "n_removed", "text")


def clean_documents_sql() -> str:
    trimmed = "trim({}, ' ' || chr(9) || chr(13))"
    return f"""
    WITH pages AS (SELECT row_number() OVER () AS page, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
    totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
    page_lines AS (SELECT DISTINCT page, source, {trimmed.format('line')} AS line
        FROM (SELECT page, source, unnest(lines) AS line FROM pages)),
    frequent AS (
        SELECT l.source, l.line FROM page_lines l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
        WHERE l.line <> '' GROUP BY l.source, l.line, t.pages
        HAVING count(*) >= {LEAST_PAGES} AND count(*) > {RATIO}::DOUBLE * t.pages),
    numbered AS (SELECT page, source, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM pages),
    marked AS (
        SELECT n.*, f.line IS NOT NULL AS gone FROM numbered n
        LEFT JOIN frequent f ON n.source IS NOT DISTINCT FROM f.source AND {trimmed.format('n.line')} = f.line),
    cleaned AS (
        SELECT page, CAST(count(*) FILTER (WHERE {trimmed.format('line')} <> '') AS INTEGER) AS n_lines,
            CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS n_removed,
            coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
        FROM marked GROUP BY page)
    SELECT p.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed, c.text
    FROM pages p LEFT JOIN cleaned c USING (page)"""
