"""Line dedup by distinct-site spread: lines that occur on many sites are kept once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.scratch import write_table

#: A line on so many sites is boilerplate.
MIN_SITES = 10
#: 2 ** LG_K registers: a standard error of 1.04 / 2 ** (LG_K / 2), here 1.6 %.
LG_K = 12
#: Estimates this close to the threshold (share of it, one site at least) are counted exactly: six standard errors.
NEAR = 0.1
#: Share of the spread lines' occurrences above which a line is hot; there are fewer than 1 / HOT such lines.
HOT = 1e-3


def _rows(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """Every input row whole, beside the columns used here."""
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[id_col].alias("doc_id"),
        docs[text_col].alias("text"),
        docs[site_col].cast("string").alias("site"),
        F.xxhash64(docs[text_col]).alias("text_hash"),
    )


def _lines(rows: DataFrame) -> DataFrame:
    """One row per line that isn't blank, with 128 bits of its trimmed text's hash."""
    at = rows.select("doc_id", "text_hash", "site", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    line = F.btrim("line", F.lit(" \t\r\x0b\x0c"))
    return at.select(
        "doc_id", "text_hash", "site", "line_no", line.alias("line")
    ).where("line <> ''").select(
        "doc_id", "text_hash", "site", "line_no",
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"),
    )


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The lines on ``min_sites`` sites or more: h1, h2, n (occurrences) and first (smallest doc_id, line_no).

    A sketch of the sites per line, merged by aggregation, decides far from the threshold; lines
    near it get an exact distinct count. Rows without a site count for no site.
    """
    key = ["h1", "h2"]
    seen = lines.groupBy(*key).agg(
        F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"),
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("doc_id", "line_no")).alias("first"),
    )
    estimate = F.hll_sketch_estimate("sketch").alias("sites")
    # a line on min_sites sites has as many occurrences
    known, _ = write_table(
        seen.where(F.col("n") >= min_sites).select(*key, "n", "first", estimate).where(F.col("sites") >= min_sites * (1 - NEAR) - 1)
    )
    margin = max(1.0, NEAR * min_sites)
    near = F.abs(F.col("sites") - min_sites) <= margin
    exact = (
        lines.join(known.where(near).select(*key), key, "left_semi")
        .groupBy(*key)
        .agg(F.countDistinct("site").alias("exact"))
        .where(F.col("exact") >= min_sites)
    )
    sure = known.where(F.col("sites") > min_sites + margin)
    return sure.unionByName(known.where(near).join(exact.select(*key), key, "left_semi")).select(*key, "n", "first")


def remove_spread_lines(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
) -> DataFrame:
    """Every row of ``docs`` as ``row``, with doc_id, n_lines, n_removed, n_left and kept_text.

    A line's text is compared without white space at its ends; blank lines stay and count neither
    as lines nor as removed. A line on ``min_sites`` distinct sites or more is removed everywhere
    but at its first occurrence (smallest doc_id, nulls first, then smallest line number; rows that
    share the id and the line number both keep it). Null and empty texts have no lines and stay as
    they are; rows without a site add no site, but lose the lines that others spread. A very long text
    is cut into all its lines. An empty table gives no rows; other columns stay in ``row``, whatever
    their names.
    """
    key = ["h1", "h2"]
    rows = _rows(docs, id_col, text_col, site_col)
    lines = _lines(rows)
    spread, sums = write_table(spread_lines(lines, min_sites), n=F.sum("n"))
    hot = max(1.0, (sums["n"] or 0) * HOT)
    at = lines.select("doc_id", "text_hash", "line_no", *key)
    # fewer than 1 / HOT lines can have a share of HOT each: they are sent to the tasks, the others are joined
    often = at.join(F.broadcast(spread.where(F.col("n") > hot)), key)
    seldom = at.join(spread.where(F.col("n") <= hot), key)
    own = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.line_no") == F.col("line_no"))
    gone = (
        often.unionByName(seldom)
        .where(~own)
        .groupBy(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
        .agg(F.collect_set("line_no").alias("gone"))
    )
    joined = rows.join(
        gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash")), "left"
    ).select("row", "doc_id", "text", "gone", F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    n_lines = F.size(F.filter("lines", lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")) != "")).cast("bigint")
    n_gone = F.coalesce(F.size("gone"), F.lit(0)).cast("bigint")
    return joined.select(
        "row",
        "doc_id",
        n_lines.alias("n_lines"),
        F.greatest(n_gone, F.lit(0)).alias("n_removed"),
        (n_lines - F.greatest(n_gone, F.lit(0))).alias("n_left"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
    )


def report(removed: DataFrame) -> DataFrame:
    return removed.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
