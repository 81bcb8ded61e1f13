"""Profiles, their differences, correlations and selection on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.correlation import correlations
from millrace.functions.neighbours import neighbour_information
from millrace.operators import profile as p
from millrace.operators import profile_diff as d
from millrace.operators.select import (
    CorrelationThreshold,
    MutualInformation,
    VarianceThreshold,
    mutual_information,
    variances,
)
from millrace.plans.jobs import profile_diff
from millrace.sources.scratch import write_table
from workload.preparation import SENTINELS, _HOLED, orders_with_customer, rounded, sentinel_null, table

# --- profiles --------------------------------------------------------------------------


def _holed_lineitem(spark, sf):
    """lineitem with its zero sentinels taken out, so that there is something missing."""
    from millrace.operators.clean import ZeroToNull

    return ZeroToNull(columns=SENTINELS).transform(table(spark, sf, "lineitem"))


def profile_missing(spark, sf):
    return rounded(p.missing_summary(_holed_lineitem(spark, sf)), 6, "pct_missing", "pct_zero")


def profile_cardinality(spark, sf):
    report = p.cardinality_report(table(spark, sf, "part").drop("p_retailprice"))
    return rounded(report, 6, "top_pct")


def profile_cardinality_numeric(spark, sf):
    """Doubles as values: only counts are compared, number spelling differs between engines."""
    report = p.cardinality_report(table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_tax"))
    return rounded(report.drop("top_value"), 6, "top_pct")


def profile_distribution(spark, sf):
    report = p.distribution_summary(table(spark, sf, "lineitem").select(*DISTRIBUTED))
    return rounded(report, 4, "mean", "std", "min", "p25", "median", "p75", "max", "skew", "kurtosis")


def profile_dtypes(spark, sf):
    return p.dtype_audit(_audited(spark, sf))


def _audited(spark: SparkSession, sf: str) -> DataFrame:
    """Columns stored in wider types than their values need."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("customer_text"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date_text"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("No").alias("finished"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("finished_bit"),
        F.floor("o_totalprice").cast("double").alias("whole_price"),
        "o_totalprice",
        "o_orderpriority",
    )


def _redundant(spark, sf):
    """Numbers derived from whole texts, computed once and written."""
    numbers = table(spark, sf, "documents").select(
        "n_chars",
        F.length("text").cast("bigint").alias("text_length"),
        F.size(F.split("text", " ")).cast("bigint").alias("words"),
        (F.length("text") - F.length(F.regexp_replace("text", "e", ""))).cast("bigint").alias("letters_e"),
    )
    return write_table(numbers)[0]


def profile_redundancy(spark, sf):
    return rounded(p.redundancy_report(_redundant(spark, sf), 0.95), 6, "correlation")


def label_distribution(spark, sf):
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    labelled = documents.select("doc_id").join(labels.select("doc_id", "quality"), "doc_id", "left")
    return rounded(p.label_distribution(labelled, "quality"), 6, "pct")


def profile_whole(spark, sf):
    """All reports of one table in one call, one row per report with its number of rows."""
    data, _ = write_table(orders_with_customer(spark, sf))
    reports = p.profile(data, "o_orderstatus", id_col="o_orderkey")
    rows = None
    for name, report in reports.items():
        one = report.agg(F.count(F.lit(1)).alias("rows")).withColumn("report", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return rows.select("report", "rows")


# --- differences -----------------------------------------------------------------------

SPEC = {
    "name": "fill_and_encode",
    "preprocessing": [
        {"type": "redundant_dropper", "columns_to_drop": ["l_shipdate", "l_suppkey"]},
        {"type": "zero_to_nan", "columns": SENTINELS},
        {"type": "numeric_imputer", "strategy": "median"},
        {"type": "ordinal_encoder"},
    ],
}


def _diff(spark, sf, report):
    raw = table(spark, sf, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return profile_diff(raw, SPEC, id_col="l_orderkey", label_col=None)["diff"][report]


def _prepared(spark, sf):
    """(before, after) of the preparation in ``SPEC``, for the single reports."""
    from millrace.plans.spec import build_pipeline

    raw = table(spark, sf, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    pipeline = build_pipeline(SPEC, id_col="l_orderkey", label_col=None)
    return raw.drop("l_orderkey"), pipeline.fit(raw).transform(raw).drop("l_orderkey")


def diff_missing(spark, sf):
    before, after = (p.missing_summary(x) for x in _prepared(spark, sf))
    return rounded(d.diff_missing(before, after), 6, "pct_missing_before", "pct_missing_after", "pct_change")


def diff_cardinality(spark, sf):
    before, after = (p.cardinality_report(x) for x in _prepared(spark, sf))
    return d.diff_cardinality(before, after)


def diff_distribution(spark, sf):
    columns = ["l_quantity", "l_discount", "l_tax", "l_returnflag"]
    before, after = (p.distribution_summary(x.select(*columns)) for x in _prepared(spark, sf))
    diff = d.diff_distribution(before, after)
    return rounded(diff, 4, *[c for c in diff.columns if c != "column"])


def diff_dtypes(spark, sf):
    before, after = (p.dtype_audit(x) for x in _prepared(spark, sf))
    return d.diff_dtypes(before, after)


def diff_redundancy(spark, sf):
    before = _redundant(spark, sf)
    model = CorrelationThreshold(threshold=0.999, method="pearson").fit(before)
    after = model.transform(before).withColumn("twice", F.col("words") * 2)
    reports = [p.redundancy_report(x, 0.95) for x in (before, after)]
    return rounded(d.diff_redundancy(*reports), 6, "correlation")


def diff_whole(spark, sf):
    """The whole before/after run, its missing-share difference returned."""
    diff = _diff(spark, sf, "missing")
    return rounded(diff, 6, "pct_missing_before", "pct_missing_after", "pct_change")


# --- correlation and selection ---------------------------------------------------------


def _pairs(spark, found, digits=6):
    rows = [(a, b, r) for (a, b), r in found.items()]
    df = spark.createDataFrame(rows, "col_a string, col_b string, correlation double")
    return rounded(df, digits, "correlation")


def corr_pearson(spark, sf):
    df = _redundant(spark, sf)
    return _pairs(spark, correlations(df, df.columns, "pearson"))


def corr_spearman(spark, sf):
    df = _redundant(spark, sf)
    return _pairs(spark, correlations(df, df.columns, "spearman"))


GAPPED = ["l_discount", "l_tax", "l_quantity"]


def corr_pearson_gaps(spark, sf):
    df = _holed_lineitem(spark, sf).select(*GAPPED)
    return _pairs(spark, correlations(df, GAPPED, "pearson"))


def corr_spearman_gaps(spark, sf):
    df = _holed_lineitem(spark, sf).select(*GAPPED)
    return _pairs(spark, correlations(df, GAPPED, "spearman"))


def _kept(spark, model, df):
    return spark.createDataFrame([(c,) for c in model.transform(df).columns], "kept string")


def corr_select_pearson(spark, sf):
    df = _redundant(spark, sf)
    return _kept(spark, CorrelationThreshold(method="pearson").fit(df), df)


def corr_select_spearman(spark, sf):
    df = _redundant(spark, sf)
    return _kept(spark, CorrelationThreshold().fit(df), df)


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DISTRIBUTED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def variance_report(spark, sf):
    found = variances(table(spark, sf, "lineitem"), NUMBERS)
    return rounded(spark.createDataFrame(list(found.items()), "column string, variance double"), 4, "variance")


def variance_select(spark, sf):
    df = table(spark, sf, "lineitem").select(*NUMBERS)
    return _kept(spark, VarianceThreshold(threshold=0.01).fit(df), df)


INFORMATIVE = ["o_totalprice", "c_acctbal", "c_nationkey"]


def mi_scores(spark, sf):
    numbers, _ = write_table(orders_with_customer(spark, sf).select("o_orderstatus", *INFORMATIVE))
    found = mutual_information(numbers, INFORMATIVE, "o_orderstatus")
    return rounded(spark.createDataFrame(list(found.items()), "column string, score double"), 6, "score")


def mi_neighbours(spark, sf):
    """From nearest neighbours among the values themselves, without noise: equal values stay equal. Money in cents: distances are exact."""
    cents = [F.round(F.col(c) * 100).cast("bigint").alias(c) for c in ("o_totalprice", "c_acctbal")]
    numbers, _ = write_table(orders_with_customer(spark, sf).select("o_orderkey", "o_orderstatus", *cents, "c_nationkey"))
    found = neighbour_information(numbers, INFORMATIVE, "o_orderstatus", noise=0.0, id_col="o_orderkey")
    return rounded(spark.createDataFrame(list(found.items()), "column string, score double"), 6, "score")


def mi_select(spark, sf):
    df = _audited(spark, sf).select("o_orderkey", "finished", "finished_bit", "whole_price", "o_totalprice")
    model = MutualInformation(k=1, idCol="o_orderkey", labelCol="finished").fit(df)
    return _kept(spark, model, df)


QUERIES = {
    f.__name__: f
    for f in (
        profile_missing,
        profile_cardinality,
        profile_cardinality_numeric,
        profile_distribution,
        profile_dtypes,
        profile_redundancy,
        label_distribution,
        profile_whole,
        diff_missing,
        diff_cardinality,
        diff_distribution,
        diff_dtypes,
        diff_redundancy,
        diff_whole,
        corr_pearson,
        corr_spearman,
        corr_pearson_gaps,
        corr_spearman_gaps,
        corr_select_pearson,
        corr_select_spearman,
        variance_report,
        variance_select,
        mi_scores,
        mi_neighbours,
        mi_select,
    )
}

# --- oracles ---------------------------------------------------------------------------

LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _column_sql(c: str) -> str:
    return f"nullif({c}, 0)" if c in SENTINELS else c


def _missing_sql() -> str:
    parts = []
    for c, kind in LINEITEM_TYPES.items():
        x = _column_sql(c)
        zero = "CAST(NULL AS DOUBLE)"
        if kind in ("bigint", "int", "double"):
            zero = f"round(count(*) FILTER ({x} = 0) / CAST(count(*) AS DOUBLE), 6)"
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({x} IS NULL) AS n_missing, "
            f"round(count(*) FILTER ({x} IS NULL) / CAST(count(*) AS DOUBLE), 6) AS pct_missing, "
            f"{zero} AS pct_zero, '{kind}' AS dtype FROM lineitem"
        )
    return _union(parts)


def _cardinality_sql(source: str, types: dict[str, str], *, top: bool) -> str:
    parts = []
    for c, kind in types.items():
        encoding = "'numeric'"
        if kind == "string":
            encoding = (
                "CASE WHEN count(*) = 1 THEN 'drop' WHEN count(*) = 2 THEN 'binary' "
                "WHEN count(*) <= 50 THEN 'onehot' ELSE 'target_encode' END"
            )
        value = 'CAST(arg_min(v, (-n, v)) AS VARCHAR) AS top_value, ' if top else ""
        parts.append(
            f"SELECT '{c}' AS \"column\", '{kind}' AS dtype, count(*) AS n_unique, {value}"
            f"max(n) AS top_freq, round(max(n) / CAST(max(total) AS DOUBLE), 6) AS top_pct, "
            f"{encoding} AS suggested_encoding "
            f"FROM (SELECT {c} AS v, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1), "
            f"(SELECT count(*) AS total FROM {source})"
        )
    return _union(parts)


def _distribution_sql(source: str, columns: list[str]) -> str:
    def one(c: str) -> str:
        x = f"CAST({c} AS DOUBLE)"
        return (
            f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({x}), 4) AS mean, "
            f"round(stddev_samp({x}), 4) AS std, round(min({x}), 4) AS min, "
            f"round(quantile_cont({x}, 0.25), 4) AS p25, round(median({x}), 4) AS median, "
            f"round(quantile_cont({x}, 0.75), 4) AS p75, round(max({x}), 4) AS max, "
            f"round(skewness({x}), 4) AS skew, round(kurtosis({x}), 4) AS kurtosis FROM {source}"
        )

    return _union(one(c) for c in columns)


_REDUNDANT = """
    SELECT n_chars, CAST(length(text) AS BIGINT) AS text_length,
           CAST(len(string_split(text, ' ')) AS BIGINT) AS words,
           CAST(length(text) - length(replace(text, 'e', '')) AS BIGINT) AS letters_e
    FROM documents"""
_REDUNDANT_COLUMNS = ["n_chars", "text_length", "words", "letters_e"]


def _pair_names(columns: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]


def _pearson_sql(source: str, columns: list[str]) -> str:
    return _union(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS correlation FROM ({source})"
        for a, b in _pair_names(columns)
    )


def _spearman_sql(source: str, columns: list[str]) -> str:
    def rank(c: str) -> str:
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"

    return _union(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(ra, rb), 6) AS correlation FROM "
        f"(SELECT {rank(a)} AS ra, {rank(b)} AS rb FROM ({source}) WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
        for a, b in _pair_names(columns)
    )


def _greedy_sql(pairs: str, columns: list[str], threshold: float) -> str:
    """A column stays if no earlier kept column is correlated with it."""
    ctes = [f"c AS ({pairs})"]
    for i, c in enumerate(columns):
        clash = " OR ".join(
            f"(EXISTS (SELECT 1 FROM k{j} WHERE kept) AND EXISTS (SELECT 1 FROM c WHERE col_a = '{earlier}' "
            f"AND col_b = '{c}' AND abs(correlation) >= {threshold}))"
            for j, earlier in enumerate(columns[:i])
        )
        ctes.append(f"k{i} AS (SELECT '{c}' AS name, NOT ({clash or 'false'}) AS kept)")
    kept = _union(f"SELECT name AS kept FROM k{i} WHERE kept" for i in range(len(columns)))
    return f"WITH {', '.join(ctes)}\n{kept}"


def _mi_sql(source: str, label: str, columns: dict[str, bool], bins: int = 20) -> str:
    """``columns``: name -> whether it has few values, each its own bin."""
    probs = ", ".join(str(i / bins) for i in range(1, bins))
    parts = []
    for c, few in columns.items():
        x = f"CAST({c} AS DOUBLE)"
        if few:
            binned = f"SELECT {x} AS bin, {label} AS y FROM s"
        else:
            binned = (
                f"SELECT len(list_filter(q, lambda z: z < {x})) AS bin, {label} AS y FROM s, "
                f"(SELECT list_distinct(quantile_cont({x}, [{probs}])) AS q FROM s)"
            )
        parts.append(
            f"SELECT '{c}' AS \"column\", round(sum(n / t * ln(n * t / (nb * nl))), 6) AS score FROM ("
            f"SELECT CAST(n AS DOUBLE) AS n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY bin) AS nb, "
            f"sum(n) OVER (PARTITION BY y) AS nl FROM (SELECT bin, y, CAST(count(*) AS DOUBLE) AS n FROM ({binned}) GROUP BY 1, 2))"
        )
    return f"WITH s AS ({source})\n" + _union(parts)


def _neighbours_sql(source: str, label: str, columns: list[str], k: int = 3) -> str:
    """k-th distances from the k + 1 windows of neighbours that hold a row, counts by a frame of its own width per row (whole numbers)."""
    long = " UNION ALL ".join(f"SELECT '{c}' AS c, CAST({c} AS BIGINT) AS x, {label} AS y FROM s" for c in columns)

    def side(j: int) -> str:
        before = "0" if j == 0 else f"x - lag(x, {j}) OVER w"
        after = "0" if j == k else f"lead(x, {k - j}) OVER w - x"
        return f"CASE WHEN ({before}) IS NOT NULL AND ({after}) IS NOT NULL THEN greatest({before}, {after}) END"

    sides = ", ".join(side(j) for j in range(k + 1))
    return f"""
        WITH s AS ({source}), v AS ({long}),
        d AS (SELECT c, x, y, least({sides}) AS d, count(*) OVER (PARTITION BY c, y) AS n_y, count(*) OVER (PARTITION BY c) AS n
              FROM v WINDOW w AS (PARTITION BY c, y ORDER BY x)),
        r AS (SELECT *, greatest(d - 1, 0) AS r FROM d),
        m AS (SELECT c, n, n_y, count(*) OVER (PARTITION BY c ORDER BY x RANGE BETWEEN r PRECEDING AND r FOLLOWING) AS m FROM r),
        psi AS (SELECT i, coalesce(sum(1.0::DOUBLE / nullif(i - 1, 0)) OVER (ORDER BY i), 0) - 0.5772156649015329 AS p
                FROM range(1, (SELECT max(n) + 1 FROM m)) AS t(i))
        SELECT c AS "column", round(greatest(0, any_value(a.p) + any_value(b.p) - avg(e.p) - avg(f.p)), 6) AS score
        FROM m JOIN psi AS a ON a.i = n JOIN psi AS b ON b.i = {k} JOIN psi AS e ON e.i = n_y JOIN psi AS f ON f.i = m.m GROUP BY c"""


_ORDERS_CUSTOMER = "SELECT * FROM orders JOIN customer ON o_custkey = c_custkey"

# the preparation of SPEC, statement by statement
_BEFORE = (
    "SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "nullif(l_tax, 0) AS l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem"
)


def _filled(c: str, x: str) -> str:
    return f"coalesce(CAST({x} AS DOUBLE), (SELECT median({x}) FROM lineitem)) AS {c}"


_AFTER = "SELECT " + ", ".join(
    [
        _filled("l_partkey", "l_partkey"),
        _filled("l_linenumber", "l_linenumber"),
        _filled("l_quantity", "l_quantity"),
        _filled("l_extendedprice", "l_extendedprice"),
        _filled("l_discount", "nullif(l_discount, 0)"),
        _filled("l_tax", "nullif(l_tax, 0)"),
        "CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS DOUBLE) AS l_returnflag",
        "CAST(dense_rank() OVER (ORDER BY l_linestatus) - 1 AS DOUBLE) AS l_linestatus",
    ]
) + " FROM lineitem"
_BEFORE_TYPES = {c: t for c, t in LINEITEM_TYPES.items() if c != "l_orderkey"}
_AFTER_TYPES = {c: "double" for c in _BEFORE_TYPES if c not in ("l_suppkey", "l_shipdate")}


def _share_missing(source: str, columns) -> str:
    return _union(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) / CAST(count(*) AS DOUBLE) AS pct FROM {source}"
        for c in columns
    )


def _diff_missing_sql() -> str:
    return f"""
        WITH b0 AS ({_BEFORE}), a0 AS ({_AFTER}),
        b AS ({_share_missing('b0', _BEFORE_TYPES)}), a AS ({_share_missing('a0', _AFTER_TYPES)})
        SELECT coalesce(b."column", a."column") AS "column", round(b.pct, 6) AS pct_missing_before,
               round(a.pct, 6) AS pct_missing_after, round(a.pct - b.pct, 6) AS pct_change
        FROM b FULL OUTER JOIN a ON b."column" = a."column" """


def _encodings(source: str, types: dict[str, str]) -> str:
    def one(c: str, kind: str) -> str:
        n = f"count(DISTINCT {c})"
        encoding = "'numeric'"
        if kind in ("string", "timestamp_ntz"):
            encoding = (
                f"CASE WHEN {n} = 1 THEN 'drop' WHEN {n} = 2 THEN 'binary' WHEN {n} <= 50 THEN 'onehot' "
                "ELSE 'target_encode' END"
            )
        return f"SELECT '{c}' AS \"column\", {n} AS n, {encoding} AS e FROM {source}"

    return _union(one(c, t) for c, t in types.items())


def _diff_cardinality_sql() -> str:
    return f"""
        WITH b0 AS ({_BEFORE}), a0 AS ({_AFTER}),
        b AS ({_encodings('b0', _BEFORE_TYPES)}), a AS ({_encodings('a0', _AFTER_TYPES)})
        SELECT coalesce(b."column", a."column") AS "column", b.n AS n_unique_before,
               b.e AS suggested_encoding_before, a.n AS n_unique_after, a.e AS suggested_encoding_after,
               b.e IS DISTINCT FROM a.e AS encoding_changed
        FROM b FULL OUTER JOIN a ON b."column" = a."column" """


def _diff_distribution_sql() -> str:
    def stats(source: str, columns: list[str]) -> str:
        return _union(
            f"SELECT '{c}' AS \"column\", avg({c}) AS m, stddev_samp({c}) AS s, skewness({c}) AS k FROM {source}"
            for c in columns
        )

    return f"""
        WITH b0 AS ({_BEFORE}), a0 AS ({_AFTER}),
        b AS ({stats('b0', ['l_quantity', 'l_discount', 'l_tax'])}),
        a AS ({stats('a0', ['l_quantity', 'l_discount', 'l_tax', 'l_returnflag'])})
        SELECT coalesce(b."column", a."column") AS "column", round(b.m, 4) AS mean_before, round(b.s, 4) AS std_before,
               round(b.k, 4) AS skew_before, round(a.m, 4) AS mean_after, round(a.s, 4) AS std_after,
               round(a.k, 4) AS skew_after, round(a.k - b.k, 4) AS skew_change
        FROM b FULL OUTER JOIN a ON b."column" = a."column" """


def _flags(source: str, types: dict[str, str]) -> str:
    def one(c: str, kind: str) -> str:
        x = c
        if kind in ("bigint", "int"):
            found = f"CASE WHEN bool_and({x} IN (0, 1)) THEN 'bool' END"
        elif kind == "double":
            found = f"CASE WHEN bool_and({x} = round({x})) THEN 'int64 (no fractional part)' END"
        elif kind == "string":
            date = "NULL"
            if any(h in c for h in ("date", "time", "year", "month", "day")):
                date = f"CASE WHEN bool_and(try_cast({x} AS TIMESTAMP) IS NOT NULL) THEN 'datetime64' END"
            found = (
                f"CASE WHEN bool_and(try_cast({x} AS DOUBLE) IS NOT NULL) THEN 'float64 or int64' "
                f"WHEN bool_and(lower({x}) IN ('true', 'false', 'yes', 'no', '0', '1', 't', 'f')) THEN 'bool' "
                f"ELSE {date} END"
            )
        else:
            found = "CAST(NULL AS VARCHAR)"
        return f"SELECT '{c}' AS \"column\", '{kind}' AS t, {found} AS s FROM {source}"

    return _union(one(c, t) for c, t in types.items())


def _diff_dtypes_sql() -> str:
    return f"""
        WITH b0 AS ({_BEFORE}), a0 AS ({_AFTER}),
        b AS ({_flags('b0', _BEFORE_TYPES)}), a AS ({_flags('a0', _AFTER_TYPES)})
        SELECT coalesce(b."column", a."column") AS "column",
               CASE WHEN b."column" IS NOT NULL THEN b.s IS NOT NULL END AS flagged_before,
               b.s AS suspected_dtype_before,
               CASE WHEN a."column" IS NOT NULL THEN a.s IS NOT NULL END AS flagged_after,
               a.s AS suspected_dtype_after
        FROM b FULL OUTER JOIN a ON b."column" = a."column"
        WHERE b.s IS NOT NULL OR a.s IS NOT NULL"""


_AUDITED = """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer_text,
           strftime(o_orderdate, '%Y-%m-%d') AS order_date_text,
           CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'No' END AS finished,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished_bit,
           floor(o_totalprice) AS whole_price, o_totalprice, o_orderpriority FROM orders"""
_AUDITED_TYPES = {
    "o_orderkey": "bigint",
    "customer_text": "string",
    "order_date_text": "string",
    "finished": "string",
    "finished_bit": "int",
    "whole_price": "double",
    "o_totalprice": "double",
    "o_orderpriority": "string",
}


def _diff_redundancy_sql() -> str:
    def normal(pairs: str) -> str:
        return (
            f"SELECT least(col_a, col_b) AS col_a, greatest(col_a, col_b) AS col_b, correlation AS r "
            f"FROM ({pairs}) WHERE abs(correlation) >= 0.95"
        )

    before = _pearson_sql("SELECT * FROM src", _REDUNDANT_COLUMNS)
    after = _pearson_sql("SELECT *, words * 2 AS twice FROM src", [*_REDUNDANT_COLUMNS, "twice"])
    kept = _greedy_sql(before, _REDUNDANT_COLUMNS, 0.999)
    return f"""
        WITH src AS ({_REDUNDANT}), kept AS ({kept}), b AS ({normal(before)}),
        a AS (SELECT * FROM ({normal(after)})
              WHERE col_a IN (SELECT kept FROM kept UNION ALL SELECT 'twice')
                AND col_b IN (SELECT kept FROM kept UNION ALL SELECT 'twice'))
        SELECT coalesce(b.col_a, a.col_a) AS col_a, coalesce(b.col_b, a.col_b) AS col_b,
               coalesce(b.r, a.r) AS correlation,
               CASE WHEN a.col_a IS NULL THEN 'resolved' WHEN b.col_a IS NULL THEN 'new' ELSE 'unchanged' END AS status
        FROM b FULL OUTER JOIN a ON b.col_a = a.col_a AND b.col_b = a.col_b"""


ORACLES = {
    "profile_missing": _missing_sql(),
    "profile_cardinality": _cardinality_sql(
        "part",
        {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int"},
        top=True,
    ),
    "profile_cardinality_numeric": _cardinality_sql(
        "lineitem", {"l_quantity": "double", "l_extendedprice": "double", "l_tax": "double"}, top=False
    ),
    "profile_distribution": _distribution_sql("lineitem", DISTRIBUTED),
    "profile_dtypes": (
        f"WITH s AS ({_AUDITED}), f AS ({_flags('s', _AUDITED_TYPES)}) "
        'SELECT "column", t AS current_dtype, s AS suspected_dtype, s IS NOT NULL AS flagged FROM f'
    ),
    "profile_redundancy": (
        f"SELECT * FROM ({_pearson_sql(_REDUNDANT, _REDUNDANT_COLUMNS)}) WHERE abs(correlation) >= 0.95"
    ),
    "label_distribution": """
        SELECT quality AS label, count(*) AS count,
               round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS pct
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""",
    "diff_missing": _diff_missing_sql(),
    "diff_cardinality": _diff_cardinality_sql(),
    "diff_distribution": _diff_distribution_sql(),
    "diff_dtypes": _diff_dtypes_sql(),
    "diff_redundancy": _diff_redundancy_sql(),
    "diff_whole": _diff_missing_sql(),
    "corr_pearson": _pearson_sql(_REDUNDANT, _REDUNDANT_COLUMNS),
    "corr_spearman": _spearman_sql(_REDUNDANT, _REDUNDANT_COLUMNS),
    "corr_pearson_gaps": _pearson_sql(_HOLED.replace("l_linenumber", "l_quantity"), GAPPED),
    "corr_spearman_gaps": _spearman_sql(_HOLED.replace("l_linenumber", "l_quantity"), GAPPED),
    "corr_select_pearson": _greedy_sql(_pearson_sql(_REDUNDANT, _REDUNDANT_COLUMNS), _REDUNDANT_COLUMNS, 0.95),
    "corr_select_spearman": _greedy_sql(_spearman_sql(_REDUNDANT, _REDUNDANT_COLUMNS), _REDUNDANT_COLUMNS, 0.95),
    "variance_report": _union(
        f"SELECT '{c}' AS \"column\", round(var_pop({c}), 4) AS variance FROM lineitem" for c in NUMBERS
    ),
    "variance_select": _union(
        f"SELECT '{c}' AS kept FROM lineitem HAVING var_pop({c}) > 0.01" for c in NUMBERS
    ),
    "mi_scores": _mi_sql(_ORDERS_CUSTOMER, "o_orderstatus", {c: False for c in INFORMATIVE}),
    "mi_neighbours": _neighbours_sql(
        "SELECT o_orderstatus, c_nationkey, round(o_totalprice * 100) AS o_totalprice, round(c_acctbal * 100) AS c_acctbal "
        "FROM orders JOIN customer ON o_custkey = c_custkey", "o_orderstatus", INFORMATIVE),
    "mi_select": f"""
        SELECT unnest(['o_orderkey', 'finished']) AS kept
        UNION ALL
        (SELECT "column" AS kept FROM ({_mi_sql(_AUDITED, 'finished', {'finished_bit': True, 'whole_price': False, 'o_totalprice': False})})
         ORDER BY score DESC, 1 LIMIT 1)""",
}
