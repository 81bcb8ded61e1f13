"""Reading, aligning, cleaning, encoding and deriving on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.operators.clean import CategoricalImputer, ColumnDropper, NumericImputer, ZeroToNull
from millrace.operators.derive import GeoCluster, GeoClusterModel, YearGap, map_points
from millrace.operators.encode import FrequencyEncoder, OrdinalEncoder, TargetEncoder
from millrace.sources.tables import align, alignment_report, read_features, read_labels, read_table


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(col(c), digits) for c in columns})


def orders_with_customer(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


# --- sources ---------------------------------------------------------------------------


def align_labels(spark, sf):
    features = read_features(spark, f"{sf}/documents.parquet", id_col="doc_id").drop("text")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return align(features, labels, "doc_id")


def align_report(spark, sf):
    return alignment_report(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


def read_label_table(spark, sf):
    """A label table written as CSV, read back and typed by its cells."""
    from millrace.sources.scratch import scratch_root
    from millrace.sources.sinks import write

    path = f"{scratch_root(spark)}/order_labels_{spark.sparkContext.applicationId}.csv"
    write(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path, "csv")
    return read_labels(spark, path, id_col="o_orderkey", label_col="status_group")


# --- cleaning --------------------------------------------------------------------------


def _lineitem_numbers(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")


SENTINELS = ["l_discount", "l_tax"]


def sentinel_null(spark, sf):
    return ZeroToNull(columns=SENTINELS).transform(_lineitem_numbers(spark, sf))


def _imputed(spark, sf, **params):
    holed = sentinel_null(spark, sf)
    filled = NumericImputer(columns=SENTINELS, **params).fit(holed).transform(holed)
    return rounded(filled, 6, *SENTINELS)


def impute_median(spark, sf):
    return _imputed(spark, sf, strategy="median")


def impute_mean(spark, sf):
    return _imputed(spark, sf, strategy="mean")


def impute_constant(spark, sf):
    return _imputed(spark, sf, strategy="constant", fill_value=-1.0)


def _orders_with_gaps(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.nullif("o_orderstatus", F.lit("O")).alias("o_orderstatus"),
    )


def impute_mode(spark, sf):
    df = _orders_with_gaps(spark, sf)
    return CategoricalImputer(idCol="o_orderkey").fit(df).transform(df)


def impute_text_constant(spark, sf):
    df = _orders_with_gaps(spark, sf)
    return CategoricalImputer(strategy="constant", fill_value="unknown").fit(df).transform(df)


def drop_columns(spark, sf):
    return ColumnDropper(columns_to_drop=["p_type", "p_retailprice", "not_there"]).transform(table(spark, sf, "part"))


# --- encoding --------------------------------------------------------------------------


def ordinal_encode(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return OrdinalEncoder(idCol="p_partkey").fit(part).transform(part)


def _orders_by_customer(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", "o_orderdate", "o_orderstatus", col("o_custkey").cast("string").alias("customer"))


EARLY = "1993-01-01"


def ordinal_encode_unseen(spark, sf):
    """Codes learned on early orders, applied to all: later customers are unseen."""
    orders = _orders_by_customer(spark, sf)
    early = orders.filter(F.col("o_orderdate") < F.lit(EARLY).cast("timestamp_ntz"))
    model = OrdinalEncoder(columns=["customer"], idCol="o_orderkey").fit(early)
    return model.transform(orders).select("o_orderkey", "customer")


def target_encode(spark, sf):
    df = orders_with_customer(spark, sf).select("o_orderkey", "o_orderstatus", "c_mktsegment", "o_orderpriority")
    model = TargetEncoder(idCol="o_orderkey", labelCol="o_orderstatus", smoothing=1.0).fit(df)
    return rounded(model.transform(df).drop("o_orderstatus"), 6, "c_mktsegment", "o_orderpriority")


def target_encode_unseen(spark, sf):
    orders = _orders_by_customer(spark, sf)
    early = orders.filter(F.col("o_orderdate") < F.lit(EARLY).cast("timestamp_ntz"))
    encoder = TargetEncoder(columns=["customer"], smoothing=5.0, idCol="o_orderkey", labelCol="o_orderstatus")
    return rounded(encoder.fit(early).transform(orders).select("o_orderkey", "customer"), 6, "customer")


def target_encode_numeric(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    model = TargetEncoder(idCol="p_partkey", labelCol="p_size", smoothing=2.0).fit(part)
    return rounded(model.transform(part), 6, "p_brand")


def frequency_encode(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return rounded(FrequencyEncoder(idCol="p_partkey").fit(part).transform(part), 6, "p_name_freq", "p_brand_freq")


def frequency_encode_gaps(spark, sf):
    df = _orders_with_gaps(spark, sf)
    model = FrequencyEncoder(columns=["o_orderpriority"], output_suffix="_share").fit(df)
    return rounded(model.transform(df).drop("o_orderstatus"), 6, "o_orderpriority_share")


# --- derivation ------------------------------------------------------------------------


def year_gap(spark, sf):
    lineitem, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    joined = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.year("o_orderdate").alias("order_year")
    )
    gap = YearGap(reference_column="l_shipdate", construction_column="order_year", output_column="gap")
    return gap.transform(joined).select("l_orderkey", "l_linenumber", "gap")


def _points(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return vectors.select(
        "vec_id",
        F.col("label").cast("string").alias("prediction"),
        F.col("embedding")[0].cast("double").alias("latitude"),
        F.col("embedding")[1].cast("double").alias("longitude"),
    )


CENTRES = [[0.1, 0.1], [-0.1, 0.05], [0.0, -0.1], [0.15, -0.05]]


def cluster_assign(spark, sf):
    state = {"centres": CENTRES, "lat": "latitude", "lon": "longitude", "output": "geo_cluster"}
    return GeoClusterModel(state=state).transform(_points(spark, sf)).select("vec_id", "geo_cluster")


def cluster_fit(spark, sf):
    points = _points(spark, sf)
    return GeoCluster(n_clusters=5).fit(points).transform(points).select("vec_id", "geo_cluster")


def map_point_table(spark, sf):
    points = map_points(_points(spark, sf), id_col="vec_id", max_points=300)
    return rounded(points, 6, "lat", "lon")


QUERIES = {
    f.__name__: f
    for f in (
        align_labels,
        align_report,
        read_label_table,
        sentinel_null,
        impute_median,
        impute_mean,
        impute_constant,
        impute_mode,
        impute_text_constant,
        drop_columns,
        ordinal_encode,
        ordinal_encode_unseen,
        target_encode,
        target_encode_unseen,
        target_encode_numeric,
        frequency_encode,
        frequency_encode_gaps,
        year_gap,
        cluster_assign,
        cluster_fit,
        map_point_table,
    )
}

_HOLED = (
    "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem"
)
_GAPPED = (
    "SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, "
    "nullif(o_orderstatus, 'O') AS o_orderstatus FROM orders"
)


def _impute_sql(fill: str) -> str:
    return f"""
        WITH h AS ({_HOLED}), f AS (SELECT {fill.format(c='l_discount')} AS d, {fill.format(c='l_tax')} AS t FROM h)
        SELECT l_orderkey, l_linenumber, round(coalesce(l_discount, f.d), 6) AS l_discount,
               round(coalesce(l_tax, f.t), 6) AS l_tax
        FROM h, f"""


_CENTRES_SQL = ", ".join(f"({float(i)}, {x}, {y})" for i, (x, y) in enumerate(CENTRES))

ORACLES = {
    "align_labels": """
        SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "align_report": """
        WITH f AS (SELECT doc_id AS id, count(*) AS n FROM documents GROUP BY 1),
             l AS (SELECT doc_id AS id, count(*) AS n FROM labels GROUP BY 1)
        SELECT count(*) FILTER (f.n > 1) AS features_repeated, count(*) FILTER (l.n > 1) AS labels_repeated,
               count(*) FILTER (l.id IS NULL) AS features_only, count(*) FILTER (f.id IS NULL) AS labels_only,
               count(*) FILTER (f.id IS NOT NULL AND l.id IS NOT NULL) AS common
        FROM f FULL OUTER JOIN l ON f.id = l.id""",
    "read_label_table": "SELECT o_orderkey, o_orderstatus AS status_group FROM orders",
    "sentinel_null": _HOLED,
    "impute_median": _impute_sql("median({c})"),
    "impute_mean": _impute_sql("avg({c})"),
    "impute_constant": _impute_sql("max(CAST(-1 AS DOUBLE))"),
    "impute_mode": f"""
        WITH g AS ({_GAPPED}),
        p AS (SELECT o_orderpriority AS v FROM g WHERE o_orderpriority IS NOT NULL
              GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
        s AS (SELECT o_orderstatus AS v FROM g WHERE o_orderstatus IS NOT NULL
              GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT o_orderkey, coalesce(o_orderpriority, p.v) AS o_orderpriority,
               coalesce(o_orderstatus, s.v) AS o_orderstatus
        FROM g, p, s""",
    "impute_text_constant": f"""
        SELECT o_orderkey, coalesce(o_orderpriority, 'unknown') AS o_orderpriority,
               coalesce(o_orderstatus, 'unknown') AS o_orderstatus FROM ({_GAPPED})""",
    "drop_columns": "SELECT p_partkey, p_name, p_brand, p_size FROM part",
    "ordinal_encode": """
        SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS DOUBLE) AS p_name,
               CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS DOUBLE) AS p_brand,
               CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS DOUBLE) AS p_type
        FROM part""",
    "ordinal_encode_unseen": f"""
        WITH codes AS (
            SELECT c, CAST(row_number() OVER (ORDER BY c) - 1 AS DOUBLE) AS code
            FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS c FROM orders WHERE o_orderdate < TIMESTAMP '{EARLY}'))
        SELECT o_orderkey, coalesce(code, -1.0) AS customer
        FROM orders LEFT JOIN codes ON CAST(o_custkey AS VARCHAR) = c""",
    "target_encode": """
        WITH cls AS (SELECT s, CAST(row_number() OVER (ORDER BY s) - 1 AS DOUBLE) AS y
                     FROM (SELECT DISTINCT o_orderstatus AS s FROM orders)),
        j AS (SELECT o_orderkey, c_mktsegment, o_orderpriority, y
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN cls ON s = o_orderstatus),
        g AS (SELECT avg(y) AS g FROM j),
        m AS (SELECT c_mktsegment AS v, (sum(y) + max(g)) / (count(*) + 1) AS e FROM j, g GROUP BY 1),
        p AS (SELECT o_orderpriority AS v, (sum(y) + max(g)) / (count(*) + 1) AS e FROM j, g GROUP BY 1)
        SELECT o_orderkey, round(m.e, 6) AS c_mktsegment, round(p.e, 6) AS o_orderpriority
        FROM j JOIN m ON c_mktsegment = m.v JOIN p ON o_orderpriority = p.v""",
    "target_encode_unseen": f"""
        WITH early AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{EARLY}'),
        cls AS (SELECT s, CAST(row_number() OVER (ORDER BY s) - 1 AS DOUBLE) AS y
                FROM (SELECT DISTINCT o_orderstatus AS s FROM early)),
        j AS (SELECT o_custkey, y FROM early JOIN cls ON s = o_orderstatus),
        g AS (SELECT avg(y) AS g FROM j),
        m AS (SELECT o_custkey, (sum(y) + 5 * max(g)) / (count(*) + 5) AS e FROM j, g GROUP BY 1)
        SELECT o_orderkey, round(coalesce(m.e, g.g), 6) AS customer
        FROM orders CROSS JOIN g LEFT JOIN m USING (o_custkey)""",
    "target_encode_numeric": """
        WITH g AS (SELECT avg(p_size) AS g FROM part),
        m AS (SELECT p_brand, (sum(p_size) + 2 * max(g)) / (count(*) + 2) AS e FROM part, g GROUP BY 1)
        SELECT p_partkey, round(m.e, 6) AS p_brand, p_size FROM part JOIN m USING (p_brand)""",
    "frequency_encode": """
        SELECT p_partkey, p_name, p_brand,
               round(count(*) OVER (PARTITION BY p_name) / CAST(count(*) OVER () AS DOUBLE), 6) AS p_name_freq,
               round(count(*) OVER (PARTITION BY p_brand) / CAST(count(*) OVER () AS DOUBLE), 6) AS p_brand_freq
        FROM part""",
    "frequency_encode_gaps": f"""
        SELECT o_orderkey, o_orderpriority,
               round(CASE WHEN o_orderpriority IS NULL THEN 0.0
                     ELSE count(*) OVER (PARTITION BY o_orderpriority) / CAST(count(*) OVER () AS DOUBLE) END, 6)
               AS o_orderpriority_share
        FROM ({_GAPPED})""",
    "year_gap": """
        SELECT l_orderkey, l_linenumber,
               CAST(CASE WHEN year(l_shipdate) >= year(o_orderdate) THEN year(l_shipdate) - year(o_orderdate) END
                    AS DOUBLE) AS gap
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "cluster_assign": f"""
        WITH c(i, x, y) AS (VALUES {_CENTRES_SQL}),
        p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b FROM embeddings),
        d AS (SELECT vec_id, i, row_number() OVER (PARTITION BY vec_id
                     ORDER BY (a - x) * (a - x) + (b - y) * (b - y), i) AS r FROM p, c)
        SELECT vec_id, CAST(i AS DOUBLE) AS geo_cluster FROM d WHERE r = 1""",
    "map_point_table": """
        WITH p AS (SELECT vec_id, CAST(label AS VARCHAR) AS prediction, CAST(embedding[1] AS DOUBLE) AS lat,
                          CAST(embedding[2] AS DOUBLE) AS lon FROM embeddings)
        SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, prediction, '#999999' AS colour
        FROM p WHERE lat <> 0 AND lon <> 0 ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42') LIMIT 300""",
}
