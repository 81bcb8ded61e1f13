"""Data-quality reports: missing values, cardinality, distribution, types, redundancy.

All fixed-size statistics of a column come from one shared pass over it; distinct values
and exact quantiles, which cannot be bounded in one buffer, have passes of their own. Reports are tables with one row per profiled column (or column pair, or class).
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import as_double, col, in_parallel, numeric_columns
from millrace.functions.correlation import correlations
from millrace.functions.moments import sample_kurtosis, sample_skewness
from millrace.functions.quantiles import exact_quantiles
from millrace.functions.values import long_form
from millrace.operators.derive import parsed_date
from millrace.sources.scratch import write_table

AGGREGATES_PER_JOB = 32
JOBS_AT_ONCE = 4
#: Bytes of a text above which its values are counted by hash; a quarter as many characters are its head.
HEAD = 64

# What the type audit looks for and how it names its findings.
BOOLEAN_WORDS = ["true", "false", "yes", "no", "0", "1", "t", "f"]
DATE_HINTS = ["date", "time", "year", "month", "day"]
NUMBER_TEXT = "float64 or int64"
BOOLEAN = "bool"
DATE = "datetime64"
WHOLE = "int64 (no fractional part)"
MAX_CATEGORIES = 50
REDUNDANCY = 0.95

NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"

MISSING_SCHEMA = "column string, n_missing long, pct_missing double, pct_zero double, dtype string"
CARDINALITY_SCHEMA = (
    "column string, dtype string, n_unique long, top_value string, top_freq long, top_pct double, "
    "suggested_encoding string"
)
DISTRIBUTION_SCHEMA = (
    "column string, count long, mean double, std double, min double, p25 double, median double, "
    "p75 double, max double, skew double, kurtosis double"
)
DTYPE_SCHEMA = "column string, current_dtype string, suspected_dtype string, flagged boolean"
REDUNDANCY_SCHEMA = "col_a string, col_b string, correlation double"


def _kind(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def _is_missing(df: DataFrame, column: str) -> Column:
    if isinstance(_kind(df, column), (T.FloatType, T.DoubleType)):
        return as_double(column).isNull()
    return col(column).isNull()


def _statistics(df: DataFrame, columns: dict[str, list[dict[str, Column]]]) -> dict[str, dict[str, Any]]:
    """Evaluate named aggregates of many columns.

    A column's statistics share one pass. Columns are spread over jobs of bounded code size
    (beyond it the JVM stops compiling the generated code); each reads only its columns.
    """
    jobs, part = [], []

    def run(wanted: list[tuple[str, str, Column]]) -> list[tuple[str, str, Any]]:
        row = df.agg(*[x.alias(f"s{i}") for i, (_, _, x) in enumerate(wanted)]).first()
        return [(c, name, row[f"s{i}"]) for i, (c, name, _) in enumerate(wanted)]

    for c, groups in columns.items():
        wanted = [(c, name, x) for group in groups for name, x in group.items()]
        if part and len(part) + len(wanted) > AGGREGATES_PER_JOB:
            jobs.append(lambda part=part: run(part))
            part = []
        part = part + wanted
    if part:
        jobs.append(lambda part=part: run(part))
    out: dict[str, dict[str, Any]] = {}
    for found in in_parallel(df.sparkSession, jobs, JOBS_AT_ONCE):
        for c, name, value in found:
            out.setdefault(c, {})[name] = value
    return out


def _missing_aggregates(df: DataFrame, c: str) -> dict[str, Column]:
    found = {"rows": F.count(F.lit(1)), "n_missing": F.count_if(_is_missing(df, c))}
    if isinstance(_kind(df, c), T.NumericType):
        found["n_zero"] = F.count_if(col(c) == 0)
    return found


def _moment_aggregates(df: DataFrame, c: str) -> dict[str, Column]:
    if not isinstance(_kind(df, c), T.NumericType):
        return {}
    x = as_double(c)
    return {
        "count": F.count(x),
        "mean": F.avg(x),
        "std": F.stddev_samp(x),
        "min": F.min(x),
        "max": F.max(x),
        "g1": F.skewness(x),
        "g2": F.kurtosis(x),
    }


def _type_aggregates(df: DataFrame, c: str) -> dict[str, Column]:
    kind, x = _kind(df, c), col(c)
    if isinstance(kind, T.StringType):
        found = {
            "all_numeric": F.bool_and(x.rlike(NUMBER_PATTERN)),
            "all_boolean": F.bool_and(F.lower(x).isin(BOOLEAN_WORDS)),
        }
        if any(hint in c.lower() for hint in DATE_HINTS):
            found["all_dates"] = F.bool_and(F.when(x.isNotNull(), parsed_date(x).isNotNull()))
        return found
    if isinstance(kind, T.IntegralType):
        return {"all_bits": F.bool_and(x.isin(0, 1))}
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return {"all_whole": F.bool_and(as_double(c) == F.rint(as_double(c)))}
    return {}


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _descending(value: float | None) -> tuple:
    return (value is None, 0.0 if value is None else -abs(value))


def _missing_rows(df: DataFrame, stats: dict) -> list[tuple]:
    rows = []
    for c in df.columns:
        s = stats[c]
        n = s["rows"]
        zero = s["n_zero"] / n if n and "n_zero" in s else None
        share = s["n_missing"] / n if n else None
        rows.append((c, s["n_missing"], share, zero, _kind(df, c).simpleString()))
    return sorted(rows, key=lambda r: (_descending(r[2]), r[0]))


def _dtype_rows(df: DataFrame, stats: dict) -> list[tuple]:
    rows = []
    for c in df.columns:
        s = stats.get(c, {})
        if s.get("all_numeric"):
            suspected = NUMBER_TEXT
        elif s.get("all_boolean") or s.get("all_bits"):
            suspected = BOOLEAN
        elif s.get("all_dates"):
            suspected = DATE
        elif s.get("all_whole"):
            suspected = WHOLE
        else:
            suspected = None
        rows.append((c, _kind(df, c).simpleString(), suspected, suspected is not None))
    return rows


def _quartiles(df: DataFrame) -> dict[str, list[float | None]]:
    return exact_quantiles(df, numeric_columns(df), [0.25, 0.5, 0.75])


def _distribution_rows(stats: dict, quartiles: dict) -> list[tuple]:
    rows = []
    for c in quartiles:
        s = stats[c]
        skew = sample_skewness(s["count"], s["std"], s["g1"])
        kurtosis = sample_kurtosis(s["count"], s["std"], s["g2"])
        rows.append((c, s["count"], s["mean"], s["std"], s["min"], *quartiles[c], s["max"], skew, kurtosis))
    return sorted(rows, key=lambda r: (_descending(r[9]), r[0]))


def missing_summary(df: DataFrame) -> DataFrame:
    """Missing and zero shares per column, most missing first."""
    stats = _statistics(df, {c: [_missing_aggregates(df, c)] for c in df.columns})
    return _table(df.sparkSession, _missing_rows(df, stats), MISSING_SCHEMA)


def dtype_audit(df: DataFrame) -> DataFrame:
    """Columns whose values fit a narrower type than the one they are stored in."""
    found = {c: [_type_aggregates(df, c)] for c in df.columns}
    stats = _statistics(df, {c: g for c, g in found.items() if g[0]})
    return _table(df.sparkSession, _dtype_rows(df, stats), DTYPE_SCHEMA)


def distribution_summary(df: DataFrame) -> DataFrame:
    """Moments and exact quartiles of the numeric columns, most skewed first."""
    stats = _statistics(df, {c: [_moment_aggregates(df, c)] for c in numeric_columns(df)})
    return _table(df.sparkSession, _distribution_rows(stats, _quartiles(df)), DISTRIBUTION_SCHEMA)


def cardinality_report(df: DataFrame, max_cats: int = MAX_CATEGORIES, *, approx: bool = False) -> DataFrame:
    """Distinct values, most frequent value (smallest on ties) and a suggested encoding.

    Numbers are grouped as doubles or as exact integers, all else as text, so equal values
    meet whatever their spelling. ``approx`` estimates ``n_unique`` and leaves out the top.
    """
    spark = df.sparkSession
    if not df.columns:
        return _table(spark, [], CARDINALITY_SCHEMA)
    kinds = {c: _kind(df, c) for c in df.columns}
    if approx:
        stats = _statistics(
            df,
            {
                c: [{"n_unique": F.approx_count_distinct(F.when(~_is_missing(df, c), col(c)), 0.02)}]
                for c in df.columns
            },
        )
        found = {c: (stats[c]["n_unique"], None, None, None) for c in df.columns}
    else:
        found = _value_statistics(df, kinds)
    rows = []
    for c in df.columns:
        n_unique, top_value, top_freq, total = found[c]
        if isinstance(kinds[c], T.NumericType):
            encoding = "numeric"
        elif n_unique == 1:
            encoding = "drop"
        elif n_unique == 2:
            encoding = "binary"
        elif n_unique <= max_cats:
            encoding = "onehot"
        else:
            encoding = "target_encode"
        share = None if top_freq is None else top_freq / total if total else 0.0
        rows.append((c, kinds[c].simpleString(), n_unique, top_value, top_freq, share, encoding))
    return _table(spark, rows, CARDINALITY_SCHEMA)


def _value_statistics(df: DataFrame, kinds: dict[str, T.DataType]) -> dict[str, tuple]:
    groups: dict[str, dict[str, Column]] = {"bigint": {}, "double": {}, "date": {}, "timestamp": {}, "timestamp_ntz": {}, "string": {}}
    for c, kind in kinds.items():
        if isinstance(kind, T.IntegralType):
            groups["bigint"][c] = col(c).cast("bigint")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            # -0.0 and 0.0 are one value
            groups["double"][c] = as_double(c) + F.lit(0.0)
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            groups["string"][c] = F.to_json(col(c))
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            groups[kind.typeName()][c] = col(c)
        else:
            groups["string"][c] = col(c).cast("string")
    parts = []
    for kind, columns in groups.items():
        if not columns:
            continue
        if kind == "string":
            counts = _text_counts(df, columns)
            present, head = F.col("head").isNotNull(), F.substring("head", 1, HEAD // 4)
            # a long text has no value here and comes before short ones with the same head
            top = F.min(F.when(present, F.struct((-F.col("n")).alias("n"), head.alias("head"), F.when(F.col("h0").isNull(), F.col("head")).alias("value"))))
        else:
            counts = long_form(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
            if kind not in ("bigint", "double"):
                # spelled once per value, not per row; two instants of a changed clock have one spelling
                counts = counts.groupBy("column", F.col("value").cast("string").alias("value")).agg(F.sum("n").alias("n"))
            present = F.col("value").isNotNull()
            top = F.min(F.when(present, F.struct((-F.col("n")).alias("n"), F.lit(None).cast("string").alias("head"), "value")))
        parts.append(
            counts.groupBy("column")
            .agg(F.count_if(present).alias("n_unique"), top.alias("top"), F.sum("n").alias("total"))
            .select(
                "column",
                "n_unique",
                F.col("top.value").cast("string").alias("top_value"),
                (-F.col("top.n")).alias("top_freq"),
                "total",
                "top.head",
            )
        )
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    rows = every.collect()
    long = {r["column"]: (r["top_freq"], r["head"]) for r in rows if r["top_freq"] and r["top_value"] is None}
    texts = _long_tops(df, {c: groups["string"][c] for c in long}, long) if long else {}
    found = {r["column"]: (r["n_unique"], texts.get(r["column"], r["top_value"]), r["top_freq"] or 0, r["total"]) for r in rows}
    return {c: found.get(c, (0, None, 0, 0)) for c in kinds}


def _hashed_texts(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """column, value, and head, h0, h1: a short text is its head; a long one has the first characters and a 128-bit hash."""
    long = F.octet_length("value") > HEAD
    hashes = [F.when(long, F.xxhash64(F.lit(i), "value")).alias(f"h{i}") for i in (0, 1)]
    head = F.when(long, F.substring("value", 1, HEAD // 4)).otherwise(F.col("value"))
    return long_form(df, columns).select("column", "value", head.alias("head"), *hashes)


def _text_counts(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Rows per text; what is shuffled of a long one does not grow with it."""
    return _hashed_texts(df, columns).groupBy("column", "head", "h0", "h1").agg(F.count(F.lit(1)).alias("n"))


def _long_tops(df: DataFrame, columns: dict[str, Column], tops: dict[str, tuple[int, str]]) -> dict[str, str]:
    """The smallest text of each column among those with the column's largest count and, of these, the smallest head.

    Only these are looked up, by hash, among the whole texts.
    """
    wanted = df.sparkSession.createDataFrame([(c, *t) for c, t in tops.items()], "of string, most long, least string")
    same = (F.col("column") == F.col("of")) & (F.col("n") == F.col("most")) & (F.substring("head", 1, HEAD // 4) == F.col("least"))
    winners, _ = write_table(_text_counts(df, columns).join(F.broadcast(wanted), same).select("column", "head", "h0", "h1"))
    texts = _hashed_texts(df, columns).join(winners.where("h0 IS NOT NULL").select("column", "h0", "h1"), ["column", "h0", "h1"], "left_semi")
    every = texts.select("column", "value").unionByName(winners.where("h0 IS NULL").select("column", F.col("head").alias("value")))
    return {r["column"]: r["least"] for r in every.groupBy("column").agg(F.min("value").alias("least")).collect()}


def label_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """Rows and share per class; null is a class. Largest first."""
    counts = df.groupBy(col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    written, total = write_table(counts, n=F.sum("count"))
    return written.withColumn("pct", F.col("count") / F.lit(total["n"])).orderBy(F.desc("count"), "label")


def redundancy_report(df: DataFrame, threshold: float = REDUNDANCY) -> DataFrame:
    """Numeric pairs whose absolute Pearson correlation reaches the threshold."""
    found = correlations(df, numeric_columns(df), "pearson")
    rows = [(a, b, r) for (a, b), r in found.items() if r is not None and abs(r) >= threshold]
    rows.sort(key=lambda r: -abs(r[2]))
    return _table(df.sparkSession, rows, REDUNDANCY_SCHEMA)


def profile(
    df: DataFrame,
    label_col: str | None = None,
    *,
    id_col: str | None = None,
    max_cats: int = MAX_CATEGORIES,
    redundancy_threshold: float = REDUNDANCY,
) -> dict[str, DataFrame]:
    """All reports; the fixed-size statistics of all of them share one pass."""
    features = df.drop(*[c for c in (id_col, label_col) if c])
    spark = df.sparkSession

    def fixed_size() -> dict[str, dict[str, Any]]:
        return _statistics(
            features,
            {
                c: [_missing_aggregates(features, c), _moment_aggregates(features, c), _type_aggregates(features, c)]
                for c in features.columns
            },
        )

    # independent passes over different columns: they overlap
    stats, quartiles, cardinality, redundancy = in_parallel(
        spark,
        [
            fixed_size,
            lambda: _quartiles(features),
            lambda: cardinality_report(features, max_cats),
            lambda: redundancy_report(features, redundancy_threshold),
        ],
        JOBS_AT_ONCE,
    )
    reports = {
        "missing": _table(spark, _missing_rows(features, stats), MISSING_SCHEMA),
        "cardinality": cardinality,
        "distribution": _table(spark, _distribution_rows(stats, quartiles), DISTRIBUTION_SCHEMA),
        "dtype_audit": _table(spark, _dtype_rows(features, stats), DTYPE_SCHEMA),
        "redundancy": redundancy,
    }
    if label_col is not None and label_col in df.columns:
        reports["label_distribution"] = label_distribution(df, label_col)
    return reports


def top_missing(missing: DataFrame, n: int = 10) -> DataFrame:
    """The columns with most missing values, with their zero share."""
    return missing.filter("pct_missing > 0").orderBy(F.desc("pct_missing"), "column").limit(n)


def high_cardinality(cardinality: DataFrame) -> DataFrame:
    """Columns for which target encoding is suggested."""
    return cardinality.filter("suggested_encoding = 'target_encode'").select("column", "n_unique")
