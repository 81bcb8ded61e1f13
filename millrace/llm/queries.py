"""The operators applied to the given tables with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    decontaminate,
    divergence,
    fingerprint,
    hmm,
    lines,
    minhash,
    near,
    packing,
    passages,
    periods,
    quality,
    repeats,
    secrets,
)
from millrace.llm.common import remainder, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), TOKENIZER, numbered=True).drop("ids_crc32"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op4_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return hmm.score_texts(docs, remainder(docs["doc_id"], 10) != 0)[0]


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, remainder(labels["doc_id"], 4) != 2)
    return quality.score(docs, model).select(
        "doc_id",
        (remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.report(found)


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(lines.remove_spread_lines(table(spark, sf_dir, "documents")))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.report(secrets.find_secrets(docs, secrets.train(docs)))


def op9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_groups(table(spark, sf_dir, "documents")).drop("text_hash")


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.report(passages.remove_passages(table(spark, sf_dir, "documents")))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.report(periods.find_runs(periods.periodic_tails(table(spark, sf_dir, "documents"))))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_packing": op2_packing,
    "op3_repeats": op3_repeats,
    "op4_hmm": op4_hmm,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_lines": op7_lines,
    "op8_secrets": op8_secrets,
    "op9_near": op9_near,
    "op10_passages": op10_passages,
    "op11_divergence": op11_divergence,
    "op12_minhash": op12_minhash,
    "op13_periods": op13_periods,
}

ORACLES = {
    "op7_lines": """
        WITH d AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines, row_number() OVER () AS r
                   FROM documents),
        l AS (SELECT r, doc_id, source, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
        t AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS key FROM l),
        s AS (SELECT key, min((coalesce(doc_id, -9223372036854775808), i)) AS own
              FROM t WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= 10),
        k AS (SELECT t.*, s.key IS NOT NULL AND s.own <> (coalesce(doc_id, -9223372036854775808), t.i) AS gone
              FROM t LEFT JOIN s USING (key))
        SELECT doc_id, count(*) FILTER (WHERE key <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM k GROUP BY r, doc_id""",
    "op6_decontamination": r"""
        WITH i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
        d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        j AS (SELECT item_id, w, least(10, len(w)) AS m FROM i WHERE len(w) > 0),
        iw AS (SELECT DISTINCT item_id, m, list_slice(w, a, a + m - 1) AS s FROM j, unnest(range(1, len(w) - m + 2)) AS t(a)),
        dw AS (SELECT doc_id, m, a, list_slice(w, a, a + m - 1) AS s
               FROM d, (SELECT DISTINCT m FROM j) AS l, unnest(range(1, len(w) - m + 2)) AS t(a)),
        met AS (SELECT dw.doc_id, dw.m, dw.a, item_id FROM dw JOIN iw USING (s)),
        hit AS (SELECT doc_id, count(DISTINCT a + k) AS n_hit FROM met, unnest(range(m)) AS u(k) GROUP BY doc_id),
        found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op9_near": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 2) AS g FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s AS a JOIN s AS b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM p JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
        r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
        SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id
        FROM d JOIN r ON r.x = d.doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op10_passages": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS s FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
        first AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
        gone AS (SELECT DISTINCT win.doc_id, i + k AS p FROM win JOIN first USING (s), unnest(range(13)) AS u(k)
                 WHERE m < win.doc_id),
        word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
        n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op11_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        k AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
        v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
        n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
        p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
                     1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 2) // (coalesce(n.n, 0) + 2 * v.v) AS p,
                     1 + 1000000000::HUGEINT * (k.c + 2) // (v.n + 2 * v.v) AS q
              FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN n USING (lang, source)),
        pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                 FROM p AS a JOIN p AS b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
        every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0) AS value
                  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
                  UNION ALL
                  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM every)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 10""",
    "op12_minhash": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 1) AS g FROM d, unnest(range(1, greatest(len(w), 2))) AS t(i) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s AS a JOIN s AS b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM p JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
        r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
        SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id,
               doc_id = min(r.y) AS kept
        FROM d JOIN r ON r.x = d.doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op13_periods": r"""
        WITH tab AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
                            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
        d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                     xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
                         lambda c, b: xor(c >> 8, tab.tab[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) AS h FROM documents, tab),
        e AS (SELECT r, doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h FROM d),
        f AS (SELECT r, doc_id, n, w, a, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM e),
        t AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w
              FROM f),
        x AS (SELECT r, unnest(w) AS x, unnest(range(n)) AS i FROM t),
        eq AS (SELECT a.r, a.i, b.i - a.i AS q FROM x AS a JOIN x AS b ON a.r = b.r AND a.x = b.x AND a.i < b.i),
        isl AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM eq),
        run AS (SELECT r, min(i) AS s, q, count(*) + q AS l FROM isl GROUP BY r, q, g HAVING count(*) + q >= greatest(12, 2 * q)),
        u AS (SELECT r, s, l, min(q) AS q FROM run GROUP BY r, s, l),
        gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM u),
        kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS k FROM x ANTI JOIN gone USING (r, i) GROUP BY r),
        best AS (SELECT r, count(*) AS n_runs, arg_min((s, l, q), (-l, s, q)) AS b, string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS runs
                 FROM u GROUP BY r)
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b[1] AS start, b[2] AS length, b[3] AS period, 1000 * b[2] // b[3] AS exponent_milli,
               sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(k, '')) AS collapsed_sha256
        FROM t LEFT JOIN best USING (r) LEFT JOIN kept USING (r)""",
}
