"""Secret scan: fixed patterns, and strings that a Markov model of random text explains better than one of identifiers.

Everything that touches rows is a DataFrame expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.scratch import write_table

#: The kinds of the base scan, in order, with their patterns; then the kind that the models add.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: Strings that the models judge.
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
#: Words that teach the model of ordinary identifiers, and characters of those that its spread is measured on, at least.
ORDINARY, LEAST_ORDINARY = r"[A-Za-z0-9]{3,}", 8
#: Deviations that a string must be above the mean of ordinary words, and its mean log ratio at least.
DEVIATIONS, LEAST_RATIO = 4.0, 0.5
#: The most that one transition may say for or against chance (natural logarithm): one never seen proves little.
MOST = 3.0
#: Digits count as one character, letters in either case as one; marks part a string into words.
ALPHABET = 27

_OPEN, _CLOSE, _OTHER = "\x01", "\x02", "\x03"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, a hash of the text, and the text without the two marks (both replaced by a third, so no place moves)."""
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(
        docs[id_col].alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.translate(text, _OPEN + _CLOSE, _OTHER + _OTHER).alias("text"),
    )


def _parts(kind: int, possible: Column, pattern: str) -> Column:
    """The text cut before each match; each part but the first is a match, a mark, and what follows it."""
    marked = F.regexp_replace("text", pattern, f"{_OPEN}$0{_CLOSE}")
    cut = F.when(possible, F.split(marked, _OPEN)).otherwise(F.array().cast("array<string>"))
    return F.struct(F.lit(kind).alias("kind"), cut.alias("parts"))


def _may_assign() -> Column:
    word = F.lit(False)
    for name in ("passw", "secret", "token", "api"):
        word |= F.contains(F.lower("text"), F.lit(name))
    return word


def _matches(keyed: DataFrame, with_candidates: bool) -> DataFrame:
    """One row per part of texts with matches: doc_id, text_hash, kind, i, n (code points), found (null in front of the first match)."""
    kinds = [
        _parts(0, _may_assign(), ASSIGN),
        _parts(1, F.contains("text", F.lit("AKIA")), ACCESS),
        _parts(2, F.col("text").rlike("[0-9a-f]{%d}" % LEAST_HEX), "[0-9a-f]{%d,}" % LEAST_HEX),
    ]
    if with_candidates:
        kinds.append(_parts(3, F.col("text").rlike(CANDIDATE), CANDIDATE))
    by_kind = keyed.select(
        "doc_id", "text_hash", F.explode(F.filter(F.array(*kinds), lambda k: F.size(k["parts"]) > 1)).alias("of")
    )
    part = by_kind.select("doc_id", "text_hash", F.col("of.kind").alias("kind"), F.posexplode("of.parts").alias("i", "part"))
    first = F.col("i") == 0
    return part.select(
        "doc_id",
        "text_hash",
        "kind",
        "i",
        (F.length("part") - F.when(first, 0).otherwise(1)).alias("n"),
        F.when(~first, F.substring_index("part", _CLOSE, 1)).alias("found"),
    )


@dataclass(frozen=True)
class Models:
    """Log ratios of the two models' transition probabilities, random over ordinary, at 128 a + b; and the least mean ratio of a random string."""

    ratios: list[float]
    least: float


def _folded(string: Column) -> Column:
    return F.translate(F.lower(string), "123456789+/_.=-", "000000000      ")


def _transitions(string: Column) -> Column:
    """128 a + b for each character b of the folded string and the one in front of it (a space at the start)."""
    c = F.split(_folded(string), "")
    before = F.concat(F.array(F.lit(" ")), F.slice(c, 1, F.size(c) - 1))
    return F.zip_with(before, c, lambda a, b: F.ascii(a) * 128 + F.ascii(b))


def _counts(strings: DataFrame) -> dict[int, int]:
    """How often each transition to a letter or digit occurs in column ``s``, with the string's weight ``n`` (ASCII only)."""
    each = strings.where("s <> ''").select(F.explode(_transitions(F.col("s"))).alias("t"), "n")
    # at most 128 x 95 groups
    return {r["t"]: r["n"] for r in each.where("t % 128 > 32 AND t < 128 * 128").groupBy("t").agg(F.sum("n").alias("n")).collect()}


def _conditional(counts: dict[int, int]) -> list[float]:
    """log P(b | a) at 128 a + b, with half a count added to each character."""
    total = [0] * 128
    for t, n in counts.items():
        total[t // 128] += n
    return [math.log((counts.get(t, 0) + 0.5) / (total[t // 128] + 0.5 * ALPHABET)) for t in range(128 * 128)]


def _spread(strings: DataFrame, ratios: list[float]) -> tuple[float | None, float | None]:
    """Mean and deviation of the strings' mean ratios, each string as often as its weight says."""
    each = strings.select("n", _ratio(F.col("s"), ratios).alias("r"))
    n, one, two = each.agg(F.sum("n"), F.sum(F.col("n") * F.col("r")), F.sum(F.col("n") * F.col("r") * F.col("r"))).first()
    return (one / n, math.sqrt(max(0.0, two / n - (one / n) ** 2))) if n else (None, None)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Models:
    """Both models and the threshold between them, from all documents.

    The labels come from the fixed patterns: the values of assignments and the access keys that they
    find are the random strings (plain hexadecimal ones would teach 16 characters only); the
    ordinary ones are all words of letters and digits outside of what the patterns find, each as often
    as it occurs.
    The least mean ratio is where the means of both kinds are equally many deviations away, and at least
    ``DEVIATIONS`` above the ordinary mean and ``LEAST_RATIO``. Without any finding, or without ordinary words, no string is random.
    """
    keyed = _keyed(docs, id_col, text_col)
    found = _matches(keyed, with_candidates=False).where("found IS NOT NULL AND kind < 2")
    value = F.when(F.col("kind") == 0, F.regexp_extract("found", ASSIGN, 2)).otherwise(F.substring("found", 5, 1 << 30))
    one = F.lit(1).cast("bigint").alias("n")
    random, _ = write_table(found.select(value.alias("s"), one).where(F.length("s") >= LEAST_ASSIGN))
    rest = F.col("text")
    hexed = "[0-9a-f]{%d,}" % LEAST_HEX
    for possible, pattern in ((_may_assign(), ASSIGN), (F.contains("text", F.lit("AKIA")), ACCESS), (F.col("text").rlike(hexed), hexed)):
        rest = F.when(possible, F.regexp_replace(rest, pattern, " ")).otherwise(rest)
    words = keyed.select(F.explode(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))).alias("s"))
    ordinary, _ = write_table(words.groupBy("s").agg(F.count(F.lit(1)).alias("n")))
    positive, negative = _counts(random), _counts(ordinary)
    a, b = _conditional(positive), _conditional(negative)
    ratios = [max(-MOST, min(MOST, x - y)) if t % 128 > 32 else 0.0 for t, (x, y) in enumerate(zip(a, b, strict=True))]
    mean_r, deviation_r = _spread(random, ratios)
    mean_o, deviation_o = _spread(ordinary.where(F.length("s") >= LEAST_ORDINARY), ratios)
    if mean_r is None or mean_o is None:
        return Models(ratios, math.inf)
    both = deviation_r + deviation_o
    middle = (mean_r * deviation_o + mean_o * deviation_r) / both if both else (mean_r + mean_o) / 2
    return Models(ratios, max(middle, mean_o + DEVIATIONS * deviation_o, LEAST_RATIO))


def _ratio(string: Column, ratios: list[float]) -> Column:
    """The mean log ratio of a string's transitions, each different one counted once: characters that repeat are no sign of chance."""
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in ratios)), ",").cast("array<double>")
    each = _transitions(string)
    total = F.aggregate(F.array_distinct(each), F.lit(0.0), lambda s, t: s + F.coalesce(F.get(table, t), F.lit(0.0)))
    return total / F.size(each)


def find_secrets(
    docs: DataFrame,
    models: Models,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id and spans, an array of (start, kind, end) sorted so.

    Places are code points, the end is exclusive, kind is an index into KINDS. Any string of 16
    characters or more is random (kind 3) if its mean log ratio reaches ``models.least`` and it
    overlaps no span of the patterns. Null and empty texts have no spans; rows that share id and text
    have the same spans; a very long text is read whole. An empty table gives no rows.
    """
    keyed = _keyed(docs, id_col, text_col)
    parts = _matches(keyed, with_candidates=True)
    good = (
        F.when(F.col("kind") == 0, F.length(F.regexp_extract("found", ASSIGN, 2)) >= LEAST_ASSIGN)
        .when(F.col("kind") == 1, F.length("found") >= LEAST_ACCESS)
        .when(F.col("kind") == 2, F.lit(True))
        .otherwise(_ratio(F.col("found"), models.ratios) >= models.least)
    )
    key = ["doc_id", "text_hash"]
    short = parts.select(
        *key, "kind", "i", "n", F.length("found").alias("size"), F.coalesce(F.col("found").isNotNull() & good, F.lit(False)).alias("good")
    ).dropDuplicates([*key, "kind", "i"])
    before = Window.partitionBy(*key, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        short.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .where("good")
        .withColumn("end", F.col("start") + F.col("size"))
    )
    in_order = Window.partitionBy(*key).orderBy("start", "kind", "end")
    base = F.col("kind") < 3
    behind = F.max(F.when(base, F.col("end"))).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(base, F.col("start"))).over(in_order.rowsBetween(0, Window.unboundedFollowing))
    alone = spans.withColumn("behind", behind).withColumn("ahead", ahead).where(
        base | ((F.coalesce("behind", F.lit(0)) <= F.col("start")) & (F.coalesce("ahead", F.col("end")) >= F.col("end")))
    )
    by_doc = alone.groupBy(*[F.col(k).alias(f"of_{k}") for k in key]).agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")
    )
    return keyed.join(
        by_doc, F.col("doc_id").eqNullSafe(F.col("of_doc_id")) & (F.col("text_hash") == F.col("of_text_hash")), "left"
    ).select("doc_id", F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")).alias("spans"))


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds and the spans written as kind:start:end."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def written(spans: Column) -> Column:
        one = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
        return F.concat_ws(",", one)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(written(F.filter("spans", lambda s: s["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
