"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_and_text, map_arrow, texts_of

#: Labelled documents that a fit reads at most: those with the smallest hashes of their ids.
FIT_ROWS = 20_000

FEATURES = (
    "bytes", "words", "lines", "letter_share", "upper_share", "digit_share", "space_share", "beyond_ascii_share",
    "mark_share", "stop_share", "word_length", "longest_word", "distinct_words", "top_word_share", "repeated_neighbours",
    "distinct_pairs", "upper_words", "plain_words", "distinct_lines", "line_length", "short_lines", "top_line_share",
    "top_mark_share",
)

_KIND = np.zeros((256, 7))
for _c in range(256):
    _KIND[_c] = [
        chr(_c).isalpha() and _c < 128,
        65 <= _c <= 90,
        48 <= _c <= 57,
        _c in b" \t\n\r\x0b\x0c",
        _c >= 128,
        33 <= _c <= 47 or 58 <= _c <= 64 or 91 <= _c <= 96 or 123 <= _c <= 126,
        _c in b".,;:?",
    ]
_MARKS = np.flatnonzero(_KIND[:, 5])


def statistics(text: bytes) -> list[float]:
    """The features of one whole text, in the order of FEATURES; an empty text has zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = len(text)
    share = (count @ _KIND / n).tolist()
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    w, m = max(len(words), 1), max(len(lines), 1)
    sizes = list(map(len, words))
    return [
        np.log1p(n),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        *share,
        sum(sizes) / w,
        min(max(sizes, default=0), 1000),
        len(set(words)) / w,
        max(Counter(words).values(), default=0) / w,
        sum(map(eq, words, words[1:])) / w,
        len(set(zip(words, words[1:], strict=False))) / w,
        sum(map(bytes.isupper, words)) / w,
        sum(map(bytes.isalpha, words)) / w,
        len(set(lines)) / m,
        min(sum(map(len, lines)) / m, 10_000),
        sum(len(x) < 30 for x in lines) / m,
        max(Counter(lines).values(), default=0) / m,
        float(count[_MARKS].max()) / n,
    ]


@dataclass
class Trees:
    """All trees as arrays (tree, node): node i of a level has the children 2 i + 1 and 2 i + 2."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities; all rows walk down all trees together, level by level."""
        if not len(self.feature):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        tree = np.arange(len(self.feature))[None, :]
        row = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        inner = self.feature.shape[1]
        while node[0, 0] < inner if len(x) else False:
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        raw = self.base + self.leaf[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-raw))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 120,
    depth: int = 4,
    rate: float = 0.1,
    bins: int = 64,
    least: int = 20,
    penalty: float = 1.0,
) -> Trees:
    """Boosting on the logistic loss. Each level's splits come from one histogram of the binned columns."""
    n, k = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 1 - 1e-3
    base = float(np.log(share / (1 - share)))
    if n < 2 * least or y.min() == y.max():
        return Trees(np.empty((0, inner), int), np.empty((0, inner)), np.empty((0, leaves)), base)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(k)]
    code = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(k)], axis=1)  # bin b: above cut b - 1
    feature = np.zeros((rounds, inner), np.int64)
    threshold = np.full((rounds, inner), np.inf)
    leaf = np.zeros((rounds, leaves))
    raw = np.full(n, base)
    offset = np.arange(k)[None, :] * bins
    for r in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width = 2**level
            at = ((node - width + 1)[:, None] * (k * bins) + offset + code).ravel()
            size = width * k * bins
            sums = [
                np.bincount(at, np.repeat(v, k), size).reshape(width, k, bins).cumsum(axis=2) for v in (g, h, np.ones(n))
            ]
            (gl, hl, nl), (gt, ht, nt) = sums, [s[:, :, -1:] for s in sums]
            gain = gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt**2 / (ht + penalty)
            gain[(nl < least) | (nt - nl < least)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for i, b in enumerate(best.tolist()):
                j, c = divmod(b, bins)
                if gain[i, j, c] > 1e-9:
                    feature[r, width - 1 + i], threshold[r, width - 1 + i] = j, cuts[j][c]
            node = 2 * node + 1 + (x[np.arange(n), feature[r, node]] > threshold[r, node])
        own = node - inner
        top, low = np.bincount(own, g, leaves), np.bincount(own, h, leaves)
        leaf[r] = -rate * top / (low + penalty)
        raw += leaf[r][own]
    return Trees(feature, threshold, leaf, base)


def _features(docs: DataFrame, model) -> DataFrame:
    """doc_id with the features, or with the scores of a broadcast model."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = np.array([statistics(t) for t in texts_of(part)])
        if model is None:
            out = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        else:
            out = pa.array(model.value.score(x))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), out], names=["doc_id", "out"])

    return map_arrow(docs, rows, f"doc_id {kind}, out {'array<double>' if model is None else 'double'}")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> Trees:
    """Trees fitted to the labelled documents; ``usable`` is a condition on the labels table.

    The fit reads at most ``fit_rows`` labelled documents, whose statistics are collected: a bounded
    sample by the hash of the id. Null labels and ids are left out; a document labelled several
    times has the mean of its labels; of documents that share an id one is taken. Without usable
    labels, or with labels of one kind only, all documents score alike (1 less a thousandth without
    labels).
    """
    marked = labels.where(usable) if usable is not None else labels
    marked = (
        marked.select(marked[label_id_col].alias("doc_id"), marked[label_col].cast("double").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").between(0, 1))
        .groupBy("doc_id")
        .agg(F.avg("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    # at most fit_rows short rows on this side
    known = id_and_text(docs, id_col, text_col).join(F.broadcast(marked), "doc_id", "left_semi")
    x = _features(known, None).groupBy("doc_id").agg(F.max("out").alias("x"))
    got = sorted(x.join(F.broadcast(marked), "doc_id").select("doc_id", "x", "y").collect(), key=lambda r: r["doc_id"])
    return fit_trees(
        np.array([r["x"] for r in got], float).reshape(len(got), len(FEATURES)), np.array([r["y"] for r in got], float)
    )


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row; null and empty texts have the statistics of an empty text.

    Equal texts have equal scores, rows that repeat a row each; a very long text is read whole. An empty
    table gives no rows; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return _features(id_and_text(docs, id_col, text_col), sent).withColumnRenamed("out", "score")


def keep_good(docs: DataFrame, model: Trees, least: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``least`` or more; as in ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def good(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = np.array([statistics(t) for t in texts_of(part, text_col)])
        yield part.filter(pa.array(sent.value.score(x) >= least))

    return map_arrow(docs, good, schema, text_col)
