"""Document fingerprints by winnowing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_and_text, map_arrow, mix, slices, texts_of

#: Code points of a gram (a power of two): shorter matches are noise.
GRAM = 16
#: Grams of a window (a power of two): any match of GRAM + WINDOW - 1 code points shares a selected gram.
WINDOW = 128
#: Grams worked on at a time.
_CHUNK = 1 << 20
#: Documents of one run of neighbours, and the most runs (the table of their bounds is sent to every task).
RUN_ROWS, RUNS = 1_000, 100_000

_BASE = 0x9E3779B97F4A7C15
_FLIP = np.uint64(0xFFFFFFFF)


def _roll(points: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hashes of all grams, by doubling: a gram is its first half times a power, plus its second half."""
    h = mix(points.astype(np.uint64) + np.uint64(1))
    size, power = 1, _BASE
    while size < gram:
        h = h[:-size] * np.uint64(power) + h[size:]
        size, power = size * 2, power * power % (1 << 64)
    return mix(h)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The selected grams of a text, in order: 32-bit hashes and places (code points).

    Of each ``window`` consecutive grams the one with the smallest hash is selected, of equal ones
    the rightmost; neighbouring windows that select the same gram give one entry. A text with fewer
    grams is one window, a text shorter than ``gram`` one gram, an empty text has no entry.
    """
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    if n < gram:
        points = np.concatenate((points, np.full(gram - n, 0xFFFFFFFF - n, np.uint32)))
        n = gram
    grams = n - gram + 1
    wide = min(window, grams)
    chosen = []
    for first in range(0, grams - wide + 1, _CHUNK):
        last = min(first + _CHUNK, grams - wide + 1) + wide - 1  # the end of this chunk's grams
        low = _roll(points[first : last + gram - 1], gram) >> np.uint64(32) << np.uint64(32)
        low |= _FLIP - np.arange(first, last, dtype=np.uint64)  # of equal hashes the rightmost is the smallest
        size = 1
        while size * 2 <= wide:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < wide:
            low = np.minimum(low[: len(low) - (wide - size)], low[wide - size :])
        chosen.append(low[np.concatenate(([True], low[1:] != low[:-1]))])
    low = np.concatenate(chosen)
    low = low[np.concatenate(([True], low[1:] != low[:-1]))]
    return (low >> np.uint64(32)).astype(np.uint32), (_FLIP - (low & _FLIP)).astype(np.int64)


def written(hashes: np.ndarray, places: np.ndarray) -> str:
    """A fingerprint as text: for each entry eight hexadecimal digits of the place, then eight of the hash."""
    both = np.empty((len(hashes), 2), ">u4")
    both[:, 0], both[:, 1] = places, hashes
    return both.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two fingerprints' distinct hashes; 1 if both are empty."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(
    docs: DataFrame, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_chars, hashes and places of every row's whole text; a null text is empty."""
    found = id_and_text(docs, id_col, text_col)
    kind = found.schema["doc_id"].dataType.simpleString()

    def rows(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [t.decode() for t in texts_of(part)]
        both = [winnow(t, gram, window) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([h.astype(np.int64) for h, _ in both], pa.list_(pa.int64())),
                pa.array([p for _, p in both], pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_chars", "hashes", "places"],
        )

    return map_arrow(found, rows, f"doc_id {kind}, n_chars bigint, hashes array<bigint>, places array<bigint>")


def _runs(docs: DataFrame, run_rows: int) -> tuple[DataFrame, np.ndarray]:
    """Rows with the run of neighbouring ids that they belong to, largest ids in run 0, and the bounds.

    The row that follows a run (the first of the next run) is added to it once more, as its tail.
    """
    sort_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    keyed = docs.select("doc_id", sort_id.alias("sort_id"), "text")
    n, smallest = keyed.agg(F.count(F.lit(1)), F.min("sort_id")).first()
    runs = min(n // run_rows + 1, RUNS)
    shares = [i / runs for i in range(1, runs)]
    cut = keyed.agg(F.percentile_approx("sort_id", shares, max(10_000, 4 * runs))).first()[0] if n and shares else []
    bounds = np.unique(np.array(sorted(cut or []), np.int64))

    def run_of(ids: np.ndarray) -> np.ndarray:
        return len(bounds) - np.searchsorted(bounds, ids, side="left")

    @F.pandas_udf("int")
    def run(ids: pd.Series) -> pd.Series:
        return pd.Series(run_of(ids.to_numpy()))

    # a row for each run, RUNS at most
    firsts = {r["run"]: r["first"] for r in keyed.select("sort_id").groupBy(run("sort_id").alias("run")).agg(F.max("sort_id").alias("first")).collect()}
    order = sorted(firsts)
    tail_of = {firsts[b]: a for a, b in zip([order[-1], *order[:-1]], order, strict=True)} if order else {}
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = part.column("sort_id").to_numpy()
        again = [k for k, i in enumerate(ids.tolist()) if i in tail_of]
        take = pa.array([*range(len(ids)), *again], pa.int64())
        own = run_of(ids).tolist() + [tail_of[int(ids[k])] for k in again]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(own, pa.int32()),
                pa.array([False] * len(ids) + [True] * len(again)),
                *[part.column(c).take(take) for c in ("doc_id", "sort_id", "text")],
            ],
            names=["run", "tail", "doc_id", "sort_id", "text"],
        )

    return map_arrow(keyed, rows, f"run int, tail boolean, doc_id {kind}, sort_id bigint, text string"), bounds


def edited_fingerprints(
    docs: DataFrame,
    gram: int = GRAM,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to each other and the next one's.

    The next document has the next smaller id (nulls smallest; equal ids in the order of their
    texts' hashes); the largest follows the smallest. The edited text has its last half replaced by
    as many code points from the start of the next document. Rows are dealt to runs of neighbouring
    ids of about ``run_rows``, so no task depends on another and the texts move once. Ids must be
    whole numbers. Null texts are empty and have empty fingerprints; rows that repeat follow one
    another and have a row each; a single row is its own next one. A very long text is hashed in
    stretches, whole. An empty table gives no rows; other columns are not read.
    """
    found = id_and_text(docs, id_col, text_col)
    runs, _ = _runs(found, run_rows)
    kind = found.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next one
        for part in slices(batches):
            out = []
            ids, runs_, tails = (part.column(c).to_pylist() for c in ("doc_id", "run", "tail"))
            for doc_id, run, tail, raw in zip(ids, runs_, tails, texts_of(part), strict=True):
                if tail and (held is None or held[1] != run):
                    continue  # a tail of a run that has already met its next row
                text = raw.decode()
                own = winnow(text, gram, window)
                if held is not None:
                    half = len(held[2]) // 2
                    edited = held[2][: len(held[2]) - half] + text[:half]
                    new = winnow(edited, gram, window)
                    out.append(
                        (
                            held[0],
                            len(held[2]),
                            hashlib.sha256(edited.encode()).hexdigest(),
                            written(*held[3]),
                            written(*new),
                            likeness(held[3][0], new[0]),
                            likeness(held[3][0], own[0]),
                        )
                    )
                held = None if tail else (doc_id, run, text, own)
            if out:
                columns = [pa.array(c) for c in zip(*out, strict=True)]
                columns[0] = columns[0].cast(part.schema.field("doc_id").type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    dealt = runs.repartition("run").sortWithinPartitions(
        "run", "tail", F.col("sort_id").desc(), F.xxhash64(F.coalesce("text", F.lit(""))), F.col("doc_id").isNull()
    )
    return dealt.mapInArrow(
        walk,
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
