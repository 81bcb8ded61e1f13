"""What the text operators share: reading columns, bounded slices of texts, hashes of words and grams.

Every operator takes a DataFrame and the names of its id and text columns. It selects these two
first, so other columns of the input, whatever their names, neither reach the operator nor clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task holds in numpy form at a time (a longer text is a slice of its own).
SLICE_BYTES = 2 << 20

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def parallelism(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(first, last - first)
            first = last


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(text).cast(pa.binary()).to_pylist()]


def map_arrow(
    df: DataFrame, rows: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str, text: str = "text"
) -> DataFrame:
    """``rows`` applied to every bounded slice, in tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            yield from rows(part)

    return df.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits depend on all bits of ``x``."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0][:n], _powers[1][:n]


def hashed_words(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words (runs of non-space bytes) of all texts, in order.

    Returns the hashes, the first word of each text (one more entry at the end), and each word's
    first and end byte in the texts joined by line breaks. Equal words have equal hashes.
    """
    joined = b"\n".join(texts) + b"\n"
    if lower:
        joined = joined.translate(LOWER)
    raw = np.frombuffer(joined, np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    first, end = edge[0::2], edge[1::2]
    hashes = np.empty(len(first), np.uint64)
    step = 1 << 20
    # prefix sums of byte * base**position by pieces: a word's hash is its sum moved to position 0
    for lo in range(0, len(first), step):
        hi = min(lo + step, len(first))
        begin, stop = int(first[lo]), int(end[hi - 1])
        for a, b, x, y in _pieces(first[lo:hi], end[lo:hi], begin, stop):
            up, down = _power_tables(y - x + 1)
            sums = np.zeros(y - x + 1, np.uint64)
            np.cumsum((raw[x:y].astype(np.uint64) + np.uint64(1)) * up[: y - x], out=sums[1:])
            f, e = first[lo + a : lo + b] - x, end[lo + a : lo + b] - x
            hashes[lo + a : lo + b] = (sums[e] - sums[f]) * down[f]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    starts = np.searchsorted(first, np.concatenate(([0], np.cumsum(sizes))))
    return mix(hashes + (end - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts, first, end


def _pieces(first: np.ndarray, end: np.ndarray, begin: int, stop: int, size: int = 1 << 20):
    """Runs of words whose bytes span about ``size``, as (first word, end word, first byte, end byte)."""
    a = 0
    while a < len(first):
        b = max(a + 1, int(np.searchsorted(end, first[a] + size, side="right")))
        yield a, b, int(first[a]), int(end[b - 1])
        a = b


def hashed_grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of each run of ``k`` words; entry i covers words i to i + k - 1."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total *= np.uint64(0xD1342543DE82EF95)
        total += words[j : j + n]
    return mix(total)


def within(starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts of runs of ``k`` words that lie inside one text, and the text of each."""
    counts = np.maximum(np.diff(starts) - k + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return starts[:-1][owner] + offset, owner


def most_frequent(counts: DataFrame, limit: int) -> pa.Table:
    """Rows of ``counts`` (with column n) with the largest n: as many whole bands of n as hold ``limit`` rows at most."""
    band = F.floor(F.log2("n") * 16).cast("int")
    sizes = counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("rows")).collect()  # about 1,000 bands at most
    rows, least = 0, None
    for r in sorted(sizes, key=lambda r: -r["band"]):
        rows += r["rows"]
        if rows > limit:
            break
        least = r["band"]
    return counts.where(band >= (1 << 30 if least is None else least)).toArrow()
