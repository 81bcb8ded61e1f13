"""Benchmark decontamination: Wu-Manber search for all word windows of a benchmark at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_and_text, map_arrow, texts_of

#: Lower-cases A-Z, keeps a-z, 0-9 and everything beyond ASCII, turns the rest into spaces.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: Words of the benchmark in one set of tables; a larger benchmark takes several, searched in turn.
BLOCK_WORDS = 500_000
#: Slots of a shift table for each word of its patterns' items, and their number's logarithm at least and at most.
SLOTS_PER_WORD, LEAST_BITS, MOST_BITS = 8, 16, 24
#: Positions one cursor walks over; all cursors of a slice move together.
_SEGMENT = 256

SPANS = "array<struct<first:bigint,end:bigint>>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def _block_hash(before: np.ndarray | None, last: np.ndarray, bits: int) -> np.ndarray:
    """Hash of the block of two words that ends with ``last`` (of one word if there is none before)."""
    x = last.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    if before is not None:
        x += before.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


class Tables:
    """Shift table and suffix buckets of all patterns of one length.

    Most slots must be empty for the search to skip, so there are several per block of words.
    """

    def __init__(self, length: int, patterns: list[tuple[int, ...]], items: list[list[int]]):
        self.length, self.block = length, min(2, length)
        rows = np.array(patterns, np.int32).reshape(len(patterns), length)
        # neighbouring windows share all blocks but one
        self.bits = min(MOST_BITS, max(LEAST_BITS, (SLOTS_PER_WORD * len(patterns)).bit_length()))
        self.shift = np.full(1 << self.bits, length - self.block + 1, np.uint16)
        for q in range(self.block - 1, length):
            h = _block_hash(rows[:, q - 1] if self.block == 2 else None, rows[:, q], self.bits)
            np.minimum.at(self.shift, h, np.uint16(length - 1 - q))
        suffix = _block_hash(rows[:, -2] if self.block == 2 else None, rows[:, -1], self.bits)
        order = np.argsort(suffix, kind="stable")
        self.rows, self.items, self.suffix = rows[order], [items[i] for i in order], suffix[order]

    def matches(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last positions of all occurrences and their patterns; -1 in ``ids`` fits no pattern."""
        n, m = len(ids), self.length
        at = np.arange(m - 1, n, _SEGMENT)
        stop = np.minimum(at + _SEGMENT, n)
        found_at, found = [], []
        while len(at):
            last = ids[at]
            before = ids[at - 1] if self.block == 2 else None
            h = _block_hash(before, last, self.bits)
            jump = np.where(last < 0, m, self.shift[h])
            hit = np.flatnonzero(jump == 0)
            if len(hit):
                p, row, end = at[hit], *(np.searchsorted(self.suffix, h[hit], side=s) for s in ("left", "right"))
                while len(p):
                    same = np.ones(len(p), bool)
                    for q in range(m - 1, -1, -1):
                        same &= self.rows[row, q] == ids[p - (m - 1 - q)]
                    found_at.append(p[same])
                    found.append(row[same])
                    more = (row + 1 < end) & ~same
                    p, row, end = p[more], row[more] + 1, end[more]
            at = at + np.maximum(jump, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_at), np.concatenate(found)


class Benchmark:
    """The vocabulary and the tables of some items: (id as text, text)."""

    def __init__(self, items: Iterable[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names: list[str] = []
        windows: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if not ids:
                continue
            number = len(self.names)
            self.names.append(name)
            m = min(window, len(ids))
            of = windows.setdefault(m, {})
            for i in range(len(ids) - m + 1):
                owners = of.setdefault(tuple(ids[i : i + m]), [])
                if not owners or owners[-1] != number:
                    owners.append(number)
        self.tables = [Tables(m, list(x), list(x.values())) for m, x in sorted(windows.items())]

    def search(self, words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, set[tuple[int, str]]]:
        """Per word of the texts, one after another, where hits begin and end; the (text, item) pairs."""
        get = self.vocabulary.get
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate(([0], np.cumsum(sizes + 1)))  # one more word, unknown, ends a text
        ids = np.full(int(starts[-1]), -1, np.int32)
        for k, text in enumerate(words):
            if text:
                ids[starts[k] : starts[k] + len(text)] = [get(w, -1) for w in text]
        edge = np.zeros(len(ids) + 1, np.int64)
        pairs: set[tuple[int, str]] = set()
        for t in self.tables:
            at, row = t.matches(ids)
            if len(at):
                np.add.at(edge, at - t.length + 1, 1)
                np.add.at(edge, at + 1, -1)
                owner = np.searchsorted(starts, at, side="right") - 1
                for k, r in set(zip(owner.tolist(), row.tolist(), strict=True)):
                    pairs.update((k, self.names[i]) for i in t.items[r])
        return edge, starts, pairs


def _blocks(items: Iterator, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    block, size = [], 0
    for row in items:
        text = (row["text"] or "").encode()
        n = len(words_of(text))
        if block and size + n > limit:
            yield block
            block, size = [], 0
        block.append((row["item"], text))
        size += n
    if block:
        yield block


def _sent(benchmark: DataFrame, window: int, item_col: str, item_text_col: str, block_words: int) -> list:
    """The benchmark's tables, one broadcast per block."""
    wanted = benchmark.select(
        benchmark[item_col].cast("string").alias("item"), benchmark[item_text_col].alias("text")
    ).where(F.col("item").isNotNull() & F.col("text").isNotNull())
    context = benchmark.sparkSession.sparkContext
    return [context.broadcast(Benchmark(block, window)) for block in _blocks(wanted.toLocalIterator(), block_words)]


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has no window of an item; as in ``find_items``."""
    sent = _sent(benchmark, window, item_col, item_text_col, block_words)

    def clean(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = [words_of(x) for x in texts_of(part, text_col)]
        hit = {k for b in sent for k, _ in b.value.search(words)[2]}
        yield part.filter(pa.array([k not in hit for k in range(len(words))], pa.bool_()))

    return map_arrow(docs, clean, docs.schema, text_col)


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Where windows of benchmark items occur in documents.

    Returns one row per row of ``docs``: doc_id, n_words, hit_spans (maximal runs of words inside
    an occurrence, as first and end word) and items (ids of the occurring items, as sorted texts).
    Words are compared in lower case (A-Z only). An item of fewer words than ``window`` is one
    window; an item without words or without an id is none. Null and empty texts have no words,
    empty tables give no hits, rows that repeat are answered each, ids repeat in ``items`` never. A
    very long text is a slice of its own and searched whole; other columns are not read.

    The benchmark is the stated query set: it is read to the driver block by block and sent to the
    tasks in tables of at most ``block_words`` words each, which are searched in turn.
    """
    sent = _sent(benchmark, window, item_col, item_text_col, block_words)

    def rows(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = [words_of(x) for x in texts_of(part)]
        edge = starts = None
        pairs: set[tuple[int, str]] = set()
        for b in sent:
            e, starts, more = b.value.search(words)
            edge = e if edge is None else edge + e
            pairs |= more
        spans: list[list[dict]] = [[] for _ in words]
        if edge is not None:
            hit = np.concatenate(([False], np.cumsum(edge) > 0, [False]))
            turn = np.flatnonzero(hit[1:] != hit[:-1])
            for first, end in zip(turn[0::2].tolist(), turn[1::2].tolist(), strict=True):
                k = int(np.searchsorted(starts, first, side="right")) - 1
                spans[k].append({"first": first - int(starts[k]), "end": end - int(starts[k])})
        items: list[list[str]] = [[] for _ in words]
        for k, name in pairs:
            items[k].append(name)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                pa.array([sorted(x, key=str.encode) for x in items], pa.list_(pa.string())),
            ],
            names=["doc_id", "n_words", "hit_spans", "items"],
        )

    found = id_and_text(docs, id_col, text_col)
    kind = found.schema["doc_id"].dataType.simpleString()
    return map_arrow(found, rows, f"doc_id {kind}, n_words bigint, hit_spans {SPANS}, items array<string>")


def report(found: DataFrame) -> DataFrame:
    """The digest of ``find_items``: counts of words, hit words and items, the items' hash."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
