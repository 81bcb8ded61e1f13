"""Best-fit packing of tokenised documents into sequences of a fixed capacity."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import id_and_text, slices, texts_of
from millrace.sources.scratch import write_table

#: Rows (task and length) of the table of first numbers that every task may hold: 16 bytes each.
HELD_FIRSTS = 2_000_000
#: Code points without a space, or spaces alone, from which on a text is left to the tokenizer.
LONG_RUN = 1_000

#: Columns that number the pieces of a length in their task.
NUMBERED = ("__task", "__number")

#: The characters that byte-level BPE writes for bytes: printing ones stand for themselves, the others follow from 256 on.
_PRINTING = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTING]
_BYTES = {chr(b if b in _PRINTING else 256 + _OTHERS.index(b)): b for b in range(256)}


class _Ids:
    """Ids of texts as little-endian 32-bit numbers.

    A byte-level BPE whose merges come in the order of their ids is the same vocabulary as ranks, which
    merges several times as fast; the tokenizer itself does texts with its special tokens in them, with
    very long runs (merged in square time by rank), and all texts of another kind of vocabulary.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path, spec = path, json.loads(Path(path).read_bytes())
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.ranks = self._by_rank(spec)

    @cached_property
    def tokenizer(self):
        """Read when a text needs it: most tasks do without, and it holds much memory."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @staticmethod
    def _by_rank(spec: dict):
        import public_tokenizers
        import tiktoken

        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        bytewise = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        if not (plain and bytewise) or spec["normalizer"] or set(_BYTES) - set(model["vocab"]):
            return None
        merged = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        if merged != sorted(merged):
            return None
        ranks = {bytes(map(_BYTES.get, k)): i for k, i in model["vocab"].items() if set(k) <= set(_BYTES)}
        return tiktoken.Encoding("by rank", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        long = " " * LONG_RUN in text or max(map(len, text.split(" "))) > LONG_RUN
        if self.ranks is None or long or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


class _Numbers:
    """Numbers the pieces of each length that a task sees, one batch after another."""

    def __init__(self, capacity: int):
        self.task, self.seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)

    def added(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """The batch with __task and __number; a length that no sequence holds counts as 0."""
        length = pc.fill_null(batch.column("length"), 0).to_numpy(zero_copy_only=False)
        length = np.where((length >= 1) & (length < len(self.seen)), length, 0)
        order = np.argsort(length, kind="stable")
        own = np.empty(len(length), np.int64)
        own[order] = np.arange(len(length)) - np.searchsorted(length[order], length[order])
        columns = [*batch.columns, pa.array(np.full(len(length), self.task, np.int32)), pa.array(self.seen[length] + own)]
        self.seen += np.bincount(length, minlength=len(self.seen))
        return pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *NUMBERED])


_loaded: dict[str, _Ids] = {}


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    numbered: bool = False,
) -> DataFrame:
    """The ids of every text, ``end_id`` last, cut from the end into pieces of ``capacity``.

    Returns doc_id, piece, start, length, ids_crc32 and, unless ``with_ids`` is off, ids (little-endian
    32-bit numbers); with ``numbered`` also what ``pack`` would otherwise add in a pass of its own. Only the first piece may be shorter than ``capacity``. Null is an empty text: one
    piece, the end id. Rows that repeat have the same pieces each; a very long text has as many as it
    needs; an empty table gives no rows. ``tokenizer_path`` must name a file of the ``tokenizers``
    library on every executor.
    """
    found = id_and_text(docs, id_col, text_col)
    kind = found.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        if tokenizer_path not in _loaded:
            _loaded[tokenizer_path] = _Ids(tokenizer_path)
        encoded = [_loaded[tokenizer_path].encode(t.decode()) for t in texts_of(part)]
        row, piece, start, length, crc, ids = [], [], [], [], [], []
        for k, whole in enumerate(encoded):
            whole += end
            n = len(whole) // 4
            cut = [0, *range(n % capacity or capacity, n + 1, capacity)]
            for p, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
                data = whole[4 * a : 4 * b]
                row.append(k)
                piece.append(p)
                start.append(a)
                length.append(b - a)
                crc.append(zlib.crc32(data))
                if with_ids:
                    ids.append(data)
        columns = {
            "doc_id": part.column("doc_id").take(pa.array(row, pa.int64())),
            "piece": pa.array(piece, pa.int32()),
            "start": pa.array(start, pa.int64()),
            "length": pa.array(length, pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array(ids, pa.binary())
        return pa.RecordBatch.from_pydict(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(capacity)
        for part in slices(batches):
            yield numbers.added(rows(part)) if numbered else rows(part)

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return found.mapInArrow(run, schema + ", __task int, __number bigint" * numbered)


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """How to fill as few bins as it can: (number of bins, the lengths in each), from counts by length.

    Lengths above a third of the capacity come first, two at most in a bin: the largest one left
    takes the largest partner that fits. The others, longest first, go into the smallest gap that
    holds them, and open bins where there is none. Bins filled alike are one entry, so the work and
    the result depend on the number of distinct lengths and not on the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c}
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    groups: dict[int, list[tuple[int, list[int]]]] = {}  # by gap
    for n in large:
        while left[n]:
            partner = next((m for m in large if n + m <= capacity and left[m] > (m == n)), None)
            if partner is None:
                bins, filled = left[n], [n]
            elif partner == n:
                bins, filled = left[n] // 2, [n, n]
            else:
                bins, filled = min(left[n], left[partner]), [n, partner]
            for m in filled:
                left[m] -= bins
            groups.setdefault(capacity - sum(filled), []).append((bins, filled))
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[n]
        while todo:
            gap = min((g for g in groups if g >= n), default=None)
            if gap is None:
                each = capacity // n
                bins, rest = divmod(todo, each)
                for b, k in ((bins, each), (1, rest)):
                    if b and k:
                        groups.setdefault(capacity - k * n, []).append((b, [n] * k))
                break
            bins, filled = groups[gap].pop()
            if not groups[gap]:
                del groups[gap]
            # as many into each bin as fit: the gap left by one is again the smallest that holds the next
            each = min(gap // n, max(1, todo // bins)) if todo >= bins else min(gap // n, todo)
            used = min(bins, todo // each)
            groups.setdefault(gap - each * n, []).append((used, filled + [n] * each))
            if used < bins:
                groups.setdefault(gap, []).append((bins - used, filled))
            todo -= used * each
    return [g for gap in sorted(groups) for g in groups[gap]]


class _Slots:
    """For each length, which run of its pieces goes to which bins at which place."""

    def __init__(self, plan: list[tuple[int, list[int]]]):
        used: dict[int, int] = {}
        rows: dict[int, list[tuple[int, int, int]]] = {}
        first = 0
        for bins, filled in plan:
            offset = 0
            for n in filled:
                rank = used.get(n, 0)
                rows.setdefault(n, []).append((rank, first, offset))
                used[n] = rank + bins
                offset += n
            first += bins
        self.by_length = {n: np.array(x, np.int64) for n, x in rows.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length):
            own = np.flatnonzero(length == n)
            slots = self.by_length[int(n)]
            k = np.searchsorted(slots[:, 0], rank[own], side="right") - 1
            sequence[own] = slots[k, 1] + rank[own] - slots[k, 0]
            offset[own] = slots[k, 2]
        return sequence, offset


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """``pieces`` (any columns, with length from 1 to ``capacity``) with sequence_id and offset.

    The pieces are written once, each with its task and its number among the task's pieces of its
    length. Counts by task and length tell where each task's numbers begin; a piece's number among
    all of its length is its place in the plan, so pieces are placed where they are read, without a
    shuffle. The firsts go to every task while they are at most ``HELD_FIRSTS`` rows, else they are
    joined. Only the counts by length (``capacity`` rows) reach the driver, and only the plan made of
    them goes back. Equal rows take any of the places that they share; an empty table gives an empty
    result.
    """
    spark = pieces.sparkSession
    names, kinds = [c for c in pieces.columns if c not in NUMBERED], {f.name: f.dataType.simpleString() for f in pieces.schema}
    declared = ", ".join(f"`{n}` {kinds[n]}" for n in names)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(capacity)
        for b in batches:
            yield numbers.added(b)

    if not set(NUMBERED) <= set(pieces.columns):
        pieces = pieces.mapInArrow(number, f"{declared}, __task int, __number bigint")
    written, _ = write_table(pieces)
    sizes = written.groupBy("length", "__task").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    firsts, found = write_table(sizes.withColumn("__first", F.coalesce(before, F.lit(0))), n=F.count(F.lit(1)))
    counts = {r["length"]: r["n"] for r in firsts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"a piece's length must be from 1 to {capacity}")
    slots = _Slots(plan_bins(counts, capacity))
    if found["n"] <= HELD_FIRSTS:
        held = firsts.select((F.col("__task").cast("bigint") * (capacity + 1) + F.col("length")).alias("at"), "__first").orderBy("at").toArrow()
        sent = spark.sparkContext.broadcast((slots, held["at"].to_numpy(), held["__first"].to_numpy()))
    else:
        written = written.join(firsts.select("length", "__task", "__first"), ["length", "__task"])
        sent = spark.sparkContext.broadcast((slots, None, None))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, at, first = sent.value
        for b in batches:
            length, task = b.column("length").to_numpy().astype(np.int64), b.column("__task").to_numpy().astype(np.int64)
            begins = b.column("__first").to_numpy() if at is None else first[np.searchsorted(at, task * (capacity + 1) + length)]
            sequence, offset = slots.place(length, begins + b.column("__number").to_numpy())
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return written.mapInArrow(place, f"{declared}, sequence_id bigint, offset bigint")
