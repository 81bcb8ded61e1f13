"""Byte-exact substring dedup: an enhanced suffix array of the anchors and its common-prefix intervals.

Every string of ``length`` bytes selects an anchor from itself, so a repeat of that length puts two
suffixes that start with one anchor next to each other. The suffix array therefore holds suffixes
that start at anchors only, and one bucket of it, all suffixes of one anchor, is scanned at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.anchors import asked_of, covered, keyed, later_copies, sharing
from millrace.llm.common import mix, slices, texts_of
from millrace.sources.scratch import write_table

#: Bytes of the shortest repeat, and of the gram that is its anchor.
LENGTH, GRAM = 100, 32
#: Bytes of one text that are searched for anchors at a time.
_PIECE = 4 << 20
#: Suffixes that a task gathers before it sends them on.
_CHUNK = 100_000
#: Occurrences of one anchor from which on its strings are dealt by their own hashes and not by the anchor's.
HOT_BUCKET = 20_000
#: Surroundings of such anchors whose strings a task settles among themselves at a time.
_HOT_CHUNK = 20_000

_BASE = 0x9E3779B97F4A7C15


def byte_anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of all texts: hash, text and place; of ``length - gram + 1`` grams the smallest hash, of equal ones the rightmost."""
    wide = length - gram + 1
    out = []
    for t, text in enumerate(texts):
        for begin in range(0, len(text) - length + 1, _PIECE):
            raw = np.frombuffer(text[begin : begin + _PIECE + length - 1], np.uint8)
            h = _rolled(raw, gram)
            n = len(h)
            low = h >> np.uint64(24) << np.uint64(24) | np.uint64(0xFFFFFF) - np.arange(n, dtype=np.uint64)
            size = 1
            while size * 2 <= wide:
                low = np.minimum(low[:-size], low[size:])
                size *= 2
            if size < wide:
                low = np.minimum(low[: len(low) - (wide - size)], low[wide - size :])
            low = low[np.concatenate(([True], low[1:] != low[:-1]))]
            place = (np.uint64(0xFFFFFF) - (low & np.uint64(0xFFFFFF))).astype(np.int64)
            out.append((h[place], np.full(len(place), t, np.int64), place + begin))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _rolled(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all grams: the polynomial hash of a length is put together from those of powers of two."""
    power, size, h = _BASE, 1, raw.astype(np.uint64) + np.uint64(1)
    total, done = None, 0
    while True:
        if gram & size:
            if total is None:
                total = h
            else:
                n = min(len(total) - size, len(h) - 0) if len(total) > size else 0
                total = h[:n] * np.uint64(pow(_BASE, done, 1 << 64)) + total[size : size + n]
            done += size
        if size * 2 > gram:
            return mix(total[: len(raw) - gram + 1])
        h = h[:-size] * np.uint64(power) + h[size:]
        size, power = size * 2, power * power % (1 << 64)


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is common, a[:high] isn't
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """The nodes of the common-prefix interval tree: (depth, first, last) from a scan with a stack.

    ``lcp[i]`` is the common prefix of entries i - 1 and i (``lcp[0]`` is ignored); nodes under
    ``least`` are left out. An interval is maximal: its neighbours share less than its depth.
    """
    stack = [(-1, 0)]  # depth, first
    for i in range(1, len(lcp) + 1):
        depth, first = (lcp[i] if i < len(lcp) else -1), i - 1
        while stack[-1][0] > depth:
            d, first = stack.pop()
            if d >= least:
                yield d, first, i - 1
        if stack[-1][0] < depth:
            stack.append((depth, first))


def maximal_repeats(right: list[bytes], left: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """Repeats of one bucket: (bytes before the anchor, bytes from it on, entries), of ``length`` bytes together at least.

    ``right`` are the suffixes in order, ``left`` the bytes in front of them, reversed. Entries of an
    interval share its depth to the right; among them the intervals of the reversed left sides are
    those that share as much to the left, and what lies in front of these differs (or ends). A group
    is kept if its entries also part to the right at this depth, otherwise a deeper interval has it.
    """
    n = len(right)
    lcp = [0] + [common(right[i - 1], right[i]) for i in range(1, n)]
    for depth, lo, hi in intervals(lcp, 1):
        least = max(length - depth, 0)
        if hi - lo == 1:
            e = common(left[lo], left[hi])
            if e >= least:
                yield e, depth, [lo, hi]
            continue
        own = sorted(range(lo, hi + 1), key=lambda i: left[i])
        lce = [0] + [common(left[own[i - 1]], left[own[i]]) for i in range(1, len(own))]
        for e, first, last in intervals(lce, least):
            group = own[first : last + 1]
            a, b = min(group), max(group)
            if min(lcp[a + 1 : b + 1]) == depth:
                yield e, depth, group


def _joined(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The maximal runs that the spans cover."""
    spans.sort()
    first, end = spans[0]
    for a, b in spans[1:]:
        if a > end:
            yield first, end
            first, end = a, b
        else:
            end = max(end, b)
    yield first, end


REPEATS = "repeat bigint, length int, key bigint, th bigint, start bigint, first boolean"
#: Members of groups: the place of the anchor, and the bytes of the repeat in front of it.
MEMBERS = "repeat bigint, length int, key bigint, th bigint, at bigint, before int"
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def _names(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*[x.split() for x in schema.split(", ")], strict=True)
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), _KINDS[k]) for c, k in zip(columns, kinds, strict=True)], names=list(names))


def _name(string: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(string) - (1 << 63)


def _strings(around: list[tuple[bytes, int, int, int]], length: int) -> tuple[np.ndarray, ...]:
    """All strings of ``length`` bytes of the surroundings (bytes, key, th, first place): two hashes, key, th, start and whether it is the first of equals.

    A string that two anchors of one text reach is one.
    """
    from xxhash import xxh128_digest

    n = np.array([len(whole) - length + 1 for whole, *_ in around], np.int64)
    digests = b"".join(xxh128_digest(whole[p : p + length]) for whole, *_ in around for p in range(len(whole) - length + 1))
    high, low = np.frombuffer(digests, np.int64).reshape(-1, 2).T
    key, th, first = (np.repeat(np.array([x[c] for x in around], np.int64), n) for c in (1, 2, 3))
    start = first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
    order = np.lexsort((start, th, key, low, high))
    rows = np.stack([high, low, key, th, start])[:, order]
    other = np.ones(rows.shape, bool)
    other[:, 1:] = rows[:, 1:] != rows[:, :-1]
    begins, keep = other[:2].any(axis=0), other.any(axis=0)
    return (*rows[:, keep], begins[keep])


def _suffixes(dealt: DataFrame, asked: DataFrame, length: int, gram: int, frequent: np.ndarray, groups_of: bool = False) -> DataFrame:
    """The suffixes at the anchors that are asked for: h, right, left, key, th, at and sure.

    Surroundings that return in a chunk are settled: the span that the later ones cover is a row
    with its length in ``sure``, and the hash spread. Of ``frequent`` anchors all strings of
    ``length`` bytes are rows of their own (``sure`` -1; h and right are the string's two hashes),
    likewise settled, so that no bucket has more of them than there are chunks. With ``groups_of`` a
    first one with settled copies has ``sure`` -2, and each copy is a row of ``sure`` -3: its own at, key and th
    in h, right and left (the latter two written out), those of the first one in key, th and at.
    """
    reach = length - gram  # bytes before an anchor
    sent = dealt.sparkSession.sparkContext.broadcast(frequent)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = set(sent.value.tolist())
        held: dict[tuple, list[tuple]] = {}
        size = 0
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        names = ["h", "right", "left", "key", "th", "at", "sure"]

        def out() -> Iterator[pa.RecordBatch]:
            columns: dict[str, list] = {c: [] for c in names}
            again: dict[tuple[int, int], list[tuple[int, int]]] = {}  # by text: where earlier surroundings return
            hot: list[tuple[bytes, int, int, int]] = []
            for (h, right, left), places in held.items():
                places = sorted(set(places))  # equal rows are one text
                key, th, at = places[0]
                if h in often:
                    hot.append((left[::-1] + right, key, th, at - len(left)))
                else:
                    for c, v in zip(columns, (h, right, left, key, th, at, -2 if groups_of and len(places) > 1 else 0), strict=True):
                        columns[c].append(v)
                for own in places[1:] if groups_of else []:
                    for c, v in zip(columns, (own[2], b"%d" % own[0], b"%d" % own[1], *places[0], -3), strict=True):
                        columns[c].append(v)
                for key, th, at in places[1:]:
                    again.setdefault((key, th), []).append((at - len(left), at + len(right)))
            for i in range(0, len(hot), _HOT_CHUNK):
                high, low, key, th, start, first = _strings(hot[i : i + _HOT_CHUNK], length)
                for k, t, x in zip(key[~first].tolist(), th[~first].tolist(), start[~first].tolist(), strict=True):
                    again.setdefault((k, t), []).append((x, x + length))
                n = int(first.sum())
                second = pa.Array.from_buffers(pa.binary(8), n, [None, pa.py_buffer(low[first].tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(high[first]),
                        second,
                        pa.nulls(n, pa.binary()),
                        *[pa.array(x[first]) for x in (key, th, start)],
                        pa.array(np.full(n, -1, np.int32)),
                    ],
                    names=names,
                )
            for (key, th), spans in again.items():
                for first, end in _joined(spans):
                    spread = int(mix(np.array([th ^ first], np.int64).view(np.uint64)).view(np.int64)[0])
                    for c, v in zip(columns, (spread, None, None, key, th, first, end - first), strict=True):
                        columns[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns.values(), kinds, strict=True)], names=names)

        for part in slices(batches):
            texts = texts_of(part)
            h, owner, place = byte_anchors(texts, length, gram)
            edge = np.searchsorted(owner, np.arange(part.num_rows + 1))
            keys, ths = part.column("key").to_pylist(), part.column("th").to_pylist()
            for k, mine in enumerate(part.column("anchors")):
                text = texts[k]
                own = slice(edge[k], edge[k + 1])
                hit = np.isin(h[own], mine.values.to_numpy().view(np.uint64))
                for x, at in zip(h[own][hit].view(np.int64).tolist(), place[own][hit].tolist(), strict=True):
                    around = (x, text[at : at + length], text[max(at - reach, 0) : at][::-1])
                    held.setdefault(around, []).append((keys[k], ths[k], at))
                size += int(hit.sum())
            if size >= _CHUNK:
                yield from out()
                held.clear()
                size = 0
        if held:
            yield from out()

    met = dealt.join(asked, ["key", "th"]).select("key", "th", "doc_id", "text", "anchors")
    return met.mapInArrow(suffixes, "h bigint, right binary, left binary, key bigint, th bigint, at bigint, sure int")


def _searched(found: DataFrame, length: int, groups_of: bool) -> DataFrame:
    """Members of repeats (MEMBERS), or (not ``groups_of``) per text and bucket the span that those have of which an earlier one exists."""
    schema = MEMBERS if groups_of else REPEATS
    keep = "n > 1 OR sure = -2" if groups_of else "n > 1 OR sure > 0"
    bucket = Window.partitionBy("h")
    # a suffix alone in its bucket repeats nothing; the order makes each bucket a stretch of the suffix array
    array = (
        found.withColumn("n", F.count(F.lit(1)).over(bucket)).where(keep).sortWithinPartitions("h", "right", "left", "key", "th", "at", "sure")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        bucket: list[tuple] = []
        string: tuple = ()  # the last row of a string of its own that is the first of its equals

        def grouped() -> Iterator[tuple[int, int, list[int]]]:
            right, left = [b[1] for b in bucket], [b[2] for b in bucket]
            return maximal_repeats(right, left, length)

        def name_all() -> None:
            if len(bucket) < 2:
                return
            right, left = [b[1] for b in bucket], [b[2] for b in bucket]
            for e, l, group in grouped():
                name = _name(left[group[0]][:e][::-1] + right[group[0]][:l])
                rows.extend((name, e + l, *place, e) for place in {bucket[i][3:6] for i in group})

        def cover() -> None:
            if len(bucket) < 2:
                return
            widest: dict[int, tuple[int, int]] = {}
            for e, l, group in grouped():
                first = min(bucket[i][3:6] for i in group)
                for i in group:
                    if bucket[i][3:6] != first:
                        old = widest.get(i, (0, 0))
                        widest[i] = max(old[0], e), max(old[1], l)
            # all spans of one occurrence hold its anchor, so together they are one span
            rows.extend((0, e + l, bucket[i][3], bucket[i][4], bucket[i][5] - e, False) for i, (e, l) in widest.items())

        settle = name_all if groups_of else cover
        for b in batches:
            for row in zip(*[b.column(c).to_pylist() for c in ("h", "right", "left", "key", "th", "at", "sure")], strict=True):
                if row[6] > 0:  # the same surroundings or string stand earlier in its chunk
                    rows.append((0, row[6], row[3], row[4], row[5], False))
                    continue
                if row[6] == -1:
                    if string[:2] != row[:2]:
                        string = row
                    elif string[3:6] != row[3:6]:
                        rows.append((0, length, row[3], row[4], row[5], False))
                    continue
                if bucket and bucket[0][0] != row[0]:
                    settle()
                    bucket = []
                bucket.append(row)
                if row[6] == -2:  # its settled copies make a group with it, also if it is alone
                    bucket.append(row)
            if len(rows) > 50_000:
                yield _names(rows, schema)
                rows = []
        settle()
        yield _names(rows, schema)

    return array.select("h", "right", "left", "key", "th", "at", "sure").mapInArrow(scan, schema)


def _shared(rows: DataFrame, length: int, gram: int, hot: int = 0) -> DataFrame:
    """Per key the shared anchors; in place of its place each has how often it came before in its text, ``hot`` at most."""

    def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, owner, _ = byte_anchors(texts, length, gram)
        order = np.lexsort((h, owner))
        begins = np.ones(len(h), bool)
        begins[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        at = np.arange(len(h))
        before = np.empty(len(h), np.int64)
        before[order] = at - np.maximum.accumulate(np.where(begins, at, 0))
        return h, owner, np.minimum(before, hot)

    return sharing(rows, anchors, inside=True, by="key")


def _frequent(shared: DataFrame, hot: int) -> np.ndarray:
    """The anchors with more than ``hot`` occurrences; as each has so many, they are few."""
    often = shared.select(F.explode("anchors.h").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot)
    return np.array([r["h"] for r in often.select("h").collect()], np.int64)


def find_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The maximal repeat groups with their occurrences: repeat (a hash of the string), length, key, th, start and first.

    key is the id (nulls as the smallest number), th a hash of the text, start a place in bytes,
    first the earliest occurrence of the group. Strings reach ``length - gram`` bytes before and
    ``length`` from their anchor; a longer repeat is several of them, which overlap. Groups have all
    their occurrences, however the rows are dealt to tasks. A bucket (the different surroundings of
    one anchor, once per chunk) is held by one task, whatever its size.

    Null and empty texts, and those shorter than ``length``, have no repeats. Rows that repeat are one
    text; rows that share an id and differ are told apart by th. A very long text is cut at its
    anchors like any other. An empty table gives no rows; other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    everywhere = rows.select("key", "th").distinct()
    asked = everywhere.join(_shared(rows, length, gram), "key").select("key", "th", F.col("anchors.h").alias("anchors"))
    dealt = rows.select("key", "th", "doc_id", "text").repartition("key", "th")
    # written: chunks may differ if computed again, and copies refer to the first of their chunk
    found, _ = write_table(_suffixes(dealt, asked, length, gram, np.empty(0, np.int64), groups_of=True))
    members, _ = write_table(_searched(found.where("sure IN (0, -2)"), length, groups_of=True))
    copies = found.where("sure = -3").select(
        "key",
        "th",
        "at",
        F.col("right").cast("string").cast("bigint").alias("own_key"),
        F.col("left").cast("string").cast("bigint").alias("own_th"),
        F.col("h").alias("own_at"),
    )
    start = (F.col("at") - F.col("before")).alias("start")
    of_copies = members.join(copies, ["key", "th", "at"])
    of_copies = of_copies.select("repeat", "length", F.col("own_key").alias("key"), F.col("own_th").alias("th"), (F.col("own_at") - F.col("before")).alias("start"))
    # several anchors of one string find its occurrences
    whole, _ = write_table(members.select("repeat", "length", "key", "th", start).union(of_copies).distinct())
    place = F.struct("key", "th", "start")
    first = whole.groupBy("repeat", "length").agg(F.min(place).alias("least"))
    return whole.join(first, ["repeat", "length"]).select(
        "repeat", "length", "key", "th", "start", (place == F.col("least")).alias("first")
    )


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    hot: int = HOT_BUCKET,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_bytes, removed_spans (maximal runs of removed bytes: first, end) and kept (the other bytes).

    A byte goes if a string of ``length`` bytes around it also starts earlier: in a document with a
    smaller id, or in its own at a smaller place. Texts are UTF-8 bytes, null is empty, matches stay
    inside a document; a null id is the smallest. Rows that share an id are ordered by their text's
    hash; equal rows don't remove from each other. Texts shorter than ``length``, empty ones too, lose
    nothing; a very long text is a slice of its own and read whole. An empty table gives no rows;
    other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    copies = later_copies(rows).withColumn("whole", F.lit(True))
    shared, _ = write_table(_shared(rows, length, gram, hot))
    # the texts move once: both joins read the same exchange
    dealt = rows.select("key", "th", "doc_id", "text").repartition("key", "th")
    asked = asked_of(rows, shared, copies)
    found = _searched(_suffixes(dealt, asked, length, gram, _frequent(shared, hot)), length, groups_of=False)
    gone = found.groupBy("key", "th").agg(F.collect_set(F.struct("start", "length")).alias("spans"))
    gone = gone.join(copies, ["key", "th"], "full")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sizes, runs, kept = [], [], []
            spans, wholes = part.column("spans"), part.column("whole").to_pylist()
            for k, text in enumerate(texts_of(part)):
                n = len(text)
                mine: list[dict] = []
                if wholes[k] and n >= length:
                    mine = [{"first": 0, "end": n}]
                    rest = b""
                elif spans[k].is_valid:
                    start = spans[k].values.field("start").to_numpy()
                    mine = covered(start, start + spans[k].values.field("length").to_numpy(), n)
                    at = [0, *[x for s in mine for x in (s["first"], s["end"])], n]
                    rest = b"".join(text[a:b] for a, b in zip(at[0::2], at[1::2], strict=True))
                else:
                    rest = text
                sizes.append(n)
                runs.append(mine)
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(runs, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "removed_spans", "kept"],
            )

    out = dealt.join(gone, ["key", "th"], "left").select("key", "th", "doc_id", "text", "spans", "whole")
    return out.mapInArrow(cut, f"doc_id {kind}, n_bytes bigint, removed_spans array<struct<first:bigint,end:bigint>>, kept binary")


def report(removed: DataFrame) -> DataFrame:
    n_removed = F.aggregate("removed_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"])
    return removed.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed_spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
