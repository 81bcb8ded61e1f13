"""Periodic runs of words by a dictionary of basic factors."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import hashed_words, id_and_text, map_arrow, mix, texts_of

#: Words that a run has at least.
LEAST = 12
_INT = np.int64


def _begins(x: np.ndarray) -> np.ndarray:
    """Where a run of equal entries begins."""
    return np.concatenate(([True], x[1:] != x[:-1]))[: len(x)]


def _classes(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key occurs again, by key and place, and a name (1, 2, ...) for the key of each."""
    order = np.argsort(keys, kind="stable")
    first = _begins(keys[order])
    of = np.cumsum(first) - 1
    again = np.bincount(of, minlength=1)[of] > 1
    return places[order][again], np.cumsum(first[again])


def _progressions(places: np.ndarray, names: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Successor occurrences at most m / 2 apart as arithmetic progressions: first, last, step (1 if alone), name.

    Two occurrences of a factor of m words that are so close are one smallest period of it apart, so
    all steps of a progression, and of all progressions of a factor, are equal.
    """
    near = np.zeros(len(places), bool)
    near[1:] = (names[1:] == names[:-1]) & (2 * (places[1:] - places[:-1]) <= m)
    head = np.flatnonzero(~near)
    tail = np.append(head[1:], len(places)) - 1
    step = np.ones(len(head), _INT)
    many = tail > head
    step[many] = places[head[many] + 1] - places[head[many]]
    return places[head], places[tail], step, names[head]


def _proposals(places: np.ndarray, names: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """period, lo, hi: stretches lo <= t < hi in which words t and t + period agree, for periods from m to 2m - 1.

    Each period is a distance between members of two progressions of one factor. Of these at most
    three follow within 2m, as they are more than m / 2 apart.
    """
    first, last, step, name = _progressions(places, names, m)
    found = []
    for ahead in (1, 2, 3):
        x = np.arange(max(len(first) - ahead, 0))
        y = x + ahead
        least, most = first[y] - last[x], last[y] - first[x]
        good = (name[x] == name[y]) & (least < 2 * m) & (most >= m)
        x, y, least, most = x[good], y[good], least[good], most[good]
        by = np.maximum(step[x], step[y])
        least = least + np.maximum(0, -((least - m) // by)) * by  # the smallest distance from m on
        n = np.maximum(0, (np.minimum(most, 2 * m - 1) - least) // by + 1)
        pair = np.repeat(np.arange(len(x)), n)
        period = least[pair] + (np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)) * by[pair]
        x, y = x[pair], y[pair]
        found.append((period, np.maximum(first[x], first[y] - period), np.minimum(last[x], last[y] - period) + m))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


def _extended(period: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Touching and overlapping stretches of one period as one, to both sides as far as words agree."""
    order = np.lexsort((lo, period))
    period, lo, hi = period[order], lo[order], hi[order]
    if not len(period):
        return period, lo, hi
    apart = (np.cumsum(_begins(period)) - 1) * (int(hi.max()) + 2)
    reach = np.maximum.accumulate(hi + apart)
    new = np.concatenate(([True], lo[1:] + apart[1:] > reach[:-1]))
    at = np.flatnonzero(new)
    return period[at], lo[at], reach[np.append(at[1:], len(lo)) - 1] - apart[at]


def runs_of(words: np.ndarray, starts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start (a place in ``words``), length and smallest period of every run, by start, then period.

    ``words`` are the words' hashes, text i has those from ``starts[i]`` to ``starts[i + 1]``; no run
    leaves a text. The dictionary of basic factors names the stretches of 1, 2, 4, ... words that
    occur again in their text; a factor of 2m words is named by the names of its halves. A run of
    period p has the factor of m words, m <= p < 2m, that starts at a word also p words later, so
    the distances between a factor's occurrences within 2m propose all periods. All stretches of m
    agreeing words are proposed, so their union reaches as far as words agree. Of periods with the
    same run the smallest stays; a multiple of it has the same run whenever it has one.
    """
    n = len(words)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    stop = np.asarray(starts[1:], _INT)[owner]
    places, names = _classes(mix(words + mix(owner.astype(np.uint64) + np.uint64(1))), np.arange(n, dtype=_INT))
    found, m = [], 1
    while len(places):
        period, lo, hi = _extended(*_proposals(places, names, m))
        long = hi - lo + period >= np.maximum(least, 2 * period)
        found.append((lo[long], (hi - lo + period)[long], period[long]))
        name = np.zeros(n + 1, _INT)
        name[places] = names
        halves = np.sort(places)
        halves = halves[halves + 2 * m <= stop[halves]]
        halves = halves[name[halves + m] > 0]
        places, names = _classes(name[halves] * (int(names[-1]) + 1) + name[halves + m], halves)
        m *= 2
    if not found:
        return (np.empty(0, _INT),) * 3
    start, length, period = (np.concatenate(f) for f in zip(*found, strict=True))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    only = _begins(start) | _begins(length)
    start, length, period = start[only], length[only], period[only]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def find_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period) by start and period, and collapsed.

    Words are the runs of non-space bytes, numbered from 0. A run is a stretch of words with smallest
    period q (words q apart are equal) and a length of at least ``least`` and 2q that no
    neighbouring word extends. collapsed is the text without the words that some run contains after
    its first q words, the others joined by one space.

    Null and empty texts have no words, no runs and an empty collapsed text; a text of one word has
    no run. Runs that overlap or hold one another are all given; of two with the same words there is
    one, that of the smallest period. Repeated rows are found alike, each on its own; an empty table
    gives no rows. Other columns, whatever their names, are not read. A text is worked on whole,
    however long, in about 200 bytes a word; texts share no state, so a lost task costs its rows only.
    Words are told apart by 64-bit hashes.
    """
    found = id_and_text(docs, id_col, text_col)
    kind = found.schema["doc_id"].dataType.simpleString()

    def rows(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = texts_of(part)
        words, starts, _, _ = hashed_words(texts, lower=False)
        start, length, period = runs_of(words, starts, least)
        edge = np.zeros(len(words) + 1, _INT)
        np.add.at(edge, start + period, 1)
        np.add.at(edge, start + length, -1)
        kept = np.cumsum(edge)[:-1] == 0
        whole = np.concatenate(([0], np.cumsum(~kept)))
        collapsed = []
        for text, a, b in zip(texts, starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            own = text.split()
            collapsed.append(b" ".join(own if whole[a] == whole[b] else compress(own, kept[a:b])))
        ends = np.searchsorted(start, starts).astype(np.int32)
        own = np.asarray(starts, _INT)[np.searchsorted(ends, np.arange(len(start)), side="right") - 1]
        runs = pa.StructArray.from_arrays([pa.array(start - own), pa.array(length), pa.array(period)], names=["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array(np.diff(starts).astype(_INT)),
                pa.ListArray.from_arrays(pa.array(ends), runs),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    run = "struct<start:bigint,length:bigint,period:bigint>"
    return map_arrow(found, rows, f"doc_id {kind}, n_words bigint, runs array<{run}>, collapsed string")


def report(found: DataFrame) -> DataFrame:
    """Counts, the longest run (of equal ones the first, then that of the smallest period) and digests."""
    ordered = F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = found.select("doc_id", "runs", "collapsed", F.array_max(ordered).alias("best"))
    length, start, period = F.col("best.length"), -F.col("best.start"), -F.col("best.period")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def periodic_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text; in a tenth of the rows (h % 10 = 0, h the crc32 of the id as text, a null id is empty) a tail repeats.

    There, with n words and g = h // 10, each word i from a = g % n on is the original's word
    a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8), and words are joined by one space.
    """
    found = id_and_text(docs, id_col, text_col)
    kind = found.schema["doc_id"].dataType.simpleString()

    def edited(doc_id, text: bytes | None) -> bytes | None:
        h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        if h % 10 or not text:
            return text
        words, g = text.split(), h // 10
        n = len(words)
        if not n:
            return text
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        tail = words[a : a + p]
        return b" ".join(words[:a] + (tail * ((n - a) // p + 1))[: n - a])

    def rows(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [edited(i, t) for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    return map_arrow(found, rows, f"doc_id {kind}, text string")
