"""Seeds of repeats: grams that every long enough string selects from itself, and the texts that share them.

A string of ``length`` units (words or bytes) selects, of the grams inside it, the one that a fixed
order puts first. Equal strings select equal grams, so two texts can share such a string only if
they share a selected gram, an anchor; and there are far fewer anchors than strings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import mix, slices, texts_of

#: Entries that a task resolves among themselves before it sends any of them on.
CHUNK = 1_500_000
_NULL_ID = -(1 << 63)


def _begins(x: np.ndarray) -> np.ndarray:
    """Where a run of equal entries begins."""
    return np.concatenate(([True], x[1:] != x[:-1]))[: len(x)]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key (the id, nulls as the smallest number), two hashes of the text, doc_id and text (never null)."""
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(
        F.coalesce(docs[id_col].cast("bigint"), F.lit(_NULL_ID)).alias("key"),
        F.xxhash64(text).alias("th"),
        F.xxhash64(F.lit(7), text).alias("th2"),
        docs[id_col].alias("doc_id"),
        text.alias("text"),
    )


def later_copies(rows: DataFrame) -> DataFrame:
    """key and th of the texts that equal a whole text of a smaller key."""
    small = rows.select("key", "th", "th2")
    first = small.groupBy("th", "th2").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return small.join(first.drop("n"), ["th", "th2"]).where("key > first").select("key", "th").distinct()


def sharing(
    rows: DataFrame,
    anchors: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]],
    inside: bool,
    by: str,
    chunk: int = CHUNK,
) -> DataFrame:
    """For each text the anchors (place, h) that another text, or with ``inside`` the same one again, has too.

    ``by`` names the column that stands for a text, key or th. Rows with one text count as several,
    so a text's own copies make all its anchors shared; rows with one key have theirs together.

    ``anchors`` gives the anchors' hashes, the text of each, and its place. What meets inside a task's chunk is
    settled there and sends one row per anchor on, so an anchor that a third of all texts share is a
    row per chunk and not per text.
    """

    def settle(h: np.ndarray, owner: np.ndarray, place: np.ndarray, text: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((owner, h))
        h, owner, place = h[order], owner[order], place[order]
        first = _begins(h)
        if not inside:
            keep = first | _begins(owner)
            h, owner, place, first = h[keep], owner[keep], place[keep], first[keep]
        last = np.concatenate((first[1:], [True]))[: len(h)]
        sure = ~(first & last)
        # the first of a group stands for it elsewhere; the others are settled and go anywhere
        at = np.where(first, h, mix(h ^ (np.arange(len(h), dtype=np.uint64) << np.uint64(20))))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(at.view(np.int64)),
                pa.array(h.view(np.int64)),
                pa.array(text[owner]),
                pa.array(place.astype(np.int32)),
                pa.array(np.where(sure, np.where(first, 1, 2), 0).astype(np.int8)),
            ],
            names=["at", "h", by, "place", "sure"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, texts = [], 0, 0
        for part in slices(batches):
            h, owner, place = anchors(texts_of(part))
            held.append((h, owner + texts, place, part.column(by).to_numpy()))
            size += len(h)
            texts += part.num_rows
            if size >= chunk:
                yield settle(*[np.concatenate(x) for x in zip(*held, strict=True)])
                held, size, texts = [], 0, 0
        if held:
            yield settle(*[np.concatenate(x) for x in zip(*held, strict=True)])

    sent = rows.select(by, "text").mapInArrow(run, f"at bigint, h bigint, {by} bigint, place int, sure tinyint")
    same = Window.partitionBy("at", F.col("sure") == 2)
    shared = sent.withColumn("n", F.count(F.lit(1)).over(same)).where("sure > 0 OR n > 1")
    return shared.groupBy(by).agg(F.collect_set(F.struct("place", "h")).alias("anchors"))


def asked_of(rows: DataFrame, shared: DataFrame, copies: DataFrame) -> DataFrame:
    """key, th and shared anchors of the texts that aren't later copies (which need no search)."""
    texts = rows.select("key", "th").distinct().join(copies.select("key", "th"), ["key", "th"], "left_anti")
    return texts.join(shared, "key").select("key", "th", F.col("anchors.h").alias("anchors"))


def firsts(rows: DataFrame) -> DataFrame:
    """Of rows (hash, key, th, start, n, sure) those that are ``sure`` or whose hash a smaller key has too."""
    same = Window.partitionBy("hash", "sure")
    return rows.withColumn("first", F.min("key").over(same)).where("sure OR key > first").drop("first")


def settle_windows(hashes: np.ndarray, key: np.ndarray, th: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Rows (hash, key, th, start, n, sure) of one chunk: sure where a smaller key in the chunk has the hash.

    Sure windows that follow one another in a text are one row of n. Of the text's hash 32 bits are
    kept: they only tell apart texts that share an id.
    """
    th = th & 0x7FFFFFFF
    order = np.lexsort((key, hashes))
    hashes, key, th, start = hashes[order], key[order], th[order], start[order]
    sure = key > key[_begins(hashes)][np.cumsum(_begins(hashes)) - 1]
    runs = np.flatnonzero(sure)
    runs = runs[np.lexsort((start[runs], th[runs], key[runs]))]
    alone = np.ones(len(runs), bool)
    alone[1:] = (key[runs][1:] != key[runs][:-1]) | (th[runs][1:] != th[runs][:-1]) | (start[runs][1:] > start[runs][:-1] + 1)
    begin = np.flatnonzero(alone)
    count = start[runs][np.append(begin[1:] - 1, len(runs) - 1)[: len(begin)]] - start[runs][begin] + 1
    rest, runs = np.flatnonzero(~sure), runs[begin]
    own = np.concatenate((rest, runs))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((hashes[rest], mix(hashes[runs] ^ mix(runs.astype(np.uint64))))).view(np.int64)),
            pa.array(key[own]),
            pa.array(th[own].astype(np.int32)),
            pa.array(start[own].astype(np.int32)),
            pa.array(np.concatenate((np.ones(len(rest)), count)).astype(np.int32)),
            pa.array(np.concatenate((np.zeros(len(rest), bool), np.ones(len(runs), bool)))),
        ],
        names=["hash", "key", "th", "start", "n", "sure"],
    )


def low_bits(th: str) -> Column:
    """The bits of a text's hash that ``settle_windows`` keeps."""
    return F.col(th).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def covered(first: np.ndarray, end: np.ndarray, size: int) -> list[dict]:
    """Maximal runs of places that the intervals cover, as first and end."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, end, -1)
    hit = np.concatenate(([False], np.cumsum(edge)[:size] > 0, [False]))
    turn = np.flatnonzero(hit[1:] != hit[:-1]).tolist()
    return [{"first": a, "end": b} for a, b in zip(turn[0::2], turn[1::2], strict=True)]
