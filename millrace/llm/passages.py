"""Substring dedup by anchors and window hashes: passages of words that an earlier document has too."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.anchors import CHUNK, asked_of, covered, firsts, keyed, later_copies, low_bits, settle_windows, sharing
from millrace.llm.common import hashed_grams, hashed_words, slices, texts_of, within

#: Words of the shortest passage that counts, and of the gram that seeds it.
PASSAGE, SEED = 13, 4


def seeds(texts: list[bytes], length: int, seed: int) -> tuple[np.ndarray, ...]:
    """Every window of ``length`` words with its anchor: window hash, anchor hash, text, first word, anchor's place.

    The anchor of a window is its gram of ``seed`` words with the smallest hash, of equal ones the
    rightmost.
    """
    words, starts, _, _ = hashed_words(texts, lower=False)
    at, owner = within(starts, length)
    grams = hashed_grams(words, seed)
    if not len(at):
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    best, place = grams[at], at.copy()
    for j in range(1, length - seed + 1):
        other = grams[at + j]
        better = other <= best
        best[better] = other[better]
        place[better] = at[better] + j
    return hashed_grams(words, length)[at], best, owner, at - starts[owner], place


def _anchors(length: int, seed: int):
    def of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, h, owner, _, place = seeds(texts, length, seed)
        new = np.concatenate(([True], place[1:] != place[:-1]))[: len(place)]
        return h[new], owner[new], np.zeros(int(new.sum()), np.int32)  # a repeated anchor counts once

    return of


def remove_passages(
    docs: DataFrame, length: int = PASSAGE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_words, removed_spans (maximal runs of removed words: first, end), kept_text.

    A passage of ``length`` words or more goes where a document with a smaller id has it too: texts
    are joined on their anchors, and the windows of ``length`` words that a shared anchor seeds are
    compared by their hashes; windows that overlap or adjoin make one span. Windows replace the extension of
    seeds: no match is extended beyond a window and no repeats with their partners are formed. So the
    cost of an anchor is in proportion to its occurrences and not to their pairs.

    kept_text has the words left, joined by one space. Null and empty texts have no words; texts
    shorter than ``length`` lose nothing; a null id is smaller than all others; rows that share an
    id are one document, so that none of them removes from another, repeated rows neither. Hashes
    have 64 bits. A very long text is a slice of its own and read whole. An empty table gives no rows;
    other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    copies = later_copies(rows).withColumn("whole", F.lit(True))
    shared = sharing(rows, _anchors(length, seed), inside=False, by="key")
    # the texts move once: both joins below read the same exchange
    dealt = rows.select("key", "th", "doc_id", "text").repartition("key", "th")
    asked = asked_of(rows, shared, copies)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in slices(batches):
            window, h, owner, start, _ = seeds(texts_of(part), length, seed)
            wanted = np.zeros(len(h), bool)
            edge = np.searchsorted(owner, np.arange(part.num_rows + 1))
            for k, mine in enumerate(part.column("anchors")):
                own = slice(edge[k], edge[k + 1])
                wanted[own] = np.isin(h[own], mine.values.to_numpy().view(np.uint64))
            owner = owner[wanted]
            key, th = part.column("key").to_numpy()[owner], part.column("th").to_numpy()[owner]
            held.append((window[wanted], key, th, start[wanted]))
            size += len(owner)
            if size >= CHUNK:
                yield settle_windows(*[np.concatenate(x) for x in zip(*held, strict=True)])
                held, size = [], 0
        if held:
            yield settle_windows(*[np.concatenate(x) for x in zip(*held, strict=True)])

    met = dealt.join(asked, ["key", "th"]).select("key", "th", "doc_id", "text", "anchors")
    found = firsts(met.mapInArrow(windows, "hash bigint, key bigint, th int, start int, n int, sure boolean"))
    runs = found.groupBy("key", F.col("th").alias("th32")).agg(F.collect_set(F.struct("start", "n")).alias("runs"))
    gone = rows.select("key", "th", low_bits("th").alias("th32")).distinct().join(copies, ["key", "th"], "left")
    gone = gone.join(runs, ["key", "th32"], "left").where("whole OR runs IS NOT NULL").drop("th32")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n_words, spans, kept = [], [], []
            runs, wholes = part.column("runs"), part.column("whole").to_pylist()
            for k, text in enumerate(texts_of(part)):
                words = text.split()
                mine: list[dict] = []
                if wholes[k] and len(words) >= length:
                    mine = [{"first": 0, "end": len(words)}]
                elif runs[k].is_valid:
                    start = runs[k].values.field("start").to_numpy()
                    mine = covered(start, start + runs[k].values.field("n").to_numpy() + length - 1, len(words))
                n_words.append(len(words))
                for s in reversed(mine):
                    del words[s["first"] : s["end"]]
                spans.append(mine)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "removed_spans", "kept_text"],
            )

    out = dealt.join(gone, ["key", "th"], "left").select("key", "th", "doc_id", "text", "runs", "whole")
    return out.mapInArrow(
        cut, f"doc_id {kind}, n_words bigint, removed_spans array<struct<first:bigint,end:bigint>>, kept_text string"
    )


def report(removed: DataFrame) -> DataFrame:
    n_removed = F.aggregate("removed_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"])
    return removed.select(
        "doc_id", "n_words", n_removed.alias("n_removed"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )
