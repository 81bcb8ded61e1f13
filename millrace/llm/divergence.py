"""Source divergence audit: term stripes folded inside the mappers, merged by key, turned into divergences."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, slices, texts_of
from millrace.sources.scratch import write_table

#: Documents of a language that hold a kept term, at least, and terms reported per group.
MIN_DOCS, TOP = 10, 10
#: Entries (term and source, or term) that a mapper folds before it spills its stripes.
HELD = 600_000
#: Bytes of one text whose terms are in memory at a time (a single longer term is held whole).
PIECE = 4 << 20
#: Groups of one block: a pass over the stripes compares the groups of two blocks.
BLOCK = 1_000
#: Cells (term and group) that a task holds as a matrix.
CELLS = 1 << 20
_TERM, _GAP = re.compile(rb"[A-Za-z\x80-\xff]+"), re.compile(rb"[^A-Za-z\x80-\xff]")
STRIPE = "lang string, term string, df bigint, sources array<string>, counts array<bigint>"
_NAMES = [c.split()[0] for c in STRIPE.split(", ")]


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order: runs of letters and of bytes beyond ASCII, A-Z lower-cased."""
    text, a = text.translate(LOWER), 0
    while a < len(text):
        gap = _GAP.search(text, a + PIECE) if a + PIECE < len(text) else None
        b = gap.start() if gap else len(text)
        yield _TERM.findall(text, a, b)
        a = b


class _Stripes:
    """What a mapper has folded: per language the terms' document frequencies, per language and source the terms' counts."""

    def __init__(self):
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
        self.held = 0

    def fold(self, lang: str, source: str, text: bytes) -> None:
        docs, counts = self.docs[lang], self.counts[lang][source]
        before, seen = len(docs) + len(counts), set()
        for terms in terms_of(text):
            counts.update(terms)
            seen.update(terms)
        docs.update(seen)
        self.held += len(docs) + len(counts) - before

    def spilled(self) -> Iterator[pa.RecordBatch]:
        """A row per language and term: df, and the sources with their counts."""
        for lang, docs in self.docs.items():
            if not docs:
                continue
            at = {term: i for i, term in enumerate(docs)}
            own = self.counts[lang]
            term = np.concatenate([np.fromiter(map(at.__getitem__, c), np.int64, len(c)) for c in own.values()])
            source = np.repeat(np.arange(len(own), dtype=np.int32), [len(c) for c in own.values()])
            n = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in own.values()])
            order = np.argsort(term, kind="stable")
            ends = np.searchsorted(term[order], np.arange(len(at) + 1))
            names = pa.array(list(own), pa.string())
            yield _batch(
                pa.array([lang] * len(at), pa.string()),
                pa.array(list(at), pa.binary()).cast(pa.string()),
                np.fromiter(docs.values(), np.int64, len(docs)),
                ends,
                names.take(pa.array(source[order])),
                n[order],
            )
        self.__init__()


def _batch(lang: pa.Array, term: pa.Array, df: np.ndarray, ends: np.ndarray, sources: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    ends = pa.array(ends.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [lang, term, pa.array(df), pa.ListArray.from_arrays(ends, sources), pa.ListArray.from_arrays(ends, pa.array(counts))], names=_NAMES
    )


def _fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Stripes()
    for part in slices(batches):
        for lang, source, text in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), texts_of(part), strict=True):
            held.fold(lang, source, text)
            if held.held >= HELD:
                yield from held.spilled()
    yield from held.spilled()


def _merged(part: pa.RecordBatch) -> pa.RecordBatch:
    """Neighbouring stripes of one term as one."""
    n = part.num_rows
    lang, term = part.column("lang"), part.column("term")
    new = np.ones(n, bool)
    new[1:] = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    sizes = np.diff(part.column("counts").offsets.to_numpy())
    owner = np.repeat(np.cumsum(new) - 1, sizes)
    sources = part.column("sources").flatten().dictionary_encode()
    cells, of = np.unique(owner * max(1, len(sources.dictionary)) + sources.indices.to_numpy(), return_inverse=True)
    counts = np.zeros(len(cells), np.int64)
    np.add.at(counts, of, part.column("counts").flatten().to_numpy())
    owner, source = np.divmod(cells, max(1, len(sources.dictionary)))
    return _batch(
        lang.take(pa.array(first)),
        term.take(pa.array(first)),
        np.add.reduceat(part.column("df").to_numpy(), first),
        np.searchsorted(owner, np.arange(len(first) + 1)),
        sources.dictionary.take(pa.array(source)),
        counts,
    )


def _merge(min_docs: int):
    """Stripes in the order of their terms, folded to one per term; those of ``min_docs`` documents are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed(part: pa.RecordBatch) -> pa.RecordBatch:
            return part.filter(pc.greater_equal(part.column("df"), min_docs))

        open_ = None  # the last term, folded so far: it may go on in the next batch
        for part in batches:
            if not part.num_rows:
                continue
            if open_ is not None:
                part = pa.concat_batches([open_, part.cast(open_.schema)])
            part = _merged(part)
            yield passed(part.slice(0, part.num_rows - 1))
            open_ = part.slice(part.num_rows - 1)
        if open_ is not None:
            yield passed(open_)

    return run


def stripes(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """A row per language and term that ``min_docs`` documents of the language hold: df, sources and their counts.

    ``docs`` has lang, source and text without nulls. Each mapper folds whole documents into stripes
    and spills them when it holds ``HELD`` entries, so a term comes as one row per spill however
    often it occurs; the rows of a term meet sorted, and are folded as a stream.
    """
    folded = docs.select("lang", "source", "text").mapInArrow(_fold, STRIPE)
    return folded.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(_merge(min_docs), STRIPE)


def share(count: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / (total + 2 * kept)), exact for totals below 9 * 10^15 (long division by thousands)."""
    whole = np.asarray(total + 2 * kept, np.int64)
    p, rest = np.divmod(count + 2, whole)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        p = p * 1000 + digits
    return p + 1


def likeness(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class _Language:
    """The groups of one language in a pass, and what the stripes seen so far add up to."""

    def __init__(self, rows: list, own: int, other: int):
        rows = sorted(rows, key=lambda r: (r["block"] != own, r["source"].encode()))
        self.sources = [r["source"] for r in rows]
        self.at = {s: i for i, s in enumerate(self.sources)}
        self.total = np.array([r["n"] for r in rows], np.int64)
        self.kept, self.all = rows[0]["kept"], rows[0]["n_lang"]
        self.own = sum(r["block"] == own for r in rows)
        self.inside = own == other
        self.sums = np.zeros((self.own, len(rows)), np.int64)
        self.best: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

    def add(self, part: pa.RecordBatch) -> None:
        """Stripes of this language: divergences of the pairs of groups, and of each own group from the language."""
        sizes = np.diff(part.column("counts").offsets.to_numpy())
        counts = part.column("counts").flatten().to_numpy()
        coded = part.column("sources").flatten().dictionary_encode()
        place = np.array([self.at.get(s, -1) for s in coded.dictionary.to_pylist()], np.int64)
        column = place[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.int64)
        row = np.repeat(np.arange(part.num_rows), sizes)
        table = np.zeros((part.num_rows, len(self.sources)), np.int64)
        table[row[column >= 0], column[column >= 0]] = counts[column >= 0]
        p = share(table, self.total, self.kept)
        for s in range(self.own):  # each pair once
            others = slice(s + 1 if self.inside else self.own, None)
            self.sums[s, others] += likeness(p[:, s, None], p[:, others]).sum(axis=0)
        if not self.inside:
            return
        whole = np.zeros(part.num_rows, np.int64)
        np.add.at(whole, row, counts)
        q = share(whole, self.all, self.kept)
        at, of = np.nonzero((table > 0) & (p > q[:, None]))
        self.best.append(_top(of, likeness(p[at, of], q[at]), part.column("term").take(pa.array(at))))
        if len(self.best) > 20:
            self.best = [self.most()]

    def most(self) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        of, value, term = zip(*self.best, strict=True)
        return _top(np.concatenate(of), np.concatenate(value), pa.concat_arrays(term))


def _top(of: np.ndarray, value: np.ndarray, term: pa.Array, top: int = TOP) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The ``top`` largest values of each group, of equal ones those of the terms that come first."""
    place = np.empty(len(term), np.int64)
    place[pc.array_sort_indices(term).to_numpy()] = np.arange(len(term))
    order = np.lexsort((place, -value, of))
    rank = np.arange(len(order)) - np.searchsorted(of[order], of[order])
    order = order[rank < top]
    return of[order], value[order], term.take(pa.array(order))


def _diverge(groups: dict[str, list], own: int, other: int):
    """Per task: sums over its terms for each pair of groups, and each own group's largest terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = {lang: _Language(rows, own, other) for lang, rows in groups.value.items() if any(r["block"] == own for r in rows)}
        for batch in batches:
            for lang in batch.column("lang").unique().to_pylist():
                if lang not in by:
                    continue
                part = batch.filter(pc.equal(batch.column("lang"), lang))
                step = max(1, CELLS // len(by[lang].sources))
                for a in range(0, part.num_rows, step):
                    by[lang].add(part.slice(a, step))
        for lang, x in by.items():
            s, t = np.nonzero(x.sums)
            names = pa.array(x.sources, pa.string())
            yield _rows(lang, names.take(pa.array(s)), "pair", names.take(pa.array(t)), x.sums[s, t])
            if x.best:
                of, value, term = x.most()
                yield _rows(lang, names.take(pa.array(of)), "term", term, value)

    return run


def _rows(lang: str, source: pa.Array, part: str, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
    n = len(value)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), source, pa.array([part] * n, pa.string()), item.cast(pa.string()), pa.array(value)],
        names=["lang", "source", "part", "item", "value"],
    )


def source_divergence(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """lang, source, part, item, value, rank: how each source's terms differ from the other sources' and from its language's.

    Terms are runs of letters (A-Z lower-cased) and of characters beyond ASCII. A language keeps the
    V terms that ``min_docs`` of its documents hold. A group (language and source) with N kept terms
    in all has p = 1 + floor(10^9 * (count + 2) / (N + 2 V)) for each of them, and so has the
    language; two shares differ by floor((p - q)^2 / (p + q)). Part ``pair`` sums this over all kept
    terms for each other source of the language. Part ``term`` gives, for the ten terms of a group
    whose share is above the language's and differs most, the difference from the language. rank
    counts from 1 per group and part by falling value, then item in the order of its UTF-8 bytes.

    Null languages, sources and texts are empty ones. A group without terms has its pairs, and no
    terms; in a language without kept terms all pairs have the value 0; a language of one source has
    no pairs. Repeated rows count as often as they occur. An empty table gives no rows. Of a very
    long text a few megabytes' terms are in memory at a time. Other columns are not read.

    The table of groups, whose square the result is, goes to the tasks; of more than ``BLOCK``
    groups, two blocks at a time do, one pass for each two blocks.
    """
    spark = docs.sparkSession
    blank = F.lit("")
    named = docs.select(
        *[F.coalesce(docs[c].cast("string"), blank).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    )
    kept, _ = write_table(stripes(named, min_docs))
    entry = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    counted = entry.groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n"))
    total = counted.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    size = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    found, seen = write_table(named.select("lang", "source").distinct(), n=F.count(F.lit(1)))
    blocks = max(1, -(-seen["n"] // BLOCK))
    zero = F.lit(0).cast("bigint")
    groups, _ = write_table(
        found.join(counted, ["lang", "source"], "left")
        .join(total, "lang", "left")
        .join(size, "lang", "left")
        .select(
            "lang",
            "source",
            *[F.coalesce(c, zero).alias(c) for c in ("n", "n_lang", "kept")],
            F.pmod(F.xxhash64("lang", "source"), F.lit(blocks)).cast("int").alias("block"),
        )
    )
    parts = []
    for own in range(blocks):
        for other in range(own, blocks):
            rows = defaultdict(list)
            for r in groups.where(F.col("block").isin(own, other) & (F.col("kept") > 0)).collect():  # about 2 * BLOCK rows
                rows[r["lang"]].append(r)
            task = _diverge(spark.sparkContext.broadcast(dict(rows)), own, other)
            parts.append(write_table(kept.mapInArrow(task, "lang string, source string, part string, item string, value bigint"))[0])
    told = parts[0]
    for p in parts[1:]:
        told = told.unionByName(p)
    key = ["lang", "source", "item"]
    half = told.where("part = 'pair'")
    both = half.select(*key, "value").union(half.select("lang", "item", "source", "value"))
    sums = both.groupBy(*key).agg(F.sum("value").alias("value"))
    every = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = every.join(sums, key, "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = told.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
