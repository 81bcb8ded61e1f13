"""N-gram Jaccard join: documents whose sets of word shingles are similar, and the groups that they form."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.anchors import keyed, sharing
from millrace.llm.common import hashed_grams, hashed_words, map_arrow, most_frequent, slices, texts_of
from millrace.llm.components import components
from millrace.sources.scratch import drop_tables, shuffles_removed, write_table

#: Words of a shingle, and the least similarity in per cent.
SHINGLE, PERCENT = 3, 90
#: Ranges of the hash space whose sizes (255 at most: the bound only gets looser) the suffix filter compares.
RANGES = 64
#: Frequent words that tasks know in order to tell rare shingles from frequent ones (at most), and how
#: often a word must occur in one chunk to be counted. They only order the prefixes: any order is right.
FREQUENT, OFTEN, CHUNK_WORDS = 100_000, 3, 1_000_000
#: Anchors that a task settles among themselves at a time.
CHUNK_ANCHORS = 750_000
#: Members of a shingle's bucket that one group compares; a larger bucket is several pairs of blocks.
BLOCK = 4096
#: Pairs are verified in parts that carry half of all sets at most, so many shingles always.
HELD = 32_000_000


def _shingles(words: np.ndarray, starts: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each text's sorted distinct shingle hashes, and the first word of each shingle's first occurrence."""
    grams = hashed_grams(words, k)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= k:
            s, first = np.unique(grams[a : b - k + 1], return_index=True)
            yield s, first + a
        elif b > a:
            yield hashed_grams(words[a:b] + np.uint64(b - a), b - a), np.array([a])
        else:
            yield np.empty(0, np.uint64), np.empty(0, np.int64)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``k`` words; a shorter text's whole sequence is one."""
    words, starts, _, _ = hashed_words(texts, lower=True)
    return [s for s, _ in _shingles(words, starts, k)]


def _parity(s: np.ndarray) -> bytes:
    """Whether the set has an odd number of hashes in each range of the low bits; as many ranges as hashes at least, below twice as many."""
    bits = max(64, 1 << (len(s) - 1).bit_length()) if len(s) else 64
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _differ(x: bytes, y: bytes) -> int:
    """By the parities of two sets, how many hashes only one of them has, at least: each turns one parity."""

    def folded(parity: bytes) -> int:
        n, bits = int.from_bytes(parity, "little"), 8 * len(parity)
        while bits > 8 * min(len(x), len(y)):
            bits //= 2
            n = (n ^ (n >> bits)) & ((1 << bits) - 1)
        return n

    return (folded(x) ^ folded(y)).bit_count()


def _members(rows: DataFrame, k: int) -> DataFrame:
    """Per text: its set's size, a 128-bit hash of the set, the sizes of the set's parts in each hash range, and their parities in finer ones."""

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        import xxhash

        n, s1, s2, sketch, parity = [], [], [], [], []
        for s in shingle_sets(texts_of(part), k):
            d = xxhash.xxh3_128_digest(s.tobytes())
            n.append(len(s))
            s1.append(int.from_bytes(d[:8], "big", signed=True))
            s2.append(int.from_bytes(d[8:], "big", signed=True))
            sketch.append(np.minimum(np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=RANGES), 255).astype(np.uint8).tobytes())
            parity.append(_parity(s))
        numbers = [pa.array(x, pa.int64()) for x in (n, s1, s2)]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("key"), part.column("th"), *numbers, pa.array(sketch, pa.binary()), pa.array(parity, pa.binary())],
            names=["doc_id", "key", "th", "n", "s1", "s2", "sketch", "parity"],
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        rows.select("doc_id", "key", "th", "text"), run, f"doc_id {kind}, key bigint, th bigint, n bigint, s1 bigint, s2 bigint, sketch binary, parity binary"
    )


def _frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of frequent words, and a weight that grows with the logarithm of their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= OFTEN
            return pa.RecordBatch.from_arrays([pa.array(h[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["h", "n"])

        for part in slices(batches):
            held.append(hashed_words(texts_of(part), lower=True)[0])
            size += len(held[-1])
            if size >= CHUNK_WORDS:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    counted = rows.select("text").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    counts, _ = write_table(counted)
    got = most_frequent(counts, FREQUENT)
    drop_tables(counts)
    h, n = got["h"].to_numpy().view(np.uint64), got["n"].to_numpy()
    order = np.argsort(h)
    return h[order], np.log2(n[order] + 1).astype(np.int64)


def _prefixes(k: int, percent: int, frequent):
    """Rare-first prefixes of the sets: two sets as similar as asked share a shingle of their prefixes.

    A shingle counts as the rarer the smaller its words' weights are together; hashes break ties.
    """

    def of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known, weight = frequent.value
        words, starts, _, _ = hashed_words(texts, lower=True)
        heavy = np.zeros(len(words) + 1, np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            heavy[1:] = np.where(known[at] == words, weight[at], 0).cumsum()
        hashes, owners, places = [], [], []
        for t, (s, first) in enumerate(_shingles(words, starts, k)):
            if not len(s):
                continue
            p = len(s) + percent * len(s) // -100 + 1
            often = heavy[np.minimum(first + k, starts[t + 1])] - heavy[first]
            chosen = np.lexsort((s, often))[:p]
            hashes.append(s[chosen])
            owners.append(np.full(p, t, np.int64))
            places.append(np.arange(p, dtype=np.int32))
        if not hashes:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32)
        return np.concatenate(hashes), np.concatenate(owners), np.concatenate(places)

    return of


class _Buckets:
    """Rows of whole buckets in columns, and the pairs in them that pass the filters and meet there first."""

    def __init__(self, t: pa.Table, percent: int):
        self.percent = percent
        self.node, self.n, self.label, self.side = (t[c].to_numpy() for c in ("node", "n", "label", "side"))
        self.rest = self.n - t["place"].to_numpy() - 1
        self.sketch = None
        if "sketch" in t.column_names:
            self.sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(-1, RANGES).astype(np.int16)
        self.before = None
        if "before" in t.column_names:
            before = t["before"].combine_chunks()
            self.before, self.at = before.values.to_numpy().tolist(), before.offsets.to_numpy()
        keys = [t[c].to_numpy() for c in ("h", "x", "y")]
        new = np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0)))
        self.bucket = np.cumsum(new) - 1
        self.size = np.bincount(self.bucket)[self.bucket]
        self.sets: dict[int, frozenset] = {}

    def earlier(self, i: int) -> frozenset:
        if i not in self.sets:
            self.sets[i] = frozenset(self.before[self.at[i] : self.at[i + 1]])
        return self.sets[i]

    def passing(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the pairs (i, j) those that may be similar: by length, by place, and if known by the sizes in the hash ranges."""
        ok = (self.label[i] != self.label[j]) & ((self.side[i] < 0) | (self.side[i] != self.side[j]))
        low, high = np.minimum(self.n[i], self.n[j]), np.maximum(self.n[i], self.n[j])
        need = -(-self.percent * (low + high) // (100 + self.percent))
        ok &= (100 * low >= self.percent * high) & (1 + np.minimum(self.rest[i], self.rest[j]) >= need)
        i, j, need = i[ok], j[ok], need[ok]
        if self.sketch is None:
            return i, j, need
        apart = np.abs(self.sketch[i] - self.sketch[j]).sum(axis=1, dtype=np.int64)
        ok = apart <= self.n[i] + self.n[j] - 2 * need
        i, j, apart = i[ok], j[ok], apart[ok]
        if self.before is None:
            return i, j, apart
        first = np.array([self.earlier(a).isdisjoint(self.earlier(b)) for a, b in zip(i.tolist(), j.tolist(), strict=True)], bool)
        return i[first], j[first], apart[first]

    def all_passing(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for d in range(1, min(int(self.size.max()), len(self.n))):  # rows d apart, all buckets at once
            i = np.flatnonzero(self.bucket[d:] == self.bucket[:-d])
            for k in range(0, len(i), 50_000):
                yield self.passing(i[k : k + 50_000] + d, i[k : k + 50_000])

    def alive(self) -> np.ndarray:
        """Which rows have some partner."""
        out = np.zeros(len(self.n), bool)
        for i, j, _ in self.all_passing():
            out[i] = out[j] = True
        return out

    def pairs(self, one: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """a, b and apart. With ``one``, only a row's nearest partner in its bucket."""
        found = list(self.all_passing())
        if not found:
            return (np.empty(0, np.int64),) * 3
        i, j, apart = (np.concatenate(x) for x in zip(*found, strict=True))
        swap = (self.n[i] < self.n[j]) | ((self.n[i] == self.n[j]) & (self.node[i] < self.node[j]))
        i, j = np.where(swap, j, i), np.where(swap, i, j)  # the larger set asks
        if not one:
            return self.node[i], self.node[j], apart
        order = np.lexsort((self.node[j], apart, i))
        i, j, apart = i[order], j[order], apart[order]
        best = np.concatenate(([True], i[1:] != i[:-1]))[: len(i)]
        return self.node[i[best]], self.node[j[best]], apart[best]


def _by_bucket(rows: DataFrame, answer, schema: str) -> DataFrame:
    """``answer`` applied to whole buckets (h, x, y), several at a time; rows have h, node and parts, the bucket's blocks.

    A bucket of several blocks is one group per pair of blocks, which keeps groups bounded.
    """
    meets = F.explode(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least("own", j).alias("x"), F.greatest("own", j).alias("y")))
    )
    others = [c for c in rows.columns if c not in ("own", "parts")]
    met = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).select(*others, "own", meets.alias("meet"))
    side = F.when(F.col("meet.x") == F.col("meet.y"), -1).otherwise(F.col("own"))
    dealt = met.select(*others, "meet.x", "meet.y", side.alias("side")).repartition("h", "x", "y").sortWithinPartitions("h", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            keys = [b.column(c).to_numpy() for c in ("h", "x", "y")]
            if held and any(held[-1].column(c)[-1].as_py() != k[0] for c, k in zip(("h", "x", "y"), keys, strict=True)):
                yield answer(pa.Table.from_batches(held).combine_chunks())
                held = []
            # the rows of the last bucket wait for the next batch
            last = np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield answer(pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks())
                held = []
            held.append(b.slice(cut))
        if held:
            yield answer(pa.Table.from_batches(held).combine_chunks())

    return dealt.mapInArrow(run, schema)


SHORT = "h bigint, node bigint, n bigint, place int, blocks int"
ROW = "h bigint, node bigint, n bigint, place int, sketch binary"


def _alive(buckets: DataFrame, percent: int, schema: str) -> DataFrame:
    """The rows of buckets (h, node, n, place, parts, and sketch and label if they are known) that have a partner by the filters."""
    columns = [c.split()[0] for c in schema.split(", ")]

    def answer(t: pa.Table) -> pa.RecordBatch:
        t = t if "label" in t.column_names else t.append_column("label", t["node"])
        alive = _Buckets(t, percent).alive()
        rows = t.select(columns).take(pa.array(np.flatnonzero(alive)))
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in rows.columns], names=columns)

    return _by_bucket(buckets, answer, schema).distinct()


def _apart(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with label and parts, of the buckets that hold different labels."""
    bucket = Window.partitionBy("h")
    return (
        buckets.join(labels, "node")
        .withColumn("low", F.min("label").over(bucket))
        .withColumn("high", F.max("label").over(bucket))
        .withColumn("parts", F.ceil(F.count(F.lit(1)).over(bucket) / BLOCK).cast("int"))
        .where("low < high")
        .drop("low", "high")
    )


def _with_earlier(few: DataFrame) -> DataFrame:
    """The rows (ROW) with the hashes of their set's rows at earlier places, as before.

    A pair that passes in one bucket passes in the first one that both share, so its rows there are among these.
    """
    order = few.groupBy("node").agg(F.array_sort(F.collect_set(F.struct("place", "h"))).alias("all"))
    earlier = F.transform(F.filter("all", lambda x: x["place"] < F.col("place")), lambda x: x["h"])
    return few.join(order, "node").select("h", "node", "n", "place", "sketch", earlier.alias("before"))


def _candidates(rows: DataFrame, percent: int, one: bool) -> DataFrame:
    """a, b, apart of the candidate pairs with different labels; with ``one``, only a row's nearest partner in its bucket.

    Where the rows have before, each pair comes from the first bucket that both share.
    """

    def answer(t: pa.Table) -> pa.RecordBatch:
        a, b, apart = _Buckets(t, percent).pairs(one)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(apart, pa.int32())], names=["a", "b", "apart"])

    return _by_bucket(rows, answer, "a bigint, b bigint, apart int")


def _close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) those that may be similar by the parities, with the size of a's set.

    Sets without anything in common differ in a quarter of their hashes or more by these, however large they are;
    by the sizes in 64 ranges, large sets look alike.
    """
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("parity").alias("x"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            sizes = t.column("na").to_numpy() + t.column("nb").to_numpy()
            most = sizes - 2 * -(-percent * sizes // (100 + percent))
            differ = [_differ(x.as_py(), y.as_py()) for x, y in zip(t.column("x"), t.column("y"), strict=True)]
            yield t.select(["a", "b", "na"]).filter(pa.array(np.array(differ, np.int64) <= most))

    return pairs.select("a", "b").join(a, "a").join(b, "b").mapInArrow(run, "a bigint, b bigint, na bigint")


def _verified(pairs: DataFrame, of_a: DataFrame, of_b: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) those whose sets are as similar as asked."""
    a = of_a.select(F.col("node").alias("a"), F.col("grams").alias("x"))
    b = of_b.select(F.col("node").alias("b"), F.col("grams").alias("y"))
    met = pairs.join(a, "a").join(b, "b").select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), F.size(F.array_intersect("x", "y")).cast("bigint").alias("both"))
    return met.where(100 * F.col("both") >= percent * (F.col("nx") + F.col("ny") - F.col("both"))).select("a", "b")


def _links(pairs: DataFrame, carried: int, rows: DataFrame, nodes: DataFrame, total: int, shingle: int, percent: int) -> list[DataFrame]:
    """Of the pairs (a, b) those whose sets are as similar as asked, as written tables.

    The sets of a part of the pairs at a time are shuffled: ``carried`` shingles come with all pairs, ``total`` are in all nodes.
    """
    either = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    asked, _ = write_table(nodes.select("node", "key", "th").join(either, "node"))
    texts = rows.join(asked, ["key", "th"]).groupBy("key", "th").agg(F.first("node").alias("node"), F.first("text").alias("text"))
    sets, held = write_table(_sets(texts.select("node", "text"), shingle), n=F.sum(F.size("grams")))
    most = max(HELD, total // 2)
    parts = max(1, math.ceil(2 * (held["n"] or 0) / most), math.ceil(math.sqrt(carried / most)))

    def of(table: DataFrame, node: str, part: int) -> DataFrame:
        return table if parts == 1 else table.where(F.pmod(F.xxhash64(node), F.lit(parts)) == part)

    written = []
    for i in range(parts):
        for j in range(parts):
            some = of(of(pairs, "a", i), "b", j).select("a", "b")
            x, y = (of(sets, "node", p).select("node", "grams") for p in (i, j))
            written.append(write_table(_verified(some, x, y, percent))[0])
    drop_tables(asked, sets)
    return written


def near_groups(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, the smallest doc_id that links lead to, its own included, and text_hash.

    Words are lower-cased (A-Z only); a text's set holds its distinct runs of ``shingle`` words, or
    its whole sequence if it is shorter. Two documents link if the intersection of their sets is at
    least ``percent`` of the union. Null and empty texts have empty sets and link with nothing.
    Documents with equal sets are one node, repeated rows too. A null id is no smallest id: a group of
    null ids only has a null component_id. A very long text is a slice of its own and read whole. An
    empty table gives no rows; other columns are not read.

    Candidates meet on rare-first prefixes and pass the length, positional and suffix filters (the
    last compares how many shingles fall into each range of the hash space). The first two rounds
    verify one partner per document, the nearest one by the suffix filter, the last round all pairs
    still in different groups; pairs inside a group need no verification. There each pair meets in the
    first bucket that its prefixes share. Sets are read of pairs that also pass by the parities of
    finer ranges, and tables and shuffle files go as soon as they are read.
    """
    rows = keyed(docs, id_col, text_col)
    with shuffles_removed(docs.sparkSession):
        members, nodes, labels = _grouped(rows, shingle, percent)
    labelled = nodes.join(labels, "node", "left").select("s1", "s2", "n", "first", F.coalesce("label", "node").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    of_class = labelled.join(smallest, "label").select("s1", "s2", "n", "component_id")
    return members.join(of_class, ["s1", "s2", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("th").alias("text_hash"),
    )


def _grouped(rows: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of rows (``keyed``) the written members, nodes (a row per different set) and labels (node, label; nodes without a partner have none)."""
    members, _ = write_table(_members(rows, shingle))
    classes = (
        members.where("n > 0")
        .groupBy("s1", "s2", "n")
        .agg(F.min("doc_id").alias("first"), F.min(F.struct("key", "th")).alias("rep"), F.first("sketch").alias("sketch"), F.first("parity").alias("parity"))
    )
    nodes, size = write_table(
        classes.select("s1", "s2", "n", "first", "rep.key", "rep.th", "sketch", "parity", F.monotonically_increasing_id().alias("node")), n=F.sum("n")
    )
    frequent = rows.sparkSession.sparkContext.broadcast(_frequent(rows))
    shared = sharing(rows, _prefixes(shingle, percent, frequent), inside=False, by="th", chunk=CHUNK_ANCHORS)
    # in short rows: which shingles two nodes share, and which rows have a partner by length and place; of these few, by sketch
    short, _ = write_table(
        nodes.select("th", "node", "n").join(shared, "th").select("node", "n", F.explode("anchors").alias("anchor")).select("anchor.h", "node", "n", "anchor.place")
    )
    met = short.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("h"))).where("m > 1")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    able, _ = write_table(_alive(met.select("h", "node", "n", "place", blocks.alias("blocks"), blocks.alias("parts")), percent, SHORT))
    drop_tables(short)
    wide = able.join(nodes.select("node", "sketch"), "node")
    buckets, _ = write_table(_alive(wide.select("h", "node", "n", "place", "sketch", F.col("blocks").alias("parts")), percent, ROW))
    drop_tables(able)

    labels, _ = write_table(buckets.select("node").distinct().withColumn("label", F.col("node")))
    for one in (True, True, False):
        few, rows_apart = [], _apart(buckets, labels)
        if not one:
            few = [write_table(_alive(rows_apart, percent, ROW))[0]]
            rows_apart = _apart(_with_earlier(few[0]), labels)
        found, n = write_table(_candidates(rows_apart, percent, one), n=F.count(F.lit(1)))
        drop_tables(*few)
        if not n["n"]:
            drop_tables(found)
            break
        pairs = found
        if one:
            pairs = pairs.groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))
        close, n = write_table(_close(pairs, nodes, percent), n=F.sum("na"))
        drop_tables(found)
        if not n["n"]:
            drop_tables(close)
            continue
        linked = _links(close, n["n"], rows, nodes, size["n"], shingle, percent)
        links = reduce(DataFrame.union, linked)
        of = labels.select(F.col("node"), "label")
        between = links.join(of.select(F.col("node").alias("a"), F.col("label").alias("la")), "a").join(
            of.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b"
        )
        merged = components(between.select(F.col("la").alias("a"), F.col("lb").alias("b")))
        old = labels
        labels, _ = write_table(
            labels.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")
            )
        )
        drop_tables(old, merged, close, *linked)
    drop_tables(buckets)
    return members, nodes, labels


def keep_first(docs: DataFrame, shingle: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose id is the smallest of their group; as in ``near_groups``.

    Rows that share id and text are one document and stay together.
    """
    groups = near_groups(docs, shingle, percent, id_col, text_col)
    gone = groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")
    )
    same = docs[id_col].eqNullSafe(gone["gone_id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == gone["gone_hash"])
    return docs.join(gone.distinct(), same, "left_anti")


def _sets(texts: DataFrame, k: int) -> DataFrame:
    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        grams = [s.view(np.int64) for s in shingle_sets(texts_of(part), k)]
        yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(grams, pa.list_(pa.int64()))], names=["node", "grams"])

    return map_arrow(texts, run, "node bigint, grams array<bigint>")
