"""MinHash near duplicates with tensored banding: table keys are pairs of a few small minhash collections."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.anchors import keyed
from millrace.llm.common import map_arrow, mix, texts_of
from millrace.llm.components import components
from millrace.llm.near import shingle_sets
from millrace.sources.scratch import write_table

#: Words of a shingle, and the least similarity in per cent.
SHINGLE, PERCENT = 2, 80
#: Minhashes of a collection, and collections. Each two collections key a table: 153 tables of six
#: minhashes each from 54 minhashes, where separate tables would need 918.
ROWS, COLLECTIONS = 3, 18
#: Rounds in which a document is compared with a few partners, before all pairs still apart are; how
#: many partners it then has, and how many members each bucket offers to its others.
ROUNDS, PARTNERS, OFFERED = 3, 3, 3
#: Ranges of the hash space whose sizes bound how similar two sets can be: fine enough that few differences cancel.
RANGES = 256
#: Members of a bucket that are compared with others at a time.
BLOCK = 4096


def recall(similarity: float, rows: int = ROWS, collections: int = COLLECTIONS) -> float:
    """The chance that two sets share a table's key: two collections at least must agree."""
    q = similarity**rows
    return 1 - (1 - q) ** collections - collections * q * (1 - q) ** (collections - 1)


def collection_hashes(sets: list[np.ndarray], rows: int = ROWS, collections: int = COLLECTIONS) -> np.ndarray:
    """One row per set (none of them empty): a 64-bit hash of each collection's ``rows`` minhashes."""
    every = np.concatenate(sets)
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    salts = mix(np.arange(1, 2 * rows * collections + 1, dtype=np.uint64)).reshape(-1, 2)
    out = np.zeros((len(sets), collections), np.uint64)
    for i, (flip, factor) in enumerate(salts):
        # a bijection of 64-bit numbers, another one for each minhash, orders the shingles
        least = np.minimum.reduceat((every ^ flip) * (factor | np.uint64(1)), first)
        out[:, i // rows] = mix(out[:, i // rows] + least + np.uint64(i))
    return out


def table_key(one: np.ndarray, two: np.ndarray, a: np.ndarray, b: np.ndarray, collections: int) -> np.ndarray:
    """The key of the hashes of collections a and b, which both enter; the two's numbers tell the tables apart."""
    return mix(mix(one + (a * collections + b).astype(np.uint64)) + two)


def table_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each two collections."""
    a, b = np.triu_indices(hashes.shape[1], 1)
    return table_key(hashes[:, a], hashes[:, b], a, b, hashes.shape[1])


def _members(rows: DataFrame, shingle: int, per: int, collections: int) -> DataFrame:
    """Per row: its set's size, a 128-bit hash of the set, the sizes of its parts in ranges of hashes, the collections' hashes."""

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        import xxhash

        sets = shingle_sets(texts_of(part), shingle)
        full = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
        hashes = np.zeros((len(sets), collections), np.uint64)
        if len(full):
            hashes[full] = collection_hashes([sets[i] for i in full], per, collections)
        digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        ranges = [np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=RANGES), 255).astype(np.uint8).tobytes() for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("key"),
                part.column("th"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([int.from_bytes(d[:8], "big", signed=True) for d in digests], pa.int64()),
                pa.array([int.from_bytes(d[8:], "big", signed=True) for d in digests], pa.int64()),
                pa.array(ranges, pa.binary()),
                pa.array([h.tobytes() for h in hashes], pa.binary()),
            ],
            names=["doc_id", "key", "th", "n", "s1", "s2", "ranges", "hashes"],
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        rows.select("doc_id", "key", "th", "text"),
        run,
        f"doc_id {kind}, key bigint, th bigint, n bigint, s1 bigint, s2 bigint, ranges binary, hashes binary",
    )


def _keys(nodes: DataFrame, collections: int) -> DataFrame:
    """h and node: the keys of each node's set in all tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2_000):
                part = batch.slice(a, 2_000)
                hashes = np.frombuffer(b"".join(part.column("hashes").to_pylist()), np.uint64).reshape(-1, collections)
                h = table_keys(hashes)
                node = np.repeat(part.column("node").to_numpy(), h.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(h.reshape(-1).view(np.int64)), pa.array(node)], names=["h", "node"])

    return nodes.select("node", "hashes").mapInArrow(run, "h bigint, node bigint")


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        grams = [s.view(np.int64) for s in shingle_sets(texts_of(part), shingle)]
        yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(grams, pa.list_(pa.int64()))], names=["node", "grams"])

    return map_arrow(texts, run, "node bigint, grams array<bigint>")


class _Facts:
    """Of some rows what bounds and estimates the similarity of their sets."""

    def __init__(self, part: pa.RecordBatch | pa.Table, suffix: str = ""):
        self.n = part.column(f"n{suffix}").to_numpy()
        self.ranges = np.frombuffer(b"".join(part.column(f"ranges{suffix}").to_pylist()), np.uint8).reshape(-1, RANGES).astype(np.int16)
        self.hashes = np.frombuffer(b"".join(part.column(f"hashes{suffix}").to_pylist()), np.uint64).reshape(len(self.n), -1)


def _may_link(x: _Facts, y: _Facts, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs (i of x, j of y) can be as similar as asked.

    Exact bounds by the sizes of the sets and of their parts in ranges of hashes (parts of at least
    255 shingles count as 255, which only makes the distance smaller): no similar pair is lost.
    """
    n, m = x.n[i], y.n[j]
    need = -(-percent * (n + m) // (100 + percent))
    able = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    at = np.flatnonzero(able)
    apart = np.abs(x.ranges[i[at]] - y.ranges[j[at]]).sum(axis=1, dtype=np.int64)
    able[at] = apart <= (n + m - 2 * need)[at]
    return able


def _proposed(percent: int):
    """Of pairs (a, b) with the facts of both those that may link, and in how many collections they agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, all_ = _Facts(batch, "_a"), _Facts(batch, "_b"), np.arange(batch.num_rows)
            able = np.flatnonzero(_may_link(x, y, all_, all_, percent))
            agree = (x.hashes[able] == y.hashes[able]).sum(axis=1)
            a, b = (batch.column(c).take(pa.array(able)) for c in "ab")
            yield pa.RecordBatch.from_arrays([a, b, pa.array(agree, pa.int64())], names=["a", "b", "agree"])

    return run


def _crossing(percent: int):
    """Of whole groups (h, x, y) the pairs with different labels that may link and share no table before this one.

    A group with x = y holds pairs of all its rows, another one pairs of rows with different sides.
    """

    def pairs(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        facts, label, side, node = _Facts(part), *(part.column(c).to_numpy() for c in ("label", "side", "node"))
        h, x, y = (part.column(c)[0].as_py() for c in ("h", "x", "y"))
        a, b = [], []
        few = np.arange(part.num_rows) if x == y else min(np.flatnonzero(side == side.min()), np.flatnonzero(side != side.min()), key=len)
        for i in few.tolist():
            others = np.arange(i) if x == y else np.flatnonzero(side != side[i])
            others = others[label[others] != label[i]]
            others = others[_may_link(facts, facts, np.full(len(others), i), others, percent)]
            if not len(others):
                continue
            same = facts.hashes[others] == facts.hashes[i]
            all_ = np.arange(len(others))
            one = same.argmax(axis=1)
            same[all_, one] = False
            two = same.argmax(axis=1)
            others = others[table_key(facts.hashes[i, one], facts.hashes[i, two], one, two, facts.hashes.shape[1]).view(np.int64) == h]
            a.append(np.full(len(others), node[i]))
            b.append(node[others])
        none = np.empty(0, np.int64)
        return np.concatenate([none, *a]), np.concatenate([none, *b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of a group that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in ("h", "x", "y")]
            new = np.flatnonzero(np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0))))
            goes_on = held and all(held[-1].column(c)[-1].as_py() == k[0] for c, k in zip(("h", "x", "y"), keys, strict=True))
            found = []
            for at, (first, end) in enumerate(zip(new.tolist(), [*new[1:].tolist(), batch.num_rows], strict=True)):
                if held and not (at == 0 and goes_on):
                    found.append(pairs(pa.Table.from_batches(held).combine_chunks()))
                    held = []
                held.append(batch.slice(first, end - first))
            if found:
                a, b = (np.concatenate(f) for f in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        if held:
            a, b = pairs(pa.Table.from_batches(held).combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) those whose whole sets are as similar as asked."""
    a = sets.select(F.col("node").alias("a"), F.col("grams").alias("x"))
    b = sets.select(F.col("node").alias("b"), F.col("grams").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("bigint")
    met = pairs.join(a, "a").join(b, "b").select("a", "b", (F.size("x") + F.size("y")).alias("sum"), both.alias("both"))
    return met.where(100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    rows: int = ROWS,
    collections: int = COLLECTIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id that links lead to, its own included) and kept.

    Words are lower-cased (A-Z only); a text's set holds its distinct runs of ``shingle`` words, or
    its whole sequence if it is shorter. Two documents link if the intersection of their sets is at
    least ``percent`` of the union. kept marks the documents that are their group's smallest id.

    Candidates share a table's key; each table is keyed by two of ``collections`` hashes of ``rows``
    minhashes, so c (c - 1) / 2 tables cost c collections. Two sets of similarity s share no key
    with the chance 1 - ``recall(s)`` (5e-5 at 0.8, 6e-8 at 0.9); all that share one are looked at.
    Documents with equal sets are one node. Nodes that share keys are verified on their whole sets,
    in ``ROUNDS`` rounds each node with ``PARTNERS`` others of another group: of its buckets' most
    central members (next of members drawn by hash) those that agree with it in most collections.
    Most groups are whole by then. Last come all pairs that share a key and are still in different
    groups; pairs inside a group need no verification.

    Null and empty texts, and texts of white space only, have empty sets, link with nothing and are
    kept. Rows that repeat share a group, and are all kept if their id is its smallest. A null id is
    no smallest id: a group of null ids only has a null component_id, and its kept is null.
    Texts are read whole, however long. An empty table gives no rows; other columns are not read.
    """
    texts = keyed(docs, id_col, text_col)
    members, _ = write_table(_members(texts, shingle, rows, collections))
    classes = (
        members.where("n > 0")
        .groupBy("s1", "s2", "n")
        .agg(
            F.min("doc_id").alias("first"),
            F.min(F.struct("key", "th")).alias("rep"),
            F.first("ranges").alias("ranges"),
            F.first("hashes").alias("hashes"),
        )
    )
    nodes, _ = write_table(
        classes.select("s1", "s2", "n", "first", "rep.key", "rep.th", "ranges", "hashes", F.monotonically_increasing_id().alias("node"))
    )
    every = _keys(nodes, collections)
    several = every.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met, _ = write_table(every.join(several, "h").select("h", "node", "m"))
    # central documents of a group of copies meet most others: each bucket's first partner is its most central member
    central = met.groupBy("node").agg(F.sum("m").alias("central"))
    labels, _ = write_table(central.select("node", F.col("node").alias("label"), "central"))
    met = met.select("h", "node")
    asked = nodes.join(labels.select("node"), "node").select("node", "key", "th")
    sets, _ = write_table(_sets(texts.join(asked, ["key", "th"]).select("node", "text"), shingle).dropDuplicates(["node"]))
    facts = nodes.select("node", "n", "ranges", "hashes")

    for turn in range(ROUNDS + 1):
        mixed, n = _mixed(met, labels, turn)
        if not n:
            break
        pairs = _all_apart(mixed, facts, percent) if turn == ROUNDS else _partners(mixed, labels, facts, percent)
        links, n = write_table(_verified(write_table(pairs)[0], sets, percent), n=F.count(F.lit(1)))
        if n["n"]:
            a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
            b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
            between = links.join(a, "a").join(b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
            merged = components(between).select(F.col("node").alias("label"), F.col("label").alias("to"))
            labels, _ = write_table(
                labels.join(merged, "label", "left").select("node", F.coalesce("to", "label").alias("label"), "central")
            )
        met = mixed.select("h", "node")

    labelled = nodes.join(labels, "node", "left").select("s1", "s2", "n", "first", F.coalesce("label", "node").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    of_class = labelled.join(smallest, "label").select("s1", "s2", "n", "component_id")
    found = members.join(of_class, ["s1", "s2", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def _mixed(met: DataFrame, labels: DataFrame, turn: int) -> tuple[DataFrame, int]:
    """The rows (h, node, label) of buckets with several labels, the label ``main`` of the most central member, and offered nodes."""
    rows = met.join(labels, "node")
    offered = [F.max_by("node", "central")] if turn == 0 else [F.min_by("node", F.xxhash64("node", F.lit(OFFERED * turn + i))) for i in range(OFFERED)]
    several = (
        rows.groupBy("h")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max_by("label", "central").alias("main"), F.array(*offered).alias("offered"))
        .where("low < high")
        .drop("low", "high")
    )
    mixed, n = write_table(rows.join(several, "h").select("h", "node", "label", "main", "offered"), n=F.count(F.lit(1)))
    return mixed, n["n"]


def _with_facts(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    for x in "ab":
        pairs = pairs.join(facts.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "ranges", "hashes")]), x)
    return pairs


def _partners(mixed: DataFrame, labels: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b): each node with the ``PARTNERS`` that agree with it most, of those that its buckets offer with another label."""
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    met = mixed.select(F.col("node").alias("a"), F.col("label").alias("la"), F.explode("offered").alias("b")).where("a <> b").distinct()
    apart = met.join(b, "b").where("la <> lb").select("a", "b")
    able = _with_facts(apart, facts).mapInArrow(_proposed(percent), "a bigint, b bigint, agree bigint")
    # at most as many rows per node as its buckets offer
    best = F.slice(F.sort_array(F.collect_list(F.struct("agree", "b")), asc=False), 1, PARTNERS)
    return able.groupBy("a").agg(best.alias("best")).select("a", F.explode("best.b").alias("b"))


def _all_apart(mixed: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) that share a bucket, have different labels and may link, each once.

    In a bucket the rows with the main label, mostly nearly all, are dealt to blocks, and each of the
    others meets every block. The others meet one another in pairs of blocks.
    """
    inside = F.col("label") == F.col("main")
    sizes = mixed.groupBy("h").agg(F.count_if(inside).alias("n_in"), F.count_if(~inside).alias("n_out"))
    blocks = [F.ceil(F.col(c) / BLOCK).cast("int") for c in ("n_in", "n_out")]
    own = F.xxhash64("node")
    rows = mixed.join(sizes, "h").select(
        "h", "node", "label", inside.alias("inside"), blocks[0].alias("b_in"), blocks[1].alias("b_out"),
        F.pmod(own, F.when(inside, blocks[0]).otherwise(blocks[1])).cast("int").alias("own"),
    )
    one, minus = F.lit(1), F.lit(-1)
    among = F.array(F.struct(minus.alias("x"), F.col("own").alias("y"), F.lit(0).alias("side")))
    against = F.transform(F.sequence(F.lit(0), F.col("b_in") - 1), lambda j: F.struct(minus.alias("x"), j.alias("y"), one.alias("side")))
    others = F.transform(
        F.sequence(F.lit(0), F.col("b_out") - 1),
        lambda j: F.struct(F.least("own", j).alias("x"), F.greatest("own", j).alias("y"), F.col("own").alias("side")),
    )
    dealt = rows.select("h", "node", "label", F.explode(F.when(F.col("inside"), among).otherwise(F.concat(against, others))).alias("at"))
    whole = dealt.select("h", "at.x", "at.y", "at.side", "node", "label").join(facts, "node")
    return whole.repartition("h", "x", "y").sortWithinPartitions("h", "x", "y").mapInArrow(_crossing(percent), "a bigint, b bigint")
