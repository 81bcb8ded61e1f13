"""Hidden Markov language model: Baum-Welch over all training texts, exact likelihood of every text.

A token is seen by the hidden chain as a symbol: the most frequent words and the end are symbols of
their own, all other words share the symbol of their ending. A state emits a symbol, and the symbol
emits the word in proportion to its smoothed count, so that with one state the model is the smoothed
unigram model, and it sums to one over the known words and one unknown word per ending.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, most_frequent, slices, texts_of
from millrace.sources.scratch import write_table

#: Hidden states, words with a symbol of their own, symbols for endings, rounds of Baum-Welch.
STATES, TOP_WORDS, ENDINGS, ROUNDS = 8, 4096, 1024, 6
#: Words whose counts every task holds (at most), counts of rarer words are joined; and words that a task counts before it sends them on.
HELD_WORDS, COUNTED_WORDS = 400_000, 600_000
#: Steps of Baum-Welch whose forward messages are held at a time (a text of any length is one sequence), and tokens worked on at a time.
SPAN, BATCH_TOKENS = 256, 400_000
#: Tokens whose forward messages are held, and whose expected counts are added up at once.
HELD_TOKENS, SEEN_TOKENS = 2_000_000, 200_000
#: Tokens whose symbols a task gathers, so that texts of like length are worked on together.
GATHERED_TOKENS = 16_000_000
SMOOTH = 0.1


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def count_words(docs: DataFrame) -> DataFrame:
    """word and n over all rows of ``docs`` (column text); the empty word is the end of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
            )

        for part in slices(batches):
            for text in texts_of(part):
                counts.update(words_of(text))
                counts[b""] += 1
            if len(counts) > COUNTED_WORDS:
                yield out()
                counts.clear()
        if counts:
            yield out()

    return docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Symbols:
    """The words that tasks hold, their counts, and every word's symbol."""

    def __init__(self, words: list[tuple[str, int]], end: int, top: int, endings: int):
        self.rank = {w.encode(): i for i, (w, _) in enumerate(words)}
        self.log_count = np.log10(np.array([n for _, n in words] + [end], float) + SMOOTH)
        self.known_end = end > 0
        self.top, self.endings = top, endings
        self.end = top + endings
        ending = [i if i < top else top + self.ending(w.encode()) for i, (w, _) in enumerate(words)]
        self.symbol = np.array([*ending, self.end], np.int16)

    def ending(self, word: bytes) -> int:
        return zlib.crc32(word[-3:]) % self.endings

    @property
    def size(self) -> int:
        return self.end + 1


@dataclass
class Model:
    start: np.ndarray  # (states)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (symbols, states)

    def log10_likelihood(self, texts: list[np.ndarray]) -> np.ndarray:
        """The scaled forward recursion over all texts at once; each is a sequence of symbols."""
        out = np.zeros(len(texts))
        for order, columns in _in_step(texts):
            a, total = None, np.zeros(len(order))
            for symbols in columns:
                k = len(symbols)
                a = self.start[None, :] * self.emit[symbols] if a is None else _move(a[:k], self.move) * self.emit[symbols]
                scale = a.sum(axis=1)
                a /= scale[:, None]
                total[:k] += np.log10(scale)
            out[order] = total
        return out


def _move(a: np.ndarray, move: np.ndarray) -> np.ndarray:
    return np.einsum("dk,kj->dj", a, move)  # not BLAS: a row's result must not depend on its neighbours


def _in_step(texts: list[np.ndarray]):
    """The texts that aren't empty, longest first, and for each step the symbols of those that reach it."""
    for order, n, column in _columns(texts):
        yield order, map(column, range(n))


def _columns(texts: list[np.ndarray]):
    """The texts that aren't empty, longest first, the number of steps, and a step's symbols of those that reach it."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    if not len(order):
        return
    flat = np.concatenate([texts[i] for i in order])
    sizes = sizes[order]
    first = np.cumsum(sizes) - sizes
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # texts longer than t
    yield order, len(active), lambda t: flat[first[: active[t]] + t]


def _forward(model: Model, a: np.ndarray | None, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = (model.start[None, :] if a is None else a[: len(symbols)] @ model.move) * model.emit[symbols]
    c = a.sum(axis=1, keepdims=True)
    return a / c, c


def _expected(model: Model, texts: list[np.ndarray], into: dict[str, np.ndarray]) -> None:
    """Adds one batch's expected counts: the forward and backward recursions of Baum-Welch over whole texts.

    The forward messages of up to HELD_TOKENS tokens are held. Of longer texts those are kept where a
    stretch of SPAN steps begins; those inside it are computed again on the way back.
    """
    moves, back = np.zeros_like(model.move), np.ascontiguousarray(model.move.T)
    for _, n, column in _columns(texts):
        span = n if sum(map(len, texts)) <= HELD_TOKENS else SPAN
        kept, a = [None], None
        for t in range((n - 1) // span * span):
            a, _ = _forward(model, a, column(t))
            if (t + 1) % span == 0:
                kept.append(a)
        ahead = None  # emission times beta over scale at the step before this one (going back)
        for first in reversed(range(0, n, span)):
            steps = [column(t) for t in range(first, min(first + span, n))]
            alpha, scale, a = [], [], kept.pop()
            for s in steps:
                a, c = _forward(model, a, s)
                alpha.append(a)
                scale.append(c)
            into["log10"] += np.log10(np.concatenate(scale)).sum()
            seen, size = [], 0
            while steps:
                s, a, c = steps.pop(), alpha.pop(), scale.pop()
                beta = np.ones_like(a)
                if ahead is not None:
                    m = len(ahead)
                    beta[:m] = ahead @ back
                    moves += a[:m].T @ ahead
                seen.append((s, a * beta))
                ahead = model.emit[s] * beta / c
                size += len(s)
                if size > SEEN_TOKENS or not steps:
                    flat, gamma = (np.concatenate(x) for x in zip(*seen, strict=True))
                    for k in range(gamma.shape[1]):
                        into["emit"][:, k] += np.bincount(flat, gamma[:, k], len(into["emit"]))
                    if not steps and not first:
                        into["start"] += seen[-1][1].sum(axis=0)
                    seen, size = [], 0
    into["move"] += model.move * moves


def _batches(batches: Iterator[pa.RecordBatch], limit: int, gathered: int = GATHERED_TOKENS) -> Iterator[pa.Table]:
    """Rows of about ``limit`` tokens (column n_tokens), texts of like length together: they take their steps side by side."""

    def cut(held: list[pa.RecordBatch]) -> Iterator[pa.Table]:
        rows = pa.Table.from_batches(held)
        rows = rows.take(pa.array(np.argsort(-rows["n_tokens"].to_numpy(), kind="stable"))).combine_chunks()
        ends = np.cumsum(rows["n_tokens"].to_numpy())
        first = 0
        while first < rows.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield rows.slice(first, last - first)
            first = last

    held, size = [], 0
    for b in batches:
        held.append(b)
        size += int(b.column("n_tokens").to_numpy().sum())
        if size >= gathered:
            yield from cut(held)
            held, size = [], 0
    if size:
        yield from cut(held)


def _symbols_of(t: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int16) for x in t.column("symbols").to_pylist()]


def _one_round(encoded: DataFrame, model: Model) -> tuple[Model, float]:
    """Expected counts of all training texts, summed by Spark, and the model that they give."""
    states, symbols = model.move.shape[0], len(model.emit)
    sent = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into = {"log10": np.zeros(1), "start": np.zeros(states), "move": np.zeros((states, states)), "emit": np.zeros((symbols, states))}
        for t in _batches(batches, 4 * BATCH_TOKENS):
            _expected(sent.value, _symbols_of(t), into)
        flat = np.concatenate([into[k].ravel() for k in ("log10", "start", "move", "emit")])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(flat[at])], names=["at", "n"])

    total = np.zeros(1 + states + states**2 + symbols * states)
    # as many rows as the model has parameters, at most
    for r in encoded.select("n_tokens", "symbols").mapInArrow(run, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect():
        total[r["at"]] = r["n"]
    start, move = total[1 : 1 + states], total[1 + states : 1 + states + states**2].reshape(states, states)
    emit = total[1 + states + states**2 :].reshape(symbols, states)
    return _normal(start, move, emit, model.emit @ np.full(states, 1 / states)), total[0]


def _normal(start: np.ndarray, move: np.ndarray, emit: np.ndarray, prior: np.ndarray) -> Model:
    start, move, emit = start + 1.0, move + 1.0, emit + 10.0 * (prior / prior.sum())[:, None]
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def score_texts(
    docs: DataFrame,
    trained: Column,
    states: int = STATES,
    top_words: int = TOP_WORDS,
    endings: int = ENDINGS,
    rounds: int = ROUNDS,
    held_words: int = HELD_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, list[float]]:
    """Trains on the rows where ``trained`` (a condition on ``docs``) holds and scores every row.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (smoothed unigram model)
    and score (the hidden Markov model), both as log10 probabilities of the whole text, and the
    log10 likelihood of the training texts before each round. A null text is empty and has one token, the
    end. Rows that repeat are each counted and scored. Without training rows all words are unknown.
    A text of any length is one sequence. An empty table gives no rows; other columns are not read.

    Words are counted over all training rows; counts of the ``held_words`` most frequent ones go to
    the tasks, the others are joined. Every round reads all training texts.
    """
    spark = docs.sparkSession
    found = docs.select(
        docs[id_col].alias("doc_id"), docs[text_col].alias("text"), F.coalesce(trained, F.lit(False)).alias("trained")
    )
    kind = found.schema["doc_id"].dataType.simpleString()
    counts, sums = write_table(count_words(found.where("trained")), n=F.sum("n"), v=F.count(F.lit(1)))
    total, distinct = sums["n"] or 0, sums["v"]
    end = counts.where("word = ''").agg(F.max("n")).first()[0] or 0
    got = most_frequent(counts.where("word <> ''"), held_words)
    words = sorted(zip(got["word"].to_pylist(), got["n"].to_pylist(), strict=True), key=lambda w: (-w[1], w[0]))
    symbols = Symbols(words, end, min(top_words, len(words)), endings)
    table = spark.sparkContext.broadcast(symbols)
    mass = _masses(counts, table, endings)
    top = symbols.top
    prior = np.concatenate([10 ** symbols.log_count[:top], mass, [end + SMOOTH]])
    log_mass = np.log10(mass)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = table.value
        get, uid = s.rank.get, TaskContext.get().partitionId() << 40
        for part in slices(batches):
            main: dict[str, list] = {k: [] for k in ("uid", "row", "n", "known", "base", "rare_class", "symbols")}
            rare_uid, rare_word, rare_n = [], [], []
            for k, text in enumerate(texts_of(part)):
                uid += 1
                tokens = words_of(text)
                rank = np.fromiter(chain(map(get, tokens, repeat(-1)), (len(s.rank),)), np.int64, len(tokens) + 1)
                symbol = s.symbol[rank]
                away = np.flatnonzero(rank < 0)
                if len(away):
                    seldom = [tokens[i] for i in away.tolist()]
                    symbol[away] = [s.top + s.ending(w) for w in seldom]
                    for w, n in Counter(seldom).items():
                        rare_uid.append(uid)
                        rare_word.append(w)
                        rare_n.append(n)
                here = rank[rank >= 0]
                logs = s.log_count[here]
                classed = (symbol >= s.top) & (symbol < s.end)
                main["uid"].append(uid)
                main["row"].append(k)
                main["n"].append(len(rank))
                main["known"].append(len(here) - (not s.known_end))
                main["base"].append(float(logs.sum()))
                main["rare_class"].append(float(logs[classed[rank >= 0]].sum() - log_mass[symbol[classed] - s.top].sum()))
                main["symbols"].append(symbol.tobytes())
            take = pa.array(main["row"] + [None] * len(rare_uid), pa.int64())
            none = [None] * len(rare_uid)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(main["uid"] + rare_uid, pa.int64()),
                    part.column("doc_id").take(take),
                    part.column("trained").take(take),
                    pa.array(main["n"] + rare_n, pa.int64()),
                    pa.array(main["known"] + none, pa.int64()),
                    pa.array(main["base"] + none, pa.float64()),
                    pa.array(main["rare_class"] + none, pa.float64()),
                    pa.array(main["symbols"] + none, pa.binary()),
                    pa.array([None] * len(main["uid"]) + rare_word, pa.binary()).cast(pa.string()),
                ],
                names=["uid", "doc_id", "trained", "n_tokens", "known", "base", "rare_class", "symbols", "word"],
            )

    written, _ = write_table(
        found.mapInArrow(
            encode,
            f"uid bigint, doc_id {kind}, trained boolean, n_tokens bigint, known bigint, base double, rare_class double, symbols binary, word string",
        )
    )
    texts, rare = written.where("word IS NULL"), written.where("word IS NOT NULL")

    noise = np.exp(np.random.default_rng(17).normal(size=(len(prior), states)))
    emit = prior[:, None] * noise
    model = Model(
        np.full(states, 1 / states), np.full((states, states), 0.1 / states) + 0.9 * np.eye(states), emit / emit.sum(axis=0)
    )
    likelihoods = []
    for _ in range(rounds):
        fitted, at = _one_round(texts.where("trained"), model)
        model = fitted if total else model
        likelihoods.append(float(at))
    sent = spark.sparkContext.broadcast(model)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _batches(batches, 4 * BATCH_TOKENS):
            found = sent.value.log10_likelihood(_symbols_of(t))
            yield from t.drop_columns(["symbols"]).append_column("chain", pa.array(found)).combine_chunks().to_batches()

    scored = texts.select("uid", "doc_id", "trained", "n_tokens", "known", "base", "rare_class", "symbols").mapInArrow(
        forward, f"uid bigint, doc_id {kind}, trained boolean, n_tokens bigint, known bigint, base double, rare_class double, chain double"
    )
    far = (
        rare.select(F.col("uid").alias("of"), "word", F.col("n_tokens").alias("times"))
        .join(counts.where("word <> ''"), "word", "left")
        .groupBy("of")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))).alias("far"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("far_known"),
        )
    )
    far_sum = F.coalesce("far", F.lit(0.0))
    each = float(np.log10(total + SMOOTH * (distinct + 1)))
    return scored.join(far, F.col("uid") == F.col("of"), "left").select(
        "doc_id",
        (~F.col("trained")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + far_sum - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        (F.col("chain") + F.col("rare_class") + far_sum).alias("score"),
    ), likelihoods


def _masses(counts: DataFrame, table, endings: int) -> np.ndarray:
    """Smoothed counts of the words that share an ending's symbol, one unknown word included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, sums = table.value, np.zeros(endings)
        for b in batches:
            words = b.column("word").cast(pa.binary()).to_pylist()
            own = [(s.ending(w), n) for w, n in zip(words, b.column("n").to_pylist(), strict=True) if s.rank.get(w, s.top) >= s.top]
            if own:
                at, n = zip(*own, strict=True)
                sums += np.bincount(at, np.array(n) + SMOOTH, endings)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(endings, dtype=np.int32)), pa.array(sums)], names=["ending", "mass"])

    mass = np.full(endings, SMOOTH)
    for r in counts.where("word <> ''").mapInArrow(run, "ending int, mass double").groupBy("ending").agg(F.sum("mass").alias("mass")).collect():
        mass[r["ending"]] += r["mass"]
    return mass
