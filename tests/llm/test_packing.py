import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.queries import TOKENIZER


def best_fit_decreasing(counts, capacity):
    gaps = []
    for n in sorted(Counter(counts).elements(), reverse=True):
        fits = [g for g in gaps if g >= n]
        gap = min(fits) if fits else capacity
        if fits:
            gaps.remove(gap)
        gaps.append(gap - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(30))
def test_plan_places_every_piece_and_is_as_good_as_best_fit(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 30, 100, 1024])
    counts = Counter(rnd.randint(1, capacity) for _ in range(rnd.choice([0, 1, 9, 300])))
    plan = packing.plan_bins(dict(counts), capacity)
    placed = Counter()
    for bins, filled in plan:
        assert bins > 0 and sum(filled) <= capacity
        assert sum(3 * n > capacity for n in filled) <= 2
        for n in filled:
            placed[n] += bins
    assert placed == counts
    assert sum(b for b, _ in plan) <= best_fit_decreasing(counts, capacity)


def test_ids_are_those_of_the_tokenizer():
    rnd = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "b's", " it's", "é", "日本", "1", "23", "!", "?!", "\x00", "<|endoftext|>", "\r\n", "　", " \n", "Word", " word,"]
    ids, whole = packing._Ids(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9)))
        assert np.frombuffer(ids.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_ids_of_long_runs_and_of_whole_texts_are_those_of_the_tokenizer():
    ids, whole = packing._Ids(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    assert ids.ranks is not None
    rnd = random.Random(6)
    texts = ["a" * 5_000, " " * 3_000 + "x", "\n" * 2_000, "é" * 1_500, "word " * 20_000, "x" + "1" * 1_200 + " y", ""]
    texts += ["".join(chr(rnd.choice([32, 32, rnd.randint(33, 126), rnd.randint(161, 0x2FFF), rnd.randint(0x1F300, 0x1F6FF)])) for _ in range(400)) for _ in range(300)]
    for text in texts:
        assert np.frombuffer(ids.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_another_vocabulary_is_left_to_its_tokenizer():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    ids, whole = packing._Ids(path), Tokenizer.from_file(path)
    assert ids.ranks is None
    assert np.frombuffer(ids.encode("Some words, and more"), "<u4").tolist() == whole.encode("Some words, and more", add_special_tokens=False).ids


def packed(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, length int, piece string")
    return packing.pack(packing.token_pieces(docs, TOKENIZER, **more), more.get("capacity", 1024)).collect()


def test_pieces_and_sequences(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["alpha", "be", "c,"]) for _ in range(rnd.randint(0, 90)))) for i in range(80)]
    rows += [(80, None), (81, ""), (82, "word " * 500), (3, "same"), (3, "same"), (None, "no id")]
    got = packed(spark, rows, capacity=64)
    whole = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for doc_id, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(doc_id, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 64
    assert len(places) <= best_fit_decreasing(Counter(r.length for r in got), 64)


def test_empty_table_and_wrong_length(spark):
    assert packed(spark, []) == []
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 2000)], "doc_id long, piece int, length long"))


@pytest.mark.parametrize("held", [0, 1_000])
def test_numbers_of_tasks_are_put_one_behind_another(spark, monkeypatch, held):
    """Whether tasks hold the table of first numbers or it is joined; a length that most pieces share, in many tasks."""
    monkeypatch.setattr(packing, "HELD_FIRSTS", held)
    pieces = spark.range(500).repartition(7).selectExpr("id AS doc_id", "0 AS piece", "IF(id % 50 = 0, 7, 300) AS length")
    got = packing.pack(pieces, 1024).collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == 500 and len({r.sequence_id for r in got}) == 164
    ends = defaultdict(list)
    for r in got:
        ends[r.sequence_id].append((r.offset, r.offset + r.length))
    assert all([a for a, _ in sorted(e)] == [0, *[b for _, b in sorted(e)][:-1]] for e in ends.values())


def test_registered_runs_pack_the_ids(spark, tmp_path, monkeypatch):
    """The pipeline's last stage returns the ids, and the query's digest is that of the packed ids."""
    import corpus_pipeline
    from millrace.llm import queries

    rows = [(i, "some words, " * i) for i in range(30)] + [(40, None), (41, "word " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    whole = Tokenizer.from_file(TOKENIZER)
    want = {}
    for r in corpus_pipeline.packed(spark, docs, str(tmp_path)).collect():
        ids = whole.encode(dict(rows)[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length]
        want[(r.doc_id, r.piece)] = zlib.crc32(r.ids)
    packs = []
    pack = packing.pack
    monkeypatch.setattr(packing, "pack", lambda p: packs.append(p.columns) or pack(p))
    got = queries.op2_packing(spark, str(tmp_path))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert {(r.doc_id, r.piece): r.ids_crc32 for r in got.collect()} == want and "ids" in packs[0]
