import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from emberlake.llm.packing import best_fit, improve, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            out.append((str(doc), k, start, len(part), zlib.crc32(part.tobytes())))
    return sorted(out)


def verify(spark, rows, capacity, **options):
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id bigint, text string, sequence_id int")
    got = pack(docs, PATH, capacity=capacity, keep_ids=True, **options).collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected(rows, capacity)
    sequences = {}
    for r in got:
        assert len(r["ids"]) == r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r["length"] for r in got)


def test_pieces_and_places(spark):
    rng = random.Random(2)
    words = ["Hello", "wörld's", "x\x1cy", "a\u00a0b", "don't", "123abc", "émile,", "%%%", "line\u2028sep", "tab\tbed", "İx", "ΑΣ", "İ.", "É,", "x,,", "Z's.", "5.", "<|ENDOFTEXT|>", "a,."]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) + rng.choice(["", "\n", "\r\nz"])) for i in range(150)]
    rows += [(1, None), (2, ""), (2, ""), (None, "no id"), (900, "long " * 500)]
    count, total = verify(spark, rows, 64)
    assert count == -(-total // 64)
    count, total = verify(spark, rows, 64, block=40, rounds=3)
    assert count <= 1.02 * total / 64 + 1
    assert verify(spark, [], 64) == (0, 0)


@pytest.mark.parametrize("seed", range(4))
def test_local_search_beats_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(150, 520, 400)  # two or three a bin: best fit wastes much
    bins = best_fit(lengths, 1000)
    better = improve(bins, lengths, 1000)
    assert sorted(i for b in better for i in b) == list(range(400))
    assert all(lengths[b].sum() <= 1000 for b in better)
    assert len(better) <= len(bins)
    assert sum(int(lengths[b].sum()) ** 2 for b in better) >= sum(int(lengths[b].sum()) ** 2 for b in bins)


def test_words_come_back_from_the_older_half(monkeypatch):
    """However often the remembered words are turned over, the ids are the tokenizer's."""
    from emberlake.llm import packing

    monkeypatch.setattr(packing, "CACHED", 3)
    words, tokenizer = packing._Words(PATH), Tokenizer.from_file(PATH)
    batches = [["one two"], ["Two, three one."], ["four five six"], ["two one", "SIX, seven"], ["one. two"]]
    for texts in batches:
        want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert words.ids(texts) == want
