import hashlib
import random
from collections import Counter
from pathlib import Path

from emberlake.llm import repeats
from emberlake.llm.repeats import merge_spans, remove_repeats


def brute(texts, threshold):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + threshold] for d in data for i in range(len(d) - threshold + 1))
    for d in data:
        spans = [(i, i + threshold) for i in range(len(d) - threshold + 1) if seen[d[i : i + threshold]] > 1]
        yield len(d), merge_spans(spans)


def check(spark, rows, threshold, depth, group=256):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, spans string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), bytes(r["kept"]))
                 for r in remove_repeats(docs, threshold=threshold, depth=depth, group=group).collect())
    want = []
    for (i, t), (n, spans) in zip(rows, brute([t for _, t in rows], threshold)):
        data, keep, at = (t or "").encode(), b"", 0
        for s, e in spans:
            keep += data[at:s]
            at = e
        want.append((i is None, i or 0, n, tuple(spans), keep + data[at:]))
    assert got == sorted(want)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


def test_shared_passages_match_brute_force(spark):
    rng = random.Random(3)
    passages = [prose(rng, n) for n in (8, 12, 20, 40)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 25))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(rng, rng.randint(0, 6))]
        rows.append((i, " ".join(parts)))
    check(spark, rows, 40, 13)
    check(spark, rows, 40, 13, group=2)  # every group split
    check(spark, rows, 60, 50)


def test_hot_passage_meets_in_no_python_group(spark, monkeypatch):
    from pyspark.sql.group import GroupedData

    def whole_group(*_, **__):
        raise AssertionError("all rows of a group are handed to one task")

    monkeypatch.setattr(GroupedData, "applyInPandas", whole_group)
    rng = random.Random(11)
    passage = prose(rng, 40)[:60]  # a little over the threshold, its surroundings differ in every row
    check(spark, [(i, prose(rng, 12) + passage + prose(rng, 12)) for i in range(300)], 50, 20)


def test_edges(spark):
    rng = random.Random(5)
    long = prose(rng, 400)
    rows = [(1, None), (2, ""), (3, "short"), (4, "a" * 200), (5, "ab" * 150), (6, long), (7, long), (7, long),
            (None, long), (None, None), (8, long[:100] + "!" + long[100:]), (9, "x" * 50), (10, "x" * 49)]
    check(spark, rows, 50, 20)
    check(spark, [], 50, 20)


def test_long_text_is_handled_in_chunks(spark, monkeypatch):
    import emberlake.llm.repeats as m

    rng = random.Random(7)
    a, b = prose(rng, 300), prose(rng, 300)
    data = [(1, prose(rng, 50) + a + prose(rng, 20) + b), (2, a + b), (3, b + prose(rng, 9) + a)]
    monkeypatch.setattr(m, "CHUNK", 64)
    import numpy as np

    for _, t in data:
        starts, counts, *_ = m.runs_of(np.frombuffer(t.encode(), np.uint8), 50, 20)
        assert starts[0] == 0 and counts.sum() == len(t.encode()) - 49
    check(spark, data, 50, 20)


def test_digest_is_of_kept_bytes(spark):
    docs = spark.createDataFrame([(1, "héllo")], "doc_id bigint, text string")
    row = remove_repeats(docs).collect()[0]
    assert hashlib.sha256(bytes(row["kept"])).hexdigest() == hashlib.sha256("héllo".encode()).hexdigest()


def test_complementary_words_are_not_repeats(spark):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = word.translate(str.maketrans("ab", "ba"))
    check(spark, [(1, word[:1024]), (2, other[:1024])], 1024, 8)
    check(spark, [(1, "x" + word), (2, "y" + other), (3, word[512:1600])], 1024, 128)


def test_steps_are_gone_before_windows_are_listed(spark, monkeypatch):
    places, left = {}, []
    keep = repeats.staged

    def staged(df, label):
        if label == "hashes":
            left.extend(name for name, place in places.items() if Path(place.removeprefix("file:")).exists())
        found = keep(df, label)
        places[label] = found._place
        return found

    monkeypatch.setattr(repeats, "staged", staged)
    check(spark, [(1, "abcdefgh" * 9), (2, "xy" + "abcdefgh" * 8), (3, None)], 40, 16)
    assert sorted(left) == ["wanted", "whole"]
