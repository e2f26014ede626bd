import random
import re

from emberlake.llm.common import recorded
from emberlake.llm.components import components
from emberlake.llm.jaccard import one_of_each, similar_components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((str(doc), len(sets[i]), str(doc if not sets[i] else least.get(find(i)))) for i, (doc, _) in enumerate(rows))


def found(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, component string")
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in similar_components(docs, counters=1 << 12).collect())


def family(rng, n, copies, edits):
    base = [f"w{rng.randint(0, 500)}" for _ in range(n)]
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"z{rng.randint(0, 10**6)}"
        out.append(" ".join(words))
    return out


def test_components_match_brute_force(spark):
    rng = random.Random(1)
    texts = []
    for n, copies, edits in ((150, 40, 6), (60, 25, 3), (300, 12, 14), (30, 20, 2), (12, 15, 1)):
        texts += family(rng, n, copies, edits)
    line = " ".join(f"c{i}" for i in range(30))  # a passage that many texts share
    texts += [line + " " + " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(rng.choice((3, 8, 30)))) for _ in range(40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(spark, rows) == brute(rows)


def test_bridges_between_clusters_are_found(spark):
    rng = random.Random(9)
    fresh = lambda n: [f"t{rng.randint(0, 10**9)}" for _ in range(n)]
    texts = []
    for _ in range(60):  # b links with a1 alone, at 86 of 114; a2 is a copy of a1 that lacks 6 of them
        a1 = fresh(104)
        a2 = a1[:40] + fresh(2) + a1[42:]
        texts += [a1, a2, a1[:90] + fresh(14)]
    for _ in range(15):  # clusters in a row, each bridged to the next by its first text
        base = fresh(104)
        for step in range(4):
            texts.append(base)
            for _ in range(rng.randint(0, 3)):
                at, n = rng.randrange(10, 90), rng.randint(1, 2)
                texts.append(base[:at] + fresh(n) + base[at + n:])
            keep = rng.choice((90, 91))
            base = base[:keep] + fresh(104 - keep) if step % 2 else fresh(104 - keep) + base[-keep:]
    texts = [" ".join(t) for t in texts]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in similar_components(docs, counters=1 << 20).collect())
    assert got == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (6, "one two three"),
            (7, "É a b c d"), (8, "é a b c d"), (None, "alone here"), (None, "one two"), (9, "x " * 30), (10, "x " * 40)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "other words here"), (4, ""), (4, ""), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in one_of_each(docs, counters=1 << 12).collect()) == [1, 2, 4, 4, 5]


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_stars_take_no_turn(spark):
    """A turn more would only repeat its plans, which the driver holds."""
    edges = spark.createDataFrame([(i, 0) for i in range(1, 40)] + [(100, 99), (101, 99)], "a bigint, b bigint")
    tables = []
    with recorded(tables):
        got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(40)}, 99: 99, 100: 99, 101: 99} and len(tables) == 1


def test_words_of_complementary_patterns_differ(spark):
    """Polynomial hashes modulo 2^64 cannot tell these words apart, whatever their base."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, word), (2, other), (3, f"{word} {other}")], "doc_id bigint, text string")
    rows = similar_components(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {1: 1, 2: 2, 3: 3}
