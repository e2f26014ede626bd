import numpy as np
from pyspark.sql import functions as F

from emberlake.llm.reference_sql import url_filter
from emberlake.llm.reputation import BAD_SHARE, LIMIT, STRENGTHS, SUFFIXES, Z, filter_urls, host_reputation, levels, page_outcome
from emberlake.llm.sharding import hilbert_index, shard, text_levels, write_shards
from emberlake.llm.topk import top_k


def brute_top_k(rows, k, scale=256):
    kept = [(i, np.floor(scale * np.array(v, float)).astype(int)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, (i, v) in enumerate(kept):
        if i % 5 == 0:
            found = sorted((-int(v @ w), j) for p, (j, w) in enumerate(kept) if p != q and len(w) == len(v))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # ties
    rows += [(3, rows[3][1]), (300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (305, [float("nan")] * 6), (310, [float("inf")] * 6),
             (None, rows[0][1]), (315, [1.0, 2.0]), (316, [0.5, -1.0]), (320, [5000.0] * 6)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, score string").repartition(5)
    for k, bins, block in ((5, 512, 4096), (3, 4, 7), (500, 64, 4096)):
        got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in
                     top_k(table, F.col("vec_id") % 5 == 0, k=k, bins=bins, query_block=block).collect())
        assert got == brute_top_k([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], k)
    assert top_k(table.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_hilbert_curve_visits_neighbours():
    side = 1 << 3
    cells = np.stack(np.meshgrid(*[np.arange(side)] * 3, indexing="ij"), -1).reshape(-1, 3)
    index = hilbert_index(cells, 3)
    assert sorted(index) == list(range(side**3))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shards_are_even_and_keep_groups(spark, tmp_path):
    rows = [(i, f"text {i} " + "w " * (i % 37), ("en", "de", None)[i % 3], f"src{i % 7}") for i in range(400)]
    rows += [(1000 + i, "a copy that is very common indeed", "en", f"src{i % 7}") for i in range(200)]
    rows += [(2000 + i, f"pair {i // 2}", "fr", f"src{i % 5}") for i in range(60)]
    rows += [(3000, None, "en", None), (3001, "", "en", "s"), (None, "no id", "en", "s"), (5, rows[5][1], "de", "src5")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, lang string, source string, shard int")
    got = shard(docs).collect()
    assert len(got) == len(rows)
    sizes = [sum(r["size"] for r in got if r["shard"] == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 0.02 * sum(sizes) / 8 + 120
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    where = {}
    for r in got:
        if r["doc_id"] and 2000 <= r["doc_id"] < 2060:
            where.setdefault((r["doc_id"] - 2000) // 2, set()).add(r["shard"])
    assert all(len(w) == 1 for w in where.values())
    assert shard(docs.limit(0)).count() == 0
    unique = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    write_shards(unique.drop("shard"), shard(unique), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == unique.count()


def test_url_rules_and_reputation(spark):
    bad, good = "spam%%% words### here$$$", "a b c d e f g h i j"
    rows = [(1, "HTTP://Ex.Example.NET/en/x?q#f", good), (2, "http://a.net/", good), (3, "http://a.net", good), (4, "http://example.net/de/", good),
            (5, "http://m.example.com/de/1", good), (6, "http://notexample.com/de/", good), (7, "https://x.org/fr/a", good), (8, None, good),
            (9, "no scheme", good), (10, "x://h?a://b/c", good), (11, "http://org/fr/", None)]
    rows += [(100 + i, f"http://spam.info/{i}", bad) for i in range(40)] + [(200 + i, f"http://good.info/{i}", good) for i in range(300)]
    rows += [(500, "http://once.info/1", bad)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(pages, page_outcome(F.col("html"))).collect()}
    assert got[1] == ("ex.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2] == ("a.net", "/", "net/", "block") and got[3] == ("a.net", "", None, "allow")
    assert got[4][2:] == ("net/", "block") and got[5][2:] == ("example.com/de/", "block") and got[6][2] is None
    assert got[7][2:] == ("org/fr/", "allow") and got[11][2:] == ("org/fr/", "allow")
    assert got[8][:2] == ("", "") and got[9][:2] == ("", "") and got[10][:2] == ("h", "")
    assert got[100][3] == "block" and got[200][3] == "allow" and got[500][3] == "allow"  # one page is no evidence
    assert filter_urls(pages.limit(0), page_outcome(F.col("html"))).count() == 0


def test_posterior_blocks_and_shields_through_domain_and_suffix(spark):
    import duckdb

    bad, good = "spam%%% words### here$$$", "a b c d e f g h i j"
    rows = [(f"http://{h}/{i}", bad if i < k else good) for h, n, k in (
        ("www.farm.co.uk", 80, 80), ("m.farm.co.uk", 60, 58), ("new.farm.co.uk", 1, 1), ("late.farm.co.uk", 1, 0),
        ("www.paper.co.uk", 90, 1), ("blog.paper.co.uk", 1, 1), ("www.shop.com.uy", 200, 2), ("mine.info", 120, 0),
        ("mirror.mine.info", 2, 2), ("uk", 5, 0), ("co.uk", 3, 0)) for i in range(n)]
    rows += [("http://mute.farm.co.uk/1", None), ("http://mute.paper.co.uk/1", "<p></p>"), ("http://nowhere.zz/", None), (None, bad), ("", None)]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id bigint, url string, html string")
    found = filter_urls(pages, page_outcome(F.col("html")))
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()}
    verdicts = {host: verdict for _, host, _, _, verdict in got}
    # One bad page, or none at all, under a bad domain; one or two bad pages under a good domain.
    assert all(verdicts[f"{h}.farm.co.uk"] == "block" for h in ("www", "m", "new", "mute"))
    assert all(verdicts[h] == "allow" for h in ("www.paper.co.uk", "blog.paper.co.uk", "mute.paper.co.uk", "mirror.mine.info", "nowhere.zz", "co.uk"))

    with duckdb.connect() as db:
        db.register("pages", pages.toPandas())
        want = db.sql(url_filter(Z, LIMIT, *STRENGTHS, BAD_SHARE, SUFFIXES)).fetchall()
    assert got == set(want) and len(want) == len(rows)

    hosts = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("uk",), ("a.b.c",), ("",)], "host string")
    assert [tuple(r) for r in hosts.select(*levels(F.col("host"))).collect()] == [
        ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("uk", "uk"), ("b.c", "c"), ("", "")]
    unlabelled = pages.select(F.col("url").alias("host"), F.lit(None).cast("bigint").alias("bad"))
    assert host_reputation(unlabelled).where("lower > 0.5 OR lower IS NULL").count() == 0


def test_text_levels_follow_whole_texts(spark):
    rng = np.random.default_rng(2)
    names = [f"https://host{i}/" for i in range(7)] + ["", "é", None]
    rows = [names[i] for i in rng.integers(0, len(names), 300)] + [names[3]] * 150
    table = spark.createDataFrame([(x,) for x in rows], "v string").repartition(5)
    got = {r["v"]: r["level"] for r in text_levels(table, "v", 4).collect()}
    known = sorted((x for x in rows if x is not None), key=lambda x: x.encode())
    middle = {x: (known.index(x) + known.count(x) / 2) * 16 / len(known) for x in set(known)}
    assert got == {x: int(m) for x, m in middle.items()} and len(set(got.values())) > 5
    assert text_levels(table.limit(0), "v", 4).count() == 0

    docs = spark.createDataFrame([(i, f"t{i}", x) for i, x in enumerate(rows)], "doc_id bigint, text string, source string")
    curves = {(r["source"], r["curve"]) for r in shard(docs, dimensions=("source",)).join(docs, "doc_id").collect()}
    assert len({c for _, c in curves}) > 5
