import random

import corpus_pipeline
from emberlake.llm import queries
from emberlake.llm.common import staged


def test_stages_act_on_what_their_predecessors_kept(spark, tmp_path):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    prose = lambda n: " ".join(word() for _ in range(n))
    toxic = lambda n: " ".join(rng.choice(["jerk", "fool", "idiot"]) if rng.random() < 0.15 else word() for _ in range(n))
    texts = {i: toxic(80) if i % 6 == 0 else prose(80) for i in range(300)}
    item = prose(40)
    texts |= {1000: texts[7], 1001: texts[7] + " tail", 1002: f"{prose(20)} {item} {prose(20)}", 1003: f"{prose(10)} token = {'ab12' * 8} end"}
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in texts.items()] + [(1004, None, None, None, None), (1005, "", "en", "s", 0), (1004, None, None, None, None)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(300)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, folder), f"test-{name}")
        assert docs.columns == columns
        kept[name] = docs.select("doc_id", "text", "n_chars").collect()
    ids = {name: sorted(r["doc_id"] for r in found) for name, found in kept.items()}
    clean = sorted([i for i in texts if i % 6 or i >= 1000] + [1004, 1004, 1005])
    assert ids["toxicity"] == clean
    assert ids["ngram_jaccard_join"] == [i for i in clean if i not in (1000, 1001)]
    assert ids["benchmark_decontamination"] == [i for i in clean if i not in (1000, 1001, 1002)]
    assert ids["secret_scans"] == ids["benchmark_decontamination"]
    last = {r["doc_id"]: r for r in kept["secret_scans"]}
    assert "ab12ab12" not in last[1003]["text"] and "[secret]" in last[1003]["text"] and last[1003]["n_chars"] == len(last[1003]["text"])
    assert last[7]["text"] == texts[7] and last[1004]["n_chars"] is None
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(ids["secret_scans"])


def test_every_operator_is_registered():
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "best_fit_packing"]
