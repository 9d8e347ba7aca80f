import random

import corpus_brute as brute
import pytest

import corpus_pipeline
from lossmill.session import scratch_path


def sentence(rng, n):
    return " ".join(rng.choice(brute.VOCABULARY) + str(rng.randrange(1000)) for _ in range(n))


def test_stages(spark, table):
    rng = random.Random(8)
    folder = scratch_path(spark, "test-pipeline")
    texts = {i: sentence(rng, 60) for i in range(80)}
    item, shared = sentence(rng, 30), sentence(rng, 55)
    texts |= {100: texts[3], 101: texts[4] + " more"}  # copies
    texts |= {102: sentence(rng, 40) + " " + item}  # benchmark
    texts |= {103: sentence(rng, 40) + " " + shared, 104: shared + " " + sentence(rng, 70)}  # a passage twice
    texts |= {i: " ".join(w.upper() + "!!" for w in sentence(rng, 50).split()) for i in range(200, 240)}  # rejected
    texts |= {300: None, 301: ""}
    table(texts.items()).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 200)) for i in texts]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    docs, ids = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = scratch_path(spark, "test-stage")
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.columns == columns
        ids[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    good = {i for i in texts if i < 200}
    assert good <= set(ids["quality"]) and not set(range(200, 240)) & set(ids["quality"])
    assert set(ids["quality"]) - set(ids["near_dedup"]) == {100, 101}
    assert ids["substring_dedup"].keys() == ids["near_dedup"].keys()
    assert ids["substring_dedup"][103] == texts[103] and shared not in ids["substring_dedup"][104]
    assert len(ids["substring_dedup"][104].split()) == 70
    assert ids["substring_dedup"].keys() - ids["decontamination"].keys() == {102}
    packed = corpus_pipeline.packing(spark, docs, folder)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids["decontamination"].keys()
    assert corpus_pipeline.run(spark, folder).count() == packed.count()


def test_repeated_rows(spark, odd):
    folder = scratch_path(spark, "test-pipeline")
    odd.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = {(r.doc_id) for r in corpus_pipeline.run(spark, folder).select("doc_id").collect()}
    assert 5 in found and 2 in found


@pytest.mark.parametrize("repeated", [False, True])
def test_columns_named_like_those_of_the_stage(spark, repeated):
    shared = " ".join(f"w{i}" for i in range(30))
    rows = [(1, shared, 1, "a", "b"), (2, f"x {shared}", 2, "c", "d"), (2 if repeated else 3, "alone", 3, "e", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, own_id long, own_text string, shorter_text string")
    found = corpus_pipeline.substring_dedup(spark, docs, "")
    assert found.columns == docs.columns
    assert sorted((r.text, r.own_id, r.own_text, r.shorter_text) for r in found.collect()) == sorted(
        [(shared, 1, "a", "b"), ("x", 2, "c", "d"), ("alone", 3, "e", "f")]
    )
