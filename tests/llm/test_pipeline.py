"""The pipeline stage by stage on a small table, and the queries' names."""

import random

import pytest

pytest.importorskip("public_tokenizers")

rng = random.Random(11)


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    import corpus_pipeline

    words = [f"w{k}" for k in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = " ".join(f"q{k}" for k in range(30))
    base = "\n".join(text(30) for _ in range(4))
    docs = [(k, text(90)) for k in range(30)] + [(40, base), (41, base), (50, text(60) + " " + item), (60, "few"), (61, None)]
    junk = [(70 + k, " ".join(w + "%%%" for w in text(90).split())) for k in range(12)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs + junk]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(20)] + [(70 + k, 0, 0) for k in range(8)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, left = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        left[name] = {r["doc_id"] for r in now.select("doc_id").collect()}
        if name != "bpe":
            assert now.columns == list(corpus_pipeline.COLUMNS)
    clean = set(range(30)) | {40}
    assert left["quality"] == clean | {41, 50} and left["line_dedup"] == left["quality"]
    assert left["decontamination"] == left["near_dedup"] - {50} and clean <= left["bpe"]


def test_a_stage_drops_the_shuffle_files_of_the_one_before(spark, tmp_path):
    import time

    import corpus_pipeline

    def kept():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if "shuffle_" in f}

    docs = spark.range(50).selectExpr("id AS doc_id", "concat('w', id, ' a') AS text", "'en' AS lang", "'s' AS source", "5L AS n_chars")
    docs.repartition(3, "doc_id").write.parquet(f"{tmp_path}/docs")
    before = kept()
    assert before
    corpus_pipeline.tokenize(spark, spark.read.parquet(f"{tmp_path}/docs"), str(tmp_path))
    deadline = time.time() + 20
    while kept() & before and time.time() < deadline:
        time.sleep(0.2)
    assert not kept() & before


def test_names():
    import __spark_entry__

    assert {n.split("_")[0] for n in __spark_entry__.queries() if n.startswith("op")} == {f"op{k}" for k in range(1, 11)}
    assert "pipeline" in __spark_entry__.queries()
