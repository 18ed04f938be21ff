"""The pipeline's stages against plain versions of what they must do."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from sublens.llm import quality
from sublens.llm.queries import op7_decontaminate
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, at = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        at[name] = (docs, docs := spark.read.parquet(str(tmp_path / name)))
        if name != "token_files":
            assert docs.columns == columns

    def ids(df):
        return sorted(r[0] for r in df.select("doc_id").collect())

    before, after = at["quality_filter"]
    scored = quality.classify(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(after) == ids(scored.filter("score >= 0.7")) and len(ids(after)) < before.count()
    before, after = at["near_duplicates"]
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in before.collect()]
    assert ids(after) == sorted({c for _, _, c in plain_components(rows)}) and len(ids(after)) < len(rows)
    before, after = at["decontamination"]
    bad = {r["doc_id"] for r in op7_decontaminate(spark, SF).filter("contaminated").collect()}
    assert ids(after) == [i for i in ids(before) if i not in bad]
    before, after = at["mixture"]
    assert set(ids(after)) == set(ids(before))
    assert after.exceptAll(before.join(after.select("doc_id"), "doc_id").select(after.columns)).count() == 0
    words = after.groupBy("lang").agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).collect()
    total = sum(r["n"] for r in words)
    assert {r["lang"]: round(r["n"] / total, 1) for r in words}["en"] <= 0.5
    before, after = at["token_files"]
    assert ids(after) == ids(before)
    start = 0
    for r in after.orderBy("start").collect():
        assert r["start"] == start
        start += r["n_tokens"]


def test_run_on_edge_rows(spark, tmp_path):
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (2, "", None, None, None), (None, "Some words here", "de", "b", 3),
            (4, "long " * 50_000, "en", "c", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, part in (("some", df), ("none", df.limit(0))):
        d = tmp_path / name
        part.write.parquet(str(d / "documents.parquet"))
        spark.createDataFrame([(1, 1, 0), (4, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
        spark.createDataFrame([(1, "some words here")], "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
        out = corpus_pipeline.run(spark, str(d))
        assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        out.collect()


def test_mixture_keeps_every_id_beside_soft_documents(spark, tmp_path):
    """Short and mixed texts get soft posteriors; no document of the large language may go for them."""
    rng = random.Random(4)
    words = {d: [f"{d}{i}" for i in range(60)] for d in ("en", "de", "fr", "es")}
    rows = []
    for i in range(1500):
        lang = rng.choices(list(words), [70, 10, 10, 5])[0]
        if i % 5:
            text = rng.choices(words[lang], k=60)
        else:                                            # one or two words of each of two languages
            text = [rng.choice(words[d]) for d in ("en", rng.choice(["de", "fr", "es"]))]
        rows.append((i, " ".join(text), lang, "a", 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.mixture(spark, df, str(tmp_path))
    assert {r[0] for r in out.select("doc_id").collect()} == set(range(1500))
