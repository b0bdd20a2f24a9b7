"""The pipeline's stages, each against a plain statement of its rule on what the stage before kept."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from dossier.llm import quality, shards, suffix  # noqa: E402

from test_llm import brute_classes, brute_cuts, collect, docs, texts, words_of  # noqa: E402, F401


def test_stages(spark, docs, texts, tmp_path, monkeypatch):  # noqa: F811
    monkeypatch.setattr(shards.pack, "__defaults__", ("text", 4000))
    monkeypatch.setattr(suffix, "SHARD", 4000)
    clean = docs.where("doc_id is not null")
    spark.createDataFrame([(1, texts[20]), (2, "none of it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean.write.parquet(f"{tmp_path}/documents.parquet")
    at, seen = clean, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        seen[name] = at
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        at = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert at.columns == docs.columns
    pairs = lambda df: Counter((r["doc_id"], r["text"]) for r in collect(df))
    good = Counter(r["doc_id"] for r in collect(quality.quality_rules(clean)) if r["kept"])
    assert Counter(r["doc_id"] for r in collect(seen["near_dedup"])) == good
    rows = [(r["doc_id"], r["text"]) for r in collect(seen["near_dedup"])]
    want, n = brute_classes(rows)
    assert seen["suffix_dedup"].count() == n and {r["doc_id"] for r in collect(seen["suffix_dedup"])} == {c for _, c in want}
    rows = [(r["doc_id"], r["text"]) for r in collect(seen["suffix_dedup"])]
    assert pairs(seen["decontamination"]) == Counter((i, bytes(x for x, c in zip(b, cut, strict=True) if not c).decode("utf-8", "ignore")) for i, b, cut in brute_cuts(rows))
    bench = words_of(texts[20])
    grams = {tuple(bench[i : i + 10]) for i in range(len(bench) - 9)}
    dirty = lambda t: any(tuple(words_of(t)[i : i + 10]) in grams for i in range(len(words_of(t)) - 9))
    assert pairs(seen["packing"]) == Counter({k: v for k, v in pairs(seen["decontamination"]).items() if not dirty(k[1])})
    assert {r["doc_id"] for r in collect(at)} == {r["doc_id"] for r in collect(seen["packing"])}
    run = collect(corpus_pipeline.run(spark, str(tmp_path)))
    assert Counter(map(str, run)) == Counter(map(str, collect(at)))


def test_odd_tables(spark, docs, tmp_path, monkeypatch):  # noqa: F811
    """Null ids, no documents, no benchmark: every stage runs and keeps its columns."""
    monkeypatch.setattr(shards.pack, "__defaults__", ("text", 4000))
    monkeypatch.setattr(suffix, "SHARD", 4000)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, rows in (("null ids", docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))), ("none", docs.where("false"))):
        at = rows
        for k, (stage, run) in enumerate(corpus_pipeline.STAGES):
            out = run(spark, at, str(tmp_path))
            out.write.parquet(f"{tmp_path}/{name}-{k}")
            before, at = at, spark.read.parquet(f"{tmp_path}/{name}-{k}")
            if stage == "near_dedup":
                assert at.count() == (brute_classes([(r["doc_id"], r["text"]) for r in collect(before)])[1] if before.count() else 0)
            if stage == "decontamination":
                assert at.count() == before.count()
            assert k == 4 or at.columns == docs.columns
        assert (at.count() > 0) == (name != "none")
