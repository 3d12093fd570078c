"""The pipeline over small tables with planted cases."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from stopclock.llm import bpe
from tests.llm.test_operators import prose

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def junk(seed):
    return " ".join(w.upper() + "!!" for w in prose(seed, 60).split())


def planted(spark, folder):
    item = prose(900, 30)
    clean = {i: prose(i, 80) for i in range(100)}
    rows = dict(clean)
    rows |= {100 + i: junk(i) for i in range(60)}
    rows |= {200: clean[3], 201: clean[3], 202: clean[4].replace(clean[4].split()[40], "changed", 1)}
    rows |= {210: f"{prose(50_000, 40)} {item} {prose(50_001, 40)}", 211: f"{prose(50_002, 60)} mail ann@example.org now"}
    rows |= {220: None, 221: ""}
    docs = [(i, t, "en", "src", len(t or "")) for i, t in rows.items()]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < 100), 0) for i in range(160)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_planted_cases_go_and_clean_documents_stay(spark, tmp_path):
    folder = str(tmp_path)
    rows = planted(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "encoding":
            assert docs.columns == columns
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        left[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert set(range(100)) <= left["quality"] and not left["quality"] & set(range(100, 160))
    assert left["quality"] - left["near_duplicates"] >= {200, 201, 202} and set(range(100)) <= left["near_duplicates"]
    assert left["near_duplicates"] - left["decontamination"] == {210}
    assert left["encoding"] == left["personal_data"] == left["decontamination"]
    text = {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decode(docs, RANKS).collect()}
    assert text[211].count("[EMAIL]") == 1 and "@" not in text[211]
    assert all(text[i] == rows[i] for i in range(100))
    whole = corpus_pipeline.run(spark, folder)
    assert {(r["doc_id"], tuple(r["ids"])) for r in whole.collect()} == {(r["doc_id"], tuple(r["ids"])) for r in docs.collect()}


def test_empty_tables_give_an_empty_result(spark, tmp_path):
    folder = str(tmp_path)
    planted(spark, f"{folder}/full")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/full/{name}.parquet").limit(0).write.parquet(f"{folder}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0
