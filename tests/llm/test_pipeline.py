import corpus_pipeline
from tests.llm.helpers import edge_documents, edge_rows, empty_documents

import pytest


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    passage = "green stone walks quickly under the bridge of morning light and that river house"
    rows = edge_rows() + [(700, f"a text with {passage} in it", "en", "s0", 1)]
    edge_documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stash(stage(spark, docs, folder), "test")
        assert docs.columns == columns
        seen[name] = docs.collect()
    ids = {name: {r["doc_id"] for r in rows} for name, rows in seen.items()}
    assert not ids["language"] & {100, 101, 102, 104} and set(range(40)) <= ids["language"]
    texts = [r["text"] for r in seen["near_duplicates"]]
    assert len(texts) == len(set(texts)) and 200 not in ids["near_duplicates"]
    assert ids["near_duplicates"] - ids["decontaminate"] == {700}
    assert {r["text"] for r in seen["mix"]} <= {r["text"] for r in seen["decontaminate"]} and len(seen["mix"]) > len(seen["decontaminate"])


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 0


def test_empty_table(spark, tmp_path):
    empty_documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
