from checks.catalog_models import _arriving


def test_files_grow_with_the_table(spark, tmp_path):
    """One file, and so one task, holds no more of a larger table."""
    for parts, files in ((12, 12), (2, 4)):
        rows = spark.createDataFrame([(i, "x") for i in range(200)], "row_id bigint, review_text string").repartition(parts)
        assert _arriving(rows, f"{tmp_path}/{parts}") == files // 2
        assert len(list((tmp_path / str(parts)).glob("*.parquet"))) == files
        assert spark.read.parquet(f"{tmp_path}/{parts}").count() == 200


def test_a_file_holds_a_bounded_part_of_the_text(spark, tmp_path, monkeypatch):
    """Few partitions, equal and null ids: files follow the bytes of the text."""
    from checks import catalog_models
    monkeypatch.setattr(catalog_models, "ARRIVING_BYTES", 1000)
    rows = spark.createDataFrame([(None if i % 2 else 7, f"{i:04d}" * 25) for i in range(200)],
                                 "row_id bigint, review_text string").repartition(2)
    assert _arriving(rows, f"{tmp_path}/in") == 10
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/in").selectExpr("input_file_name() AS f").groupBy("f").count().collect()]
    assert sum(sizes) == 200 and len(sizes) >= 18 and max(sizes) < 40


def test_arriving_texts_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Rows of few partitions were dealt anew; each task now cuts its own into files, which keep its order."""
    from checks import catalog_models
    monkeypatch.setattr(catalog_models, "ARRIVING_BYTES", 1000)
    rows = spark.range(0, 200, 1, 2).selectExpr("id AS row_id", "repeat('x', 100) AS review_text")
    assert _arriving(rows, f"{tmp_path}/in") == 10
    spans = spark.read.parquet(f"{tmp_path}/in").selectExpr("row_id", "input_file_name() AS f").groupBy("f").agg(
        {"row_id": "max", "*": "count"}).collect()
    assert sorted(r["max(row_id)"] for r in spans) == list(range(9, 200, 10)) and {r["count(1)"] for r in spans} == {10}
    empty = spark.createDataFrame([], "row_id bigint, review_text string")
    assert _arriving(empty, f"{tmp_path}/empty") >= 1
