from sentilake.__main__ import parser, run

SCHEMA = "row_id bigint, review_text string, genres string, final_label string"
TEXT = """row_id,review_text,genres,final_label
1,"Very GOOD, really
good",['RPG'],positive
2,awful 10/10,['Indie'],Negative
3,,,neutral
"""


def call(spark, tmp_path, *args):
    source = tmp_path / "in.csv"
    source.write_text(TEXT)
    out = str(tmp_path / "out")
    base = ["--input", str(source), "--output", out, "--schema", SCHEMA]
    return run(spark, parser().parse_args([args[0], *base, *args[1:]])), out


def test_clean(spark, tmp_path):
    report, out = call(spark, tmp_path, "clean", "--remove-noise", "--lowercase", "--extract-tags")
    assert tuple(report.first()) == (3, 1, 3)
    rows = spark.read.csv(out, header=True, multiLine=True).orderBy("row_id").collect()
    assert [r["category"] for r in rows] == ["RPG", "Indie", "Unknown"]
    assert rows[1]["review_text"] == "awful 10 10" and rows[2]["review_text"] is None


def test_opinion_report(spark, tmp_path):
    report, out = call(spark, tmp_path, "opinion")
    assert {r["label"]: r["f1"] for r in report.collect()}["accuracy"] == 1.0
    assert spark.read.csv(out, header=True, multiLine=True).count() == 3


def test_senses(spark, tmp_path):
    spark.createDataFrame([("good", "JJ"), ("awful", "JJ")], "token string, tag string").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([("good", "a", 0, .5, 0., .5), ("awful", "a", 0, 0., .5, .5)],
                          "lemma string, pos string, sense int, p double, n double, o double").write.parquet(str(tmp_path / "s"))
    report, _ = call(spark, tmp_path, "senses", "--tags", str(tmp_path / "t"), "--senses", str(tmp_path / "s"))
    assert {r["label"]: r["f1"] for r in report.collect()}["accuracy"] == 1.0


def test_bow(spark, tmp_path):
    report, out = call(spark, tmp_path, "bow", "--max-features", "3")
    assert report.first()["documents"] == 3 and spark.read.parquet(out).count() > 0
