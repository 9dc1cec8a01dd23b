"""Command line: clean a review file, score it with the sense lexicon, or count its words.

    python -m sentilake clean  --input in.csv --output out --text-col review_text --lowercase --remove-noise
    python -m sentilake senses --input in.csv --output out --tags tags.parquet --senses senses.parquet
    python -m sentilake opinion --input in.csv --output out --true-col final_label
    python -m sentilake bow    --input in.csv --output out --min-df 2 --max-df 0.95
"""
from __future__ import annotations

import argparse
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentilake.operators import features, lexicon, metrics, senses
from sentilake.operators.cleaning import CleaningConfig, CleaningResources, clean, cleaning_summary
from sentilake.session import build_session
from sentilake.sources.reviews import read_table, write_csv

STEPS = [f.name for f in fields(CleaningConfig)]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sentilake")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        p.add_argument("--input", required=True, help="csv or json review file, with a header and a row_id column")
        p.add_argument("--output", required=True)
        p.add_argument("--schema", required=True, help="DDL of the input, e.g. 'row_id bigint, review_text string'")
        p.add_argument("--text-col", default="review_text")
        return p

    c = command("clean")
    c.add_argument("--category-col", default="genres")
    for step in STEPS:
        c.add_argument("--" + step.replace("_", "-"), action="store_true")
    for table in ("translations", "dictionary", "fallback-dictionary", "lemmas", "lemma-exceptions"):
        c.add_argument(f"--{table}-table", help="parquet")
    s = command("senses")
    s.add_argument("--tags", required=True, help="parquet (token, tag)")
    s.add_argument("--senses", required=True, help="parquet (lemma, pos, sense, p, n, o)")
    s.add_argument("--threshold", type=float, default=0.05)
    o = command("opinion")
    o.add_argument("--threshold", type=float, default=0.5)
    for p in (s, o):
        p.add_argument("--true-col", default="final_label")
    b = command("bow")
    b.add_argument("--max-features", type=int, default=features.MAX_FEATURES)
    b.add_argument("--min-df", type=int, default=1)
    b.add_argument("--max-df", type=float, default=1.0)
    return top


def _table(spark: SparkSession, path: str | None) -> DataFrame | None:
    return None if path is None else spark.read.parquet(path)


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Run a command; the returned frame is the printed report."""
    rows = read_table(spark, args.input, args.schema)
    if args.command == "clean":
        config = CleaningConfig(**{step: getattr(args, step) for step in STEPS})
        resources = CleaningResources(
            translations=_table(spark, args.translations_table), dictionary=_table(spark, args.dictionary_table),
            fallback_dictionary=_table(spark, args.fallback_dictionary_table), lemmas=_table(spark, args.lemmas_table),
            lemma_exceptions=_table(spark, args.lemma_exceptions_table))
        category = args.category_col if args.category_col in rows.columns else None
        done = clean(rows, config, resources, args.text_col, category)
        write_csv(done, args.output, index=True)
        return cleaning_summary(done, args.text_col, "category" if "category" in done.columns else args.text_col)
    if args.command == "bow":
        vocabulary = features.fit_vocabulary(rows, args.text_col, max_features=args.max_features, min_df=args.min_df,
                                             max_df=args.max_df, kind="words1")
        features.bow_counts(rows, vocabulary, args.text_col, kind="words1").write.parquet(args.output)
        return features.bow_stats(rows, vocabulary, args.text_col, kind="words1")
    if args.command == "senses":
        scores = senses.score_senses(rows, spark.read.parquet(args.tags), spark.read.parquet(args.senses), args.threshold,
                                     args.text_col, label_case="title")
        done, predicted = rows.join(scores, "row_id"), "swn_label"
    else:
        done = lexicon.lexicon_scores(rows, text_col=args.text_col, threshold=args.threshold)
        predicted = "predicted_label"
    write_csv(done, args.output, index=True)
    if args.true_col not in rows.columns:
        return done.groupBy(predicted).agg(F.count(F.lit(1)).alias("count"))
    return metrics.classification_report(done, args.true_col, predicted, ignore_case=True)


def main() -> None:
    args = parser().parse_args()
    run(build_session(), args).show(50, truncate=False)


if __name__ == "__main__":
    main()
