"""Review tables in and out."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()), T.StructField("game_name", T.StringType()),
    T.StructField("app_id", T.LongType()), T.StructField("review_text", T.StringType()),
    T.StructField("review_length", T.IntegerType()), T.StructField("hours_played", T.DoubleType()),
    T.StructField("review_date", T.TimestampType()), T.StructField("owners", T.StringType()),
    T.StructField("developers", T.StringType()), T.StructField("publishers", T.StringType()),
    T.StructField("genres", T.StringType()), T.StructField("platforms", T.StringType()),
    T.StructField("categories", T.StringType()), T.StructField("release_date", T.StringType()),
    T.StructField("price", T.LongType()),
])


def read_reviews_csv(spark: SparkSession, path: str, schema: T.StructType | str = REVIEW_SCHEMA) -> DataFrame:
    """CSV with a header; quoted fields may hold line breaks and doubled quotes.

    A multi-line CSV file is one task. Large corpora should arrive as many files, or be
    written to Parquet once.
    """
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')


def read_table(spark: SparkSession, path: str, schema: T.StructType | str = REVIEW_SCHEMA) -> DataFrame:
    """Read by file extension: csv, or json holding an array of records."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "csv":
        return read_reviews_csv(spark, path, schema)
    if kind == "json":
        return spark.read.schema(schema).json(path, multiLine=True)
    raise ValueError(f"unsupported file type: {kind}")


def write_csv(df: DataFrame, path: str, index: bool = False, row_id: str = "row_id", mode: str = "error") -> None:
    """Write CSV with a header; `index` keeps the row id as the first column."""
    rest = [c for c in df.columns if c != row_id]
    cols = [row_id, *rest] if index and row_id in df.columns else rest
    df.select(*cols).write.mode(mode).csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False,
                                          ignoreTrailingWhiteSpace=False)


def with_file_order(df: DataFrame, name: str = "file_order") -> DataFrame:
    """Add a number that grows with a row's place in its file; for frames read from files.

    Rows of one file only compare with each other.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    start = F.col("_metadata.file_block_start").cast("decimal(38,0)")
    return df.withColumn(name, (start * F.lit(1 << 33).cast("decimal(12,0)") + place).cast("decimal(38,0)"))
