"""CSV sources and sinks.

* Raw sales feed: headerless, seven positional text columns, PERMISSIVE with
  a corrupt-record column (wrong column count, broken quoting).  Doubled
  quotes escape a quote, as in the warehouse CSV convention.
* Item CSV: header line, typed schema.
* Local-variant feed: header line, names from the file, schema given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.schemas import CORRUPT_COL, ITEMS, LOCAL_FEED, RAW_SCAN
from tillstar.session import configure


def raw_csv_reader(spark: SparkSession, multi_line: bool = False):
    configure(spark)  # CSV column pruning off: the verdict must not depend on the projection
    return (
        spark.read.schema(RAW_SCAN)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .option("quote", '"')
        .option("escape", '"')
        .option("header", False)
        .option("multiLine", multi_line)
    )


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Headerless raw feed -> 7 text columns + ``_corrupt_record`` + file path.

    ``multi_line`` reads line breaks inside quotes; a file is then one task's
    work, so large files of such a feed have to be split where they are made.
    """
    df = raw_csv_reader(spark, multi_line).csv(path)
    return df.withColumn("file_path", F.col("_metadata.file_path"))


def write_items_csv(items: DataFrame, path: str) -> None:
    """Item lines as CSV with a header line."""
    items.select("transaction_id", "product_name", "price", F.col("flavour_name").alias("flavour")).write.mode(
        "overwrite"
    ).option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    """Item CSV skipping its header; an empty flavour is the '' member."""
    df = spark.read.schema(ITEMS).option("header", True).option("escape", '"').csv(path)
    return df.withColumn("flavour", F.coalesce(F.col("flavour"), F.lit("")))


def write_header_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_header_csv(spark: SparkSession, path: str, schema: T.StructType | None = LOCAL_FEED, infer: bool = False) -> DataFrame:
    """S3: header CSV, columns by the names in the file.

    With a schema (the default) its columns are picked by name, whatever their
    order in the file, and cast; other columns are dropped, a column the file
    lacks fails.  Every file's header has to equal the first one's.  Types are
    inferred only on request.
    """
    r = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False)
    if schema is None or infer:
        return r.option("inferSchema", True).csv(path)
    df = r.csv(path)
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"header of {path} lacks the columns {missing}")
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def write_text_lines(lines: DataFrame, path: str) -> None:
    """Write pre-rendered CSV lines (column ``value``) as text files."""
    lines.select("value").write.mode("overwrite").text(path)
