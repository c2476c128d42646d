"""Row-list operators.

* IN-list filter: a literal ``isin`` for short lists (Catalyst turns it into
  an ``InSet`` and pushes it into the Parquet scan); a left-semi join against
  a value frame for long lists or value frames of unknown size.
* Column-name cleaning, as the driver's named-tuple rows do.
* Bulk update from a row list: left join + ``coalesce(new, old)``; bulk
  insert: ``unionByName``.
* Update of a Parquet folder: only the files that hold a matching row are
  written anew, the others are kept as they are.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.session import materialize

# Literal lists up to this length stay in the plan as an IN predicate.
IN_LIST_MAX = 1000

# Every printable ASCII character that is neither a letter nor a digit becomes '_' in column names.
_NAME_TABLE = {c: "_" for c in range(0x20, 0x7F) if not chr(c).isalnum()}


def filter_in(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose ``column`` is in ``values`` (a sequence or a DataFrame)."""
    if isinstance(values, DataFrame):
        v = values.select(F.col(values.columns[0]).alias(column)).distinct()
        return df.join(v, column, "left_semi")
    values = list(values)
    if len(values) <= IN_LIST_MAX:
        return df.where(F.col(column).isin(values))
    v = df.sparkSession.createDataFrame([(x,) for x in values], [column]).distinct()
    return df.join(v, column, "left_semi")


def clean_name(name: str) -> str:
    """punctuation/space -> '_'; prefix 'f' before a leading '_' or digit."""
    cleaned = name.translate(_NAME_TABLE)
    leads_badly = cleaned.startswith(("_", *string.digits))
    return f"f{cleaned}" if leads_badly else cleaned


def clean_column_names(df: DataFrame) -> DataFrame:
    names = [clean_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        dup = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"column names collide after cleaning: {dup}")
    return df.toDF(*names)


def update_from_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """UPDATE target SET columns = u.columns FROM updates u WHERE keys match.

    Target rows without a matching update keep their values; update rows
    without a target row are ignored; an update to NULL sets NULL.  Several
    updates of one key: the lowest row of new values wins as a whole
    (deterministic, unlike the warehouse's arbitrary pick).
    """
    new = F.struct(*[F.col(c).alias(c) for c in columns])
    u = updates.groupBy(*keys).agg(F.min(new).alias("_new"))
    joined = target.join(u, list(keys), "left")
    for c in columns:
        value = F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c))
        joined = joined.withColumn(c, value.cast(target.schema[c].dataType))
    return joined.select(*target.columns)


@dataclass
class UpdatedFiles:
    """``frame``: the updated table; ``kept`` files stay, ``touched`` ones are replaced by the folder ``written``."""

    frame: DataFrame
    kept: list[str]
    touched: list[str]
    written: str | None


def update_files(
    spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], columns: Sequence[str], out_path: str
) -> UpdatedFiles:
    """J8 on a Parquet folder, copy on write: what is read twice and written follows the files touched.

    The first pass reads the keys only; file names, at most one per file, reach the driver.  Rules as in
    ``update_from_rows``.  ``path`` is left as it is; the caller publishes kept files and ``written`` together.
    """
    target = spark.read.parquet(path)
    hit = target.select(*keys, F.col("_metadata.file_path").alias("_file"))
    hit = hit.join(updates.select(*keys).distinct(), list(keys), "left_semi")
    plain = lambda uri: unquote(urlsplit(uri)._replace(scheme="", netloc="").geturl()) if uri.startswith("file:") else unquote(uri)
    touched = sorted({plain(r[0]) for r in hit.select("_file").distinct().collect()})
    kept = sorted({plain(f) for f in target.inputFiles()} - set(touched))
    read = spark.read.schema(target.schema)
    if not touched:
        return UpdatedFiles(target, kept, [], None)
    fresh = materialize(update_from_rows(read.parquet(*touched), updates, keys, columns), out_path)
    frame = read.parquet(*kept).unionByName(fresh) if kept else fresh
    return UpdatedFiles(frame, kept, touched, out_path)


def insert_rows(target: DataFrame, rows: DataFrame | Iterable[tuple]) -> DataFrame:
    """J8 (insert form): append a row list to a table."""
    if not isinstance(rows, DataFrame):
        rows = target.sparkSession.createDataFrame(list(rows), target.schema)
    return target.unionByName(rows)
