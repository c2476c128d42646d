"""Constraint audits of the star schema and the raw feed.

The reference declares NOT NULL, UNIQUE and FOREIGN KEY constraints that its
warehouse does not (all) enforce, and Parquet does not enforce them either.
Each audit is one aggregation per constraint (map-side partial aggregation,
then a shuffle of the partial counts only), returned as a small report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, RAW_LIMITS, UNIQUE_KEYS


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def null_counts(tables: Mapping[str, DataFrame], not_null: Mapping[str, Sequence[str]] = NOT_NULL) -> DataFrame:
    """Q1: NULLs per declared NOT NULL column; one scan per table."""
    frames = []
    for table, cols in not_null.items():
        df = tables[table]
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stack = ", ".join(f"'{c}', `{c}`" for c in cols)
        frames.append(
            counts.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, n_null)").select(
                F.lit(table).alias("table_name"), "column_name", F.col("n_null").cast("bigint")
            )
        )
    return _union(frames)


def duplicate_keys(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Keys that occur more than once (NULL keys excluded, as in UNIQUE)."""
    present = F.lit(True)
    for c in keys:
        present = present & F.col(c).isNotNull()
    k = df.where(present)
    dup = k.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    return dup.select(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.concat_ws("|", *[F.col(c).cast("string") for c in keys]).alias("key_value"),
        F.col("n_rows").cast("bigint"),
    )


def star_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    frames = []
    for t, keys in list(PRIMARY_KEYS.items()) + list(UNIQUE_KEYS.items()):
        frames.append(duplicate_keys(tables[t], keys, t))
    return _union(frames)


def product_price_conflicts(items: DataFrame) -> DataFrame:
    """H2: product names that come with more than one price in a feed."""
    g = items.groupBy("product_name").agg(F.count_distinct("price").alias("n_rows"))
    return g.where(F.col("n_rows") > 1).select(
        F.lit("item_staging").alias("table_name"),
        F.lit("product_name").alias("key_columns"),
        F.col("product_name").alias("key_value"),
        F.col("n_rows").cast("bigint"),
    )


def orphan_counts(tables: Mapping[str, DataFrame], fks=FOREIGN_KEYS) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (left anti)."""
    frames = []
    for child, ccol, parent, pcol in fks:
        c = tables[child].select(F.col(ccol).alias("_k")).where(F.col("_k").isNotNull())
        p = tables[parent].select(F.col(pcol).alias("_k"))
        orphans = c.join(p, "_k", "left_anti")
        frames.append(
            orphans.agg(F.count(F.lit(1)).alias("n_orphans")).select(
                F.lit(child).alias("child_table"),
                F.lit(ccol).alias("child_column"),
                F.lit(parent).alias("parent_table"),
                F.col("n_orphans").cast("bigint"),
            )
        )
    return _union(frames)


def length_violations(raw: DataFrame, limits: Mapping[str, int] = RAW_LIMITS) -> DataFrame:
    """P5: rows whose text exceeds the VARCHAR byte limit, per column."""
    counts = raw.agg(*[F.count_if(F.octet_length(F.col(c)) > n).alias(c) for c, n in limits.items()])
    stack = ", ".join(f"'{c}', {n}, `{c}`" for c, n in limits.items())
    return counts.selectExpr(f"stack({len(limits)}, {stack}) as (column_name, max_bytes, n_over)").select(
        "column_name", F.col("max_bytes").cast("int"), F.col("n_over").cast("bigint")
    )


def reason_counts(staged: DataFrame) -> DataFrame:
    """Q4: rejected rows per reason (good rows under reason 'ok')."""
    return staged.groupBy(F.coalesce(F.col("reason"), F.lit("ok")).alias("reason")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows")
    )
