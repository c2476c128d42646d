"""Incremental constraint audit of one loaded batch (Q1-Q3 scoped to new rows).

Whole-table audits (``operators.quality``) rescan every table.  After a load
only the batch's own rows can introduce a violation, so this audit reads the
batch's partitions (static partition filter) and checks them against the
visible tables:

* NOT NULL on the batch rows;
* uniqueness: keys of batch rows that occur more than once among all rows
  (the full table is semi-joined with the batch's keys first, so only rows
  sharing a key with the batch are grouped);
* foreign keys: batch child rows whose parent is missing.  Ids grow with every
  batch, so the parent scan is bounded to the child's id range, a filter that
  reaches the Parquet reader and skips the row groups of older batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.operators import quality as Q
from tillstar.plans.load import Warehouse
from tillstar.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, STAR_TABLES, UNIQUE_KEYS


def batch_rows(wh: Warehouse, table: str, batch_id: int) -> DataFrame:
    return wh.batch_rows(table, batch_id).drop("batch_id", "attempt")


def audit_batch(wh: Warehouse, batch_id: int) -> dict[str, DataFrame]:
    new = {t: batch_rows(wh, t, batch_id) for t in STAR_TABLES}
    full = {t: wh.read(t, also=batch_id, exclude=batch_id) for t in STAR_TABLES}

    nulls = Q.null_counts(new, NOT_NULL)

    dups = []
    for t, keys in list(PRIMARY_KEYS.items()) + list(UNIQUE_KEYS.items()):
        touched = full[t].join(new[t].select(*keys).distinct(), keys, "left_semi")
        dups.append(Q.duplicate_keys(touched, keys, t))
    duplicates = dups[0]
    for d in dups[1:]:
        duplicates = duplicates.unionByName(d)

    frames = []
    for child, ccol, parent, pcol in FOREIGN_KEYS:
        c = new[child].select(F.col(ccol).alias("_k")).where(F.col("_k").isNotNull())
        lo_hi = c.agg(F.min("_k").alias("lo"), F.max("_k").alias("hi")).first()
        p = full[parent].select(F.col(pcol).alias("_k"))
        if lo_hi["lo"] is not None:
            p = p.where(F.col("_k").between(lo_hi["lo"], lo_hi["hi"]))
        n = c.join(p, "_k", "left_anti").agg(F.count(F.lit(1)).alias("n_orphans"))
        frames.append(n.select(
            F.lit(child).alias("child_table"), F.lit(ccol).alias("child_column"), F.lit(parent).alias("parent_table"),
            F.col("n_orphans").cast("bigint"),
        ))
    orphans = frames[0]
    for f in frames[1:]:
        orphans = orphans.unionByName(f)
    return {"nulls": nulls, "duplicates": duplicates, "orphans": orphans}
