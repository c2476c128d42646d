"""File-stream ingest.

New raw CSV files in an inbox folder are picked up by the Structured
Streaming file source and each micro-batch is loaded with the same
``load_batch`` as batch mode, inside ``foreachBatch``.

Exactly-once into the warehouse: the ledger key of a micro-batch is
(stream name, query id from the checkpoint, micro-batch id).  A micro-batch
already in the ledger is skipped when Spark re-delivers it after a failure;
one that failed before its ledger row is run again under the next free batch
id (what the failed run left there is cleared).  The micro-batch id alone is not used as
the batch id: it restarts at 0 when a checkpoint is lost and would then
overwrite older batches.

The archive follows the ledger (S6): each load keeps the names of its files, and
the files of batches that the ledger and the stream's own checkpoint both name as done are
moved.  A move is a rename that may be repeated, so a run lost at any point ends, after
the next one, with every file of a committed batch archived once and no other file moved.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstar.plans.load import Warehouse, load_batch
from tillstar.schemas import CORRUPT_COL, RAW_SCAN
from tillstar.session import below_folder, configure, file_state, move, remove_dir


def raw_stream(
    spark: SparkSession,
    inbox: str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of raw rows from new CSV files in ``inbox``."""
    configure(spark)
    r = (
        spark.readStream.schema(RAW_SCAN)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .option("quote", '"')
        .option("escape", '"')
    )
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(inbox).withColumn("file_path", F.col("_metadata.file_path"))


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(line)["id"]


def _source_key(name: str, qid: str, epoch: int) -> str:
    return f"{name}:{qid}:{epoch}"


def archive_committed(wh: Warehouse, inbox: str, checkpoint: str, archive_dir: str) -> int:
    """Move the files of batches that are done to ``archive_dir``, keeping their path below ``inbox``.

    Done means committed in the ledger and, so that the stream never reads them
    again, in the checkpoint too.  Returns how many files were moved.
    """
    spark, moved = wh.spark, 0
    for path, record in wh.recorded_files():
        committed = wh.ledger().where(F.col("batch_id") == record["batch_id"]).select("attempt").first()
        if committed is None:  # still running, or lost before its commit
            continue
        if committed[0] == record["attempt"]:
            if file_state(spark, f"{checkpoint.rstrip('/')}/commits/{record['note']}") is None:
                continue
            for file in record["files"]:
                source, below = below_folder(spark, file, inbox)
                moved += move(spark, source, f"{archive_dir.rstrip('/')}/{below}")
        remove_dir(spark, path)
    return moved


def micro_batch_loader(
    wh: Warehouse, checkpoint: str, name: str = "sales", inbox: str | None = None, archive_dir: str | None = None, **load_options
):
    """The ``foreachBatch`` function: one micro-batch -> one warehouse batch.

    A micro-batch whose ledger key is already committed (Spark re-delivers
    the last micro-batch after a failure between our commit and its own) is
    skipped; otherwise it is loaded under the next free batch id.
    ``load_options``: ``on_bad_row``, ``customer_lookup``, ``salt`` of ``load_batch``.
    """
    qid: list[str] = []  # read once from the checkpoint (stable across restarts)

    def load_micro_batch(df: DataFrame, epoch_id: int) -> None:
        if not qid:
            qid.append(_query_id(df.sparkSession, checkpoint))
        if archive_dir:
            archive_committed(wh, inbox, checkpoint, archive_dir)  # of the micro-batches before
        note = str(epoch_id) if archive_dir else None
        load_batch(wh, df, source=_source_key(name, qid[0], epoch_id), once=True, files_note=note, **load_options)

    return load_micro_batch


def ingest(
    spark: SparkSession,
    inbox: str,
    wh: Warehouse,
    checkpoint: str,
    name: str = "sales",
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    **load_options,
) -> StreamingQuery:
    """Start the stream; every micro-batch becomes one warehouse batch.

    With ``archive_dir`` files are moved there by the micro-batch after theirs, and by ``archive_committed``.
    ``load_options``: ``on_bad_row``, ``customer_lookup``, ``salt`` of ``load_batch``.
    """
    stream = raw_stream(spark, inbox, max_files_per_trigger)
    load_micro_batch = micro_batch_loader(wh, checkpoint, name, inbox, archive_dir, **load_options)

    w = stream.writeStream.foreachBatch(load_micro_batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def run_available(spark: SparkSession, inbox: str, wh: Warehouse, checkpoint: str, **kw) -> None:
    """Process every file present now, then stop (one triggered run)."""
    q = ingest(spark, inbox, wh, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if kw.get("archive_dir"):
        archive_committed(wh, inbox, checkpoint, kw["archive_dir"])
