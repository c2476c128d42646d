"""Command line: the reference's entry points as Spark jobs.

    python -m tillstar bootstrap <warehouse>
    python -m tillstar load <raw csv path> <warehouse> [--batch-id N] [--again] [--fail-on-bad-rows] [--name-only] [--salt TEXT]
    python -m tillstar stream <inbox> <warehouse> <checkpoint> [--max-files N] [--archive DIR] [--every "1 minute"]
                              [--fail-on-bad-rows] [--name-only] [--salt TEXT]
    python -m tillstar audit <warehouse> <batch id>
    python -m tillstar flat <header csv path> <out dir>

Run it with ``spark-submit -m``-style launchers or plain ``python`` (local).
Paths may be any Hadoop file system URI; scratch data goes under the
session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tillstar")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bootstrap", help="create the star-schema tables if absent")
    b.add_argument("warehouse")
    ld = sub.add_parser("load", help="load one raw sales CSV (file or folder) as a batch")
    ld.add_argument("raw")
    ld.add_argument("warehouse")
    ld.add_argument("--batch-id", type=int)
    ld.add_argument("--again", action="store_true", help="load files that are unchanged since their last load, too")
    st = sub.add_parser("stream", help="load every new file of an inbox folder")
    st.add_argument("inbox")
    st.add_argument("warehouse")
    st.add_argument("checkpoint")
    st.add_argument("--max-files", type=int)
    st.add_argument("--archive")
    st.add_argument("--every", help="processing-time trigger; default: process what is there and stop")
    for p in (ld, st):
        p.add_argument("--fail-on-bad-rows", action="store_true")
        p.add_argument("--salt", help="pseudonyms are a salted SHA-256 instead of a plain MD5")
        p.add_argument("--name-only", action="store_true", help="reference-mode customer look-up by name")
    au = sub.add_parser("audit", help="constraint audit of one committed batch")
    au.add_argument("warehouse")
    au.add_argument("batch_id", type=int)
    fl = sub.add_parser("flat", help="local variant: header CSV -> six tables")
    fl.add_argument("raw")
    fl.add_argument("out")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from tillstar.plans.load import Warehouse, load_batch
    from tillstar.session import get_session, work_dir

    owns_session = SparkSession.getActiveSession() is None
    spark = get_session()
    rules = {}
    if args.cmd in ("load", "stream"):
        rules["on_bad_row"] = "fail" if args.fail_on_bad_rows else "quarantine"
        rules["salt"] = args.salt
        rules["customer_lookup"] = "name_only" if args.name_only else "name_store"
    if args.cmd == "bootstrap":
        Warehouse(spark, args.warehouse).bootstrap()
    elif args.cmd == "load":
        from tillstar.session import files_digest, path_bytes, size_shuffle
        from tillstar.sources.csv import read_raw_csv

        size_shuffle(spark, path_bytes(spark, args.raw))
        wh = Warehouse(spark, args.warehouse).bootstrap()
        res = load_batch(
            wh,
            read_raw_csv(spark, args.raw),
            args.batch_id,
            source=f"{args.raw}#{files_digest(spark, args.raw)}",
            once=not args.again,
            **rules,
        )
        print(f"batch {res.batch_id}: {'already loaded' if res.skipped else 'committed'}")
    elif args.cmd == "stream":
        from tillstar.streaming.ingest import archive_committed, ingest

        wh = Warehouse(spark, args.warehouse).bootstrap()
        q = ingest(
            spark, args.inbox, wh, args.checkpoint, max_files_per_trigger=args.max_files, archive_dir=args.archive,
            available_now=args.every is None, processing_time=args.every, **rules,
        )
        q.awaitTermination()
        if args.archive:
            archive_committed(wh, args.inbox, args.checkpoint, args.archive)
    elif args.cmd == "audit":
        from tillstar.plans.audit import audit_batch

        for name, df in audit_batch(Warehouse(spark, args.warehouse), args.batch_id).items():
            print(f"== {name}")
            df.show(100, truncate=False)
    elif args.cmd == "flat":
        from tillstar.operators.flat import flat_frame, write_flat_tables
        from tillstar.sources.csv import read_header_csv
        from pyspark.sql import functions as F

        raw = read_header_csv(spark, args.raw)
        # Source order: file, block, position in the block (a file scan keeps line order).
        order = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
        local = raw.withColumn("_row", order)
        scratch = work_dir(spark, "flat-cli")
        write_flat_tables(flat_frame(local, scratch, order_col="_row", keep_order=True), args.out, scratch, order_col="_row")
    if owns_session:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
