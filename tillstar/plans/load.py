"""Incremental feed -> star schema load.

Layout of a warehouse folder (Parquet, every table partitioned by
``batch_id``, with the column ``attempt``)::

    <root>/stores  customers  products  flavours  transactions  baskets
    <root>/quarantine                      rejected raw rows, non-personal
    <root>/ledger/<batch id>.json          one file per committed batch
    <root>/_scratch/batch=<id>-<attempt>/  materialised staging of a run
    <root>/_claim                          held by the load that is running
    <root>/_line_key                       key of the digests of rejected lines
    <root>/_files/                         input files of batches, until they are archived

Every run of a batch is an attempt of its own and adds files of its own.
Its commit creates the ledger file named by the batch id, which fails where the
file is there: of several runs of one batch exactly one is committed, in one step
that needs no claim, even if a run stalls for any time right before it.  Readers see
only rows of the ledgered attempts, which makes the six-table commit all-or-nothing
without a transactional table format, and no run ever removes what a commit may
still name: the files of a batch's other attempts go after its commit.
One load runs at a time (``plans.claim``), so that ids are not dealt twice for nothing.
"""

from __future__ import annotations

import json
import secrets
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators import dims as D
from tillstar.operators.keys import ranged_ids
from tillstar.plans import staging
from tillstar.plans.claim import WAIT_S, Claim, LoadInProgress
from tillstar.schemas import ID_COLUMNS, LEDGER, QUARANTINE, STAR_TABLES
from tillstar.session import (
    below_folder, configure, create_file, file_state, list_dir, make_dirs, materialize, publish_file, remove_dir,
)

ALL_TABLES = {**STAR_TABLES, "quarantine": QUARANTINE}

TXN_ORDER = ["time_stamp", "store_id", "customer_id", "total_price", "payment_type", "products"]


class BadRowsError(ValueError):
    pass


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType(
        schema.fields + [T.StructField("batch_id", T.LongType(), True), T.StructField("attempt", T.StringType(), True)]
    )


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    # Id-stamped transaction staging (with the basket text) of batches loaded
    # by this process, read from the materialised scratch folder.
    staged_transactions: dict = field(default_factory=dict)
    # Scratch folder of each batch loaded by this process (kept with keep_scratch).
    scratch_dirs: dict = field(default_factory=dict)
    # Attempt of each batch that this process runs or ran.
    attempts: dict = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def bootstrap(self) -> "Warehouse":
        """Create every table if absent (idempotent)."""
        configure(self.spark)
        for name in [*ALL_TABLES, "ledger", "_files"]:
            make_dirs(self.spark, self.path(name))  # read with fixed schemas, so an empty folder is an empty table
        return self

    def _raw(self, table: str) -> DataFrame:
        if table == "ledger":
            return self.spark.read.schema(LEDGER).json(self.path(table))
        return self.spark.read.schema(_with_batch(ALL_TABLES[table])).parquet(self.path(table))

    def ledger(self) -> DataFrame:
        return self._raw("ledger")

    def batch_of(self, source: str) -> int | None:
        """The committed batch of a source, if there is one."""
        row = self.ledger().where(F.col("source") == source).agg(F.min("batch_id")).first()
        return row[0]

    def next_batch_id(self) -> int:
        return D.max_id(self.ledger(), "batch_id") + 1

    def state(self, batch_id: int) -> tuple[bool, dict[str, int]]:
        """(is ``batch_id`` committed, largest ids of the other committed
        batches) from one aggregate over the ledger."""
        led = self.ledger()
        other = F.col("batch_id") != batch_id
        aggs = [F.max(F.when(other, F.col(f"max_{c}"))).alias(t) for t, c in ID_COLUMNS.items()]
        row = led.agg(F.max(F.when(~other, F.lit(1))).alias("_done"), *aggs).first()
        return row["_done"] is not None, {t: int(row[t] or 0) for t in ID_COLUMNS}

    def read(
        self, table: str, also: int | None = None, exclude: int | None = None, batches: list[int] | None = None
    ) -> DataFrame:
        """Rows of committed batches (plus the in-flight batch ``also``).

        ``batches`` restricts to those batch ids: a literal partition filter,
        so only their partitions are listed and read.
        """
        ok = self.ledger().select("batch_id", "attempt")
        if exclude is not None:
            ok = ok.where(F.col("batch_id") != exclude)
        df = self._raw(table)
        if batches is not None:
            df = df.where(F.col("batch_id").isin(list(batches)))
        visible = df.join(ok, ["batch_id", "attempt"], "left_semi")
        if also is not None:
            visible = visible.unionByName(self.batch_rows(table, also))
        return visible.drop("batch_id", "attempt")

    def attempt_of(self, batch_id: int) -> str | None:
        """The committed attempt of a batch, else the one this process runs."""
        row = self.ledger().where(F.col("batch_id") == batch_id).select("attempt").first()
        return row[0] if row else self.attempts.get(batch_id)

    def batch_rows(self, table: str, batch_id: int) -> DataFrame:
        """Rows of one batch, committed or in flight, with ``batch_id`` and ``attempt``."""
        mine = F.col("attempt").eqNullSafe(F.lit(self.attempt_of(batch_id)))
        return self._raw(table).where((F.col("batch_id") == batch_id) & mine)

    def write(self, table: str, df: DataFrame, batch_id: int) -> None:
        cols = [f.name for f in ALL_TABLES[table].fields]
        out = df.select(*cols).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        out = out.withColumn("attempt", F.lit(self.attempts[batch_id]))
        out.write.mode("append").partitionBy("batch_id").parquet(self.path(table))

    def commit(self, batch_id: int, source: str, max_ids: dict[str, int]) -> None:
        """Create the batch's ledger file; from now on readers see the attempt.  Fails where the batch has one."""
        row = {"batch_id": batch_id, "attempt": self.attempts[batch_id], "source": source}
        row |= {f"max_{c}": max_ids[t] for t, c in ID_COLUMNS.items()}
        row["committed_at"] = datetime.now(timezone.utc).isoformat()
        if not publish_file(self.spark, f"{self.path('ledger')}/{batch_id}.json", json.dumps(row)):
            raise LoadInProgress(f"batch {batch_id} was committed by another load")

    def line_key(self) -> str:
        """Key of the digests of rejected lines, made once and kept with the warehouse."""
        path = self.path("_line_key")
        state = file_state(self.spark, path)
        if state is None or not state[0]:
            create_file(self.spark, path, secrets.token_hex(16))
            state = file_state(self.spark, path)
        return state[0]

    def staged(self, batch_id: int) -> DataFrame:
        """The staged rows of a batch loaded here with ``keep_scratch``."""
        return self.spark.read.parquet(f"{self.scratch_dirs[batch_id]}/staged")

    def record_files(self, batch_id: int, files: list[str], note: str) -> None:
        """Keep the names of an attempt's input files until they are archived."""
        record = json.dumps({"batch_id": batch_id, "attempt": self.attempts[batch_id], "note": note, "files": files})
        publish_file(self.spark, f"{self.path('_files')}/{batch_id}-{self.attempts[batch_id]}.json", record)

    def recorded_files(self) -> list[tuple[str, dict]]:
        """(path, record) of all that ``record_files`` kept and nobody dropped; a few per running stream."""
        out = []
        for name in list_dir(self.spark, self.path("_files")):
            state = file_state(self.spark, f"{self.path('_files')}/{name}")
            if name.endswith(".json") and state is not None:
                out.append((f"{self.path('_files')}/{name}", json.loads(state[0])))
        return out

    def has_files(self, batch_id: int) -> bool:
        """Whether any run of a batch has left files so far (folder listings only)."""
        return any(list_dir(self.spark, f"{self.path(t)}/batch_id={batch_id}") for t in ALL_TABLES)

    def drop_other_attempts(self, batch_id: int) -> None:
        """Remove what uncommitted attempts of a committed batch wrote; none of them can be committed any more."""
        kept = F.col("attempt").eqNullSafe(F.lit(self.attempt_of(batch_id)))
        for table in ALL_TABLES:
            if len(list_dir(self.spark, f"{self.path(table)}/batch_id={batch_id}")) == 0:
                continue
            lost = self._raw(table).where((F.col("batch_id") == batch_id) & ~kept).select("_metadata.file_path").distinct()
            for row in lost.collect():  # one name per file of a lost run
                remove_dir(self.spark, below_folder(self.spark, row[0], self.path(table))[0])

    def scratch(self, batch_id: int) -> str:
        return f"{self.root.rstrip('/')}/_scratch/batch={batch_id}-{self.attempts[batch_id]}"


def _step(wh: Warehouse, batch_id: int, name: str) -> None:
    """Label the following Spark jobs (event log / UI) with the load step."""
    wh.spark.sparkContext.setJobDescription(f"tillstar batch {batch_id}: {name}")


@dataclass
class LoadResult:
    batch_id: int
    skipped: bool = False


def stage_batch(raw: DataFrame, scratch: str, salt: str | None = None, line_key: str | None = None) -> tuple[DataFrame, int, int]:
    """Stage the raw rows once and write them to the shared folder.

    Adds a unique row tag, the tiebreaker that lets the transaction ids be
    range-partitioned even when one natural key holds a large share of rows.
    Returns the staged frame and the numbers of rejected and valid rows, both
    observed on the write itself.
    """
    obs = Observation("staged")
    st = staging.stage(raw, salt, line_key=line_key).withColumn("_tag", F.monotonically_increasing_id())
    bad = F.col("reason").isNotNull()
    st = st.observe(obs, F.count_if(bad).alias("bad"), F.count_if(~bad).alias("good"))
    staged = materialize(st, f"{scratch}/staged")
    return staged, int(obs.get["bad"]), int(obs.get["good"])


def write_new(wh: Warehouse, table: str, new: DataFrame, batch_id: int, start: dict[str, int]) -> int:
    """Write a batch's new dimension members; return the table's largest id.

    New members carry the dense ids start+1 .. start+n, so the largest id is
    start + n.  The count n is observed on the write job itself
    (``Observation``), so no second pass over the new members is needed.
    """
    obs = Observation(f"new_{table}")
    wh.write(table, new.observe(obs, F.count(F.lit(1)).alias("n")), batch_id)
    return start[table] + int(obs.get["n"])


def load_batch(
    wh: Warehouse,
    raw: DataFrame,
    batch_id: int | None = None,
    source: str = "",
    on_bad_row: str = "quarantine",
    customer_lookup: str = "name_store",
    salt: str | None = None,
    commit: bool = True,
    keep_scratch: bool = False,
    once: bool = False,
    wait_s: float = WAIT_S,
    files_note: str | None = None,
) -> LoadResult:
    """Load one raw feed (7 text columns) as batch ``batch_id``.

    A batch already in the ledger is skipped, so a replay changes nothing; a
    batch that failed before its ledger row is simply run again.  With
    ``once`` a ``source`` already in the ledger is skipped too.
    ``commit=False`` stops before the ledger row (what a crash there leaves).
    After the commit the run's scratch folder is dropped (the staging tables
    of the reference) unless ``keep_scratch``; a load that fails drops it too.
    A load that finds another one running waits up to ``wait_s`` seconds.
    With ``files_note`` the names of the input files are kept beside the ledger, with that note.
    """
    with Claim(wh.spark, wh.root, wait_s) as claim:
        if once and (known := wh.batch_of(source)) is not None:
            return LoadResult(known, skipped=True)
        if batch_id is None:
            batch_id = wh.next_batch_id()
        try:
            return _load(wh, raw, batch_id, source, on_bad_row, customer_lookup, salt, commit, keep_scratch, claim, files_note)
        except BaseException:
            wh.staged_transactions.pop(batch_id, None)
            if batch_id in wh.scratch_dirs:
                remove_dir(wh.spark, wh.scratch_dirs.pop(batch_id))
            raise
        finally:
            wh.spark.sparkContext.setJobDescription(None)


def _load(
    wh: Warehouse,
    raw: DataFrame,
    batch_id: int,
    source: str,
    on_bad_row: str,
    customer_lookup: str,
    salt: str | None,
    commit: bool,
    keep_scratch: bool,
    claim: Claim,
    files_note: str | None,
) -> LoadResult:
    done, start = wh.state(batch_id)
    if done:
        return LoadResult(batch_id, skipped=True)
    _step(wh, batch_id, "stage")
    tried = wh.has_files(batch_id)
    wh.attempts[batch_id] = uuid.uuid4().hex[:16]
    scratch = wh.scratch(batch_id)
    wh.scratch_dirs[batch_id] = scratch
    staged, n_bad, n_valid = stage_batch(raw, scratch, salt, wh.line_key())

    _step(wh, batch_id, "quarantine")
    if n_bad and on_bad_row == "fail":
        raise BadRowsError(f"batch {batch_id}: {n_bad} rejected rows")
    if n_bad:
        wh.write("quarantine", staging.quarantined(staged), batch_id)
    valid = staging.valid_rows(staged)

    # Existing members are the committed batches other than this one; their
    # largest ids come from the ledger, not from a scan of the tables.
    _step(wh, batch_id, "ledger")
    prior = {t: wh.read(t, exclude=batch_id) for t in ("stores", "customers", "products", "flavours")}
    after = dict(start)

    def current(table: str) -> DataFrame:
        return wh.read(table, also=batch_id, exclude=batch_id)

    # Stores and customers from one distinct pass over (digest, store).  The
    # exact pair count bounds every store / customer frame of the batch.
    _step(wh, batch_id, "stores")
    pairs = D.distinct_customers(valid).persist(StorageLevel.MEMORY_AND_DISK)
    n_pairs = pairs.count()
    new_stores = D.new_stores(pairs, prior["stores"], f"{scratch}/new_stores", start["stores"], bound=n_pairs)
    after["stores"] = write_new(wh, "stores", new_stores, batch_id, start)
    stores_all = current("stores")
    stores_rows = after["stores"]  # dense ids 1..n: the exact row count
    _step(wh, batch_id, "customers")
    cand = D.customer_candidates(pairs, stores_all, stores_rows=stores_rows)
    # A batch with a proven-small set of customers never shuffles the
    # customer dimension nor the fact for its look-up.
    new_customers = D.new_customers(
        pairs, stores_all, prior["customers"], f"{scratch}/new_customers", start["customers"], cand=cand, cand_rows=n_pairs
    )
    after["customers"] = write_new(wh, "customers", new_customers, batch_id, start)
    customers_all = current("customers")
    if D.fits_broadcast(cand, n_pairs):
        key = D.CUSTOMER_KEY if customer_lookup != "name_only" else ["customer_name"]
        batch_customers = D.members_of(customers_all, cand, key, n_pairs)
        batch_customers_rows = n_pairs if customer_lookup != "name_only" else None
    else:
        batch_customers, batch_customers_rows = customers_all, after["customers"]

    # Products and flavours from one pre-aggregated pass over the items.
    _step(wh, batch_id, "products and flavours")
    items = staging.parse_items(valid, keep=[])
    groups = items.groupBy("product_name", "flavour_name").agg(F.min("price").alias("price"))
    groups = groups.persist(StorageLevel.MEMORY_AND_DISK)
    n_groups = groups.count()
    new_products = D.new_products(groups, prior["products"], f"{scratch}/new_products", start["products"], bound=n_groups)
    after["products"] = write_new(wh, "products", new_products, batch_id, start)
    new_flavours = D.new_flavours(groups, prior["flavours"], f"{scratch}/new_flavours", start["flavours"], bound=n_groups)
    after["flavours"] = write_new(wh, "flavours", new_flavours, batch_id, start)
    groups.unpersist()

    # Fact: store and customer ids, then ids in natural-key order.
    _step(wh, batch_id, "transaction ids")
    txn = D.lookup_store(valid.select(*staging.TRANSACTION_COLUMNS, "_tag"), stores_all, rows=stores_rows)
    if customer_lookup == "name_only":
        txn = D.lookup_customer_by_name(txn, batch_customers, rows=batch_customers_rows)
    else:
        txn = D.lookup_customer(txn, batch_customers, rows=batch_customers_rows)
    keyed = txn.select("_tag", *TXN_ORDER)
    ranked = ranged_ids(
        keyed, TXN_ORDER, "transaction_id", f"{scratch}/txn_ranked", start=start["transactions"], tiebreak=["_tag"]
    )
    txn, total = ranked.frame, ranked.total
    _step(wh, batch_id, "transactions")
    wh.write("transactions", txn, batch_id)
    after["transactions"] = start["transactions"] + total
    wh.staged_transactions[batch_id] = txn

    _step(wh, batch_id, "baskets")
    lines = staging.parse_items(txn, keep=["transaction_id"])
    lines = D.lookup_product_flavour(
        lines, current("products"), current("flavours"),
        product_rows=after["products"], flavour_rows=after["flavours"],
    )
    wh.write("baskets", lines, batch_id)
    pairs.unpersist()

    _step(wh, batch_id, "commit")
    if files_note is not None:  # one name per input file of the batch
        names = staged.where(F.col("file_path").isNotNull()).select("file_path").distinct().collect()
        wh.record_files(batch_id, sorted(r[0] for r in names), files_note)
    if commit:
        claim.check()
        wh.commit(batch_id, source, after)
        if tried:
            wh.drop_other_attempts(batch_id)
        if not keep_scratch:
            wh.staged_transactions.pop(batch_id, None)
            wh.scratch_dirs.pop(batch_id, None)
            remove_dir(wh.spark, scratch)
    return LoadResult(batch_id)


# ---- readers ------------------------------------------------------------

def star_view(wh: Warehouse, batches: list[int] | None = None) -> DataFrame:
    """F1 end product: each basket line with its transaction (optionally of
    some batches only; a transaction and its lines share their batch)."""
    t = wh.read("transactions", batches=batches)
    b = wh.read("baskets", batches=batches)
    return t.join(b, "transaction_id").select(
        "transaction_id", "time_stamp", "store_id", "customer_id", "total_price", "payment_type", "product_id", "flavour_id"
    )


def star_schema_columns(wh: Warehouse) -> DataFrame:
    """S7 check: (table, column, position, type) of the created star tables.

    Built from the fixed schemas the bootstrapped tables are written and read
    with (metadata only, no scan).  Not a registered query: its input is the
    fixed schema list, not the test tables.
    """
    rows = []
    for table in STAR_TABLES:
        schema = wh._raw(table).schema
        for pos, f in enumerate(schema.fields, 1):
            if f.name not in ("batch_id", "attempt"):
                rows.append((table, f.name, pos, f.dataType.simpleString()))
    return wh.spark.createDataFrame(rows, "table_name string, column_name string, position int, data_type string")
