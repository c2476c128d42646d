"""Session and shared-folder helpers.

All intermediate data (materialised staging, warehouse tables written by the
example queries, streaming checkpoints) lives under the folder the cluster
names in ``spark.checkpoint.dir``.  We only pick our own folder when that
setting is absent (local tests), never a machine-local temp folder otherwise.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Session settings the engine relies on.  They are applied to sessions we
# create; for an existing session only the SQL settings are (re)set.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Baskets are collected over many more keys than a hash of objects may hold; sorted from the start, they are sorted once.
    "spark.sql.execution.useObjectHashAggregateExec": "false",
    # The raw CSV verdict (which rows are corrupt) must not depend on the
    # projection of the query that reads it.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # hstore semantics: a repeated key keeps its last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}
# (Dynamic partition overwrite is set per write by the warehouse, not here, so
# other overwrites in the user's session keep their own semantics.)


def get_session(
    master: str | None = None, shuffle_partitions: int | None = None, driver_memory: str | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.appName("tillstar")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for k, v in SQL_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:  # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set one only where it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            # each executor would write to its own disk and results would be lost
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tillstar-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder under the shared checkpoint folder (never reused)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tillstar/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    return path


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to ``path`` (shared folder) and read it back.

    Cuts lineage: later stages read the written files, so an executor lost
    after this point never forces recomputation of (or a different answer
    from) the upstream plan.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def remove_dir(spark: SparkSession, path: str) -> bool:
    """Delete a folder this library created (e.g. a committed run's scratch)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))


def make_dirs(spark: SparkSession, path: str) -> None:
    """Create a folder (and parents) on the cluster file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def _file(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless it is there (then False)."""
    fs, p = _file(spark, path)
    if fs.getScheme() == "file":  # the JVM's local file system checks and creates in two steps
        try:
            with open(p.toUri().getPath(), "x") as f:
                f.write(text)
            return True
        except FileExistsError:
            return False
    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def publish_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole text in one step, unless it is there (then False)."""
    fs, p = _file(spark, path)
    if fs.getScheme() == "file":  # a rename would replace what is there, a link does not
        final = p.toUri().getPath()
        draft = f"{os.path.dirname(final)}/.{uuid.uuid4().hex}"
        with open(draft, "x") as f:
            f.write(text)
        try:
            os.link(draft, final)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    done = False
    try:
        done = not fs.exists(p) and bool(fs.rename(draft, p))
    finally:
        if not done:
            fs.delete(draft, False)
    return done


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder; False where the source is not there (any more)."""
    fs, p = _file(spark, source)
    if not fs.exists(p):
        return False
    to = _file(spark, target)[1]
    fs.mkdirs(to.getParent())
    if fs.rename(p, to):
        return True
    if not fs.exists(p):  # moved meanwhile
        return False
    raise OSError(f"{source} could not be moved to {target}")


def below_folder(spark: SparkSession, file: str, folder: str) -> tuple[str, str]:
    """(path of a file given as an encoded URI, the part of it below ``folder`` or else its name)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    fs, top = _file(spark, folder)
    top = fs.makeQualified(top).toUri().getPath().rstrip("/") + "/"
    inside = path.toUri().getPath()
    return path.toString(), inside[len(top):] if inside.startswith(top) else path.getName()


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where it is absent."""
    fs, p = _file(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def file_state(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """(text, modification time) of a small file, None where it is absent."""
    fs, p = _file(spark, path)
    try:
        when = int(fs.getFileStatus(p).getModificationTime())
        stream = fs.open(p)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return text, when
    except Py4JJavaError:
        if fs.exists(p):
            raise
        return None


def touch(spark: SparkSession, path: str) -> None:
    """Set a file's modification time to now."""
    fs, p = _file(spark, path)
    fs.setTimes(p, int(time.time() * 1000), -1)


def files_digest(spark: SparkSession, path: str) -> str:
    """A digest of names, lengths and modification times of a file or of a folder's files."""
    fs, p = _file(spark, path)
    found = sorted(
        (st.getPath().getName(), st.getLen(), st.getModificationTime()) for st in fs.listStatus(p) if st.isFile()
    )
    return hashlib.md5(repr(found).encode()).hexdigest()


# Target bytes of input per shuffle partition when sizing a batch (fixed value).
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total length of the files under ``path`` (file system metadata only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


def size_shuffle(spark: SparkSession, input_bytes: int) -> int:
    """Set the shuffle partition count for a batch of ``input_bytes``.

    About one partition per 256 MB of input, never fewer than twice the
    cluster's task slots; AQE then coalesces small partitions and splits
    skewed ones at run time.  Returns the count set.
    """
    slots = spark.sparkContext.defaultParallelism
    n = max(2 * slots, -(-input_bytes // TARGET_PARTITION_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TARGET_PARTITION_BYTES // 2))
    return n
