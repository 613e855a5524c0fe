"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

#: Settings every job of this package relies on; all are runtime-settable.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # document rows are wide: keep Arrow batches small enough for a Python worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(app: str = "contentlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's settings; ``master`` is left to spark-submit when unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Bytes of an Arrow batch where rows are whole texts or sets: a worker holds a few copies of a batch.
BATCH_BYTES = 8 << 20
#: The same for stored pages, documents and files, where memory of a worker must not follow the rows of its tasks.
PAGE_BYTES = 1 << 20


def limit_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Lower the session's Arrow batches to ``size`` bytes, unless they are smaller; one row is never cut."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if not now or not now.rstrip("bB").isdigit() or not 0 < int(now.rstrip("bB")) <= size:
        spark.conf.set(key, str(size))


#: Bytes of a join partition from which a hot key is cut, and of its pieces: rows of answers are short and cleaning one takes long.
SKEW_BYTES = 8 << 20


def cut_hot_partitions(spark: SparkSession, size: int = SKEW_BYTES) -> None:
    """Let adaptive execution cut skewed join partitions of answers into pieces of ``size`` bytes, in place of 64 MB above 256 MB."""
    for key in ("skewJoin.skewedPartitionThresholdInBytes", "advisoryPartitionSizeInBytes"):
        spark.conf.set(f"spark.sql.adaptive.{key}", f"{size}b")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session (tests, one machine) may fall back to a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="contentlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Scratch folders of this process, for drop_scratch.
_WRITTEN: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique path below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def row_bytes(df: DataFrame) -> Column:
    """Approximate size of a row: text by its bytes, nested values by their JSON text, the rest as 8."""
    total = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        total = total + 8
    return total


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several later steps read to the shared folder, and read it back.

    It is computed once and survives executor loss. Row count and size are observed during the
    write (see :func:`row_count` and :func:`known_bytes`), so no further job has to measure them.
    """
    path = scratch_path(df.sparkSession, label)
    seen = Observation()
    size = F.coalesce(F.sum(row_bytes(df)), F.lit(0))
    df.observe(seen, F.count(F.lit(1)).alias("rows"), size.alias("bytes")).write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.observed = seen.get
    return out


def observe_write(df: DataFrame, path: str, by: str | None = None) -> int:
    """Write to a path of the shared folder, partitioned by a column if given; the rows written."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write
    (writer.partitionBy(by) if by else writer).parquet(path)
    return seen.get["rows"]


def row_count(df: DataFrame) -> int:
    """Rows of a materialized result."""
    return df.observed["rows"]


def known_bytes(*parts: DataFrame) -> int:
    """Approximate size of one or several materialized results."""
    return sum(part.observed["bytes"] for part in parts)


def drop_scratch(spark: SparkSession) -> int:
    """Delete what this process has written with :func:`scratch_path`; call it when the job has ended."""
    gone = 0
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone
