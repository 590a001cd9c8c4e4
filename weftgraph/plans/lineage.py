"""Cutting lineage and numbering rows in ways that survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where that is unset, a session in one process (``local[...]``) gets a temporary folder; any other raises, as a folder on
    one machine is lost with it and not seen by the others.
    """
    set_now = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_now.isDefined():
        return set_now.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="weftgraph-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared folder, without its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back: pruned columns and compressed files."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """``scan``, dealt to all cores if its files are fewer than cores; for costly work on few files.

    Large inputs have more files than cores and stay as they are. Must be called on a scan without shuffles.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def enumerated(df: DataFrame, name: str = "seq", start: int = 0) -> tuple[DataFrame, int]:
    """``df`` with dense numbers from ``start`` in the order of its partitions and rows, and the number of rows.

    A row's number is its partition's offset plus its place in the partition. Only the row counts of partitions reach the
    driver. The rows are stored first; the stored copy keeps numbers the same when tasks are repeated.
    """
    kept = cut(df)
    low = F.monotonically_increasing_id()
    sizes = kept.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = {}, start
    for pid, n in sorted((row["pid"], row["n"]) for row in sizes):
        offsets[pid], total = total, total + n
    if not offsets:
        return kept.withColumn(name, F.lit(0).cast("bigint")), 0
    offset = F.element_at(
        F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair]), F.shiftright(low, 33).cast("int")
    )
    return kept.withColumn(name, (offset + low.bitwiseAND(F.lit((1 << 33) - 1))).cast("bigint")), total - start


def numbered(df: DataFrame, order: list[str], name: str = "seq") -> tuple[DataFrame, int]:
    """``df`` with dense numbers from 0 in the given order, and the number of rows: range-partitioned and sorted."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return enumerated(df.repartitionByRange(parts, *order).sortWithinPartitions(*order), name)
