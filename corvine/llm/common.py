"""What several corpus operators share: durable intermediate tables, row numbering, Arrow plumbing."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Spark's ASCII white space as the contracts name it: the space and 0x09 to 0x0D.
SPACES = " \t\n\x0b\x0c\r"
U64 = (1 << 64) - 1


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder of ``spark.checkpoint.dir`` and free the shuffle files behind it.

    Only where that setting is absent, and only with a local master (tests, a laptop), a folder of our own is used.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corvine-"))
    out = df.checkpoint(eager=True)
    _free_shuffles(df)
    return out


def _free_shuffles(df: DataFrame) -> None:
    """Delete the shuffle files of df's own execution, which its checkpoint has made useless.

    Spark itself does so only when the driver happens to collect garbage. A plan without adaptive execution keeps its files until then.
    """
    plan, cleaner = df._jdf.queryExecution().executedPlan(), df.sparkSession.sparkContext._jsc.sc().cleaner()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" and cleaner.isDefined():
        for i in plan.context().shuffleIds().keySet().toArray():
            cleaner.get().doCleanupShuffle(int(i), True)


def forget(df: DataFrame) -> None:
    """Delete the files of a table made by ``durable`` that nothing reads any more."""
    spark = df.sparkSession
    file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        path = spark._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_SOLE: dict[Hashable, Any] = {}


def sole(owner: Hashable = None, make: Callable[[], Any] | None = None) -> Any:
    """What an owner builds once for all its tasks in a Python worker. Workers outlive operators, so another owner's, or none's, ends it."""
    if owner not in _SOLE:
        if _SOLE:
            _SOLE.clear()
            gc.collect()  # for what refers to itself
        if make:
            _SOLE[owner] = make()
    return _SOLE.get(owner)


def sliced(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20, owner: Hashable = None) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``most_bytes`` in each; a longer single row stays whole. What is not ``owner``'s goes (``sole``)."""
    sole(owner)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows with ``number``, their place (from 0) in the order of the columns ``order``, nulls first.

    Rows are dealt by range of all order columns and, so that equal rows are split too, of their place in the input; they are sorted
    and written once. A row's number is its place in its partition after the sizes of the partitions before: one row a partition is summed.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*[F.col(c).asc_nulls_first() for c in order], F.col("_tie")]
    rows = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_tie")
    rows = durable(rows).withColumn("_at", F.monotonically_increasing_id())
    rows = rows.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each shuffle partition.
    rows = rows.join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    return rows.withColumn("number", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
