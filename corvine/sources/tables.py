"""Readers and writers: tab-separated sources and results, Parquet stages, with guards."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corvine.sources.stages import stage

SOURCE = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
CANDIDATES = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "candidate_entity_ids")])


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = SOURCE, blanks: bool = False) -> DataFrame:
    """A tab-separated file with a header, all strings; columns are found by name. blanks: '' instead of null."""
    try:
        names = spark.read.options(sep="\t", header=True, escape='"').csv(path).columns
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from e
        raise
    missing = sorted(set(schema.names) - set(names))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    df = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).options(sep="\t", header=True, escape='"').csv(path)
    return df.na.fill("") if blanks else df


def with_order(df: DataFrame, src: int) -> DataFrame:
    """Add src and ord, which fix the order of records read from files: by file name, then by position in the file.

    A reader packs pieces of files into tasks by size, so a row's place in its task is not its place in the file; pieces are ordered by
    (file, first byte), one row a piece, and rows by their place in the piece.
    """
    at = F.monotonically_increasing_id()
    try:
        rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_from"), at.alias("_at"))
    except AnalysisException:  # not read from files: the order of partitions
        return df.withColumn("src", F.lit(src)).withColumn("ord", at)
    pieces = rows.groupBy("_file", "_from").agg(F.min("_at").alias("_first"))
    pieces = pieces.withColumn("_piece", F.row_number().over(Window.orderBy("_file", "_from")).cast("long"))
    rows = rows.join(F.broadcast(pieces), ["_file", "_from"]).withColumn("src", F.lit(src))
    return rows.withColumn("ord", F.shiftleft("_piece", 34) + F.col("_at") - F.col("_first")).select(*df.columns, "src", "ord")


def head(df: DataFrame, n: int) -> DataFrame:
    """The first n rows by ord."""
    return df.orderBy("ord").limit(n)


def inspect(df: DataFrame, n: int = 3) -> dict:
    return {"rows": df.count(), "columns": df.columns, "head": [r.asDict() for r in df.limit(n).collect()]}


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from e
        raise
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, force: bool = False, rows_a_file: int = 0) -> None:
    """Without ``force`` an existing target is an error."""
    writer = df.write.mode("overwrite" if force else "errorifexists")
    if rows_a_file:
        writer = writer.option("maxRecordsPerFile", rows_a_file)
    try:
        writer.parquet(path)
    except AnalysisException as e:
        if "ALREADY_EXISTS" in str(e):
            raise FileExistsError(path) from e
        raise


def write_tsv(df: DataFrame, path: str, force: bool = False, files: int | None = None) -> None:
    """Tab-separated, with a header, nothing quoted, empties truly empty; a file a partition, or ``files`` from the finished table."""
    df = stage(df).coalesce(files) if files else df
    options = {"sep": "\t", "header": True, "emptyValue": "", "nullValue": "", "quote": "\u0000"}
    try:
        df.write.mode("overwrite" if force else "errorifexists").options(**options).csv(path)
    except AnalysisException as e:
        if "ALREADY_EXISTS" in str(e):
            raise FileExistsError(path) from e
        raise


def write_in_buckets(df: DataFrame, path: str, key: str, buckets: int, only: int | None = None) -> list[int]:
    """Write the buckets of ``key`` that are not finished yet, in one pass over df; returns their numbers.

    A bucket counts as finished once the job that wrote it has ended, empty ones too. only: a trial of the first so many buckets.
    """
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_finished")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    mark = lambda b: spark._jvm.org.apache.hadoop.fs.Path(folder, str(b))
    todo = [b for b in range(buckets if only is None else min(only, buckets)) if not files.exists(mark(b))]
    if todo:
        rows = df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).where(F.col("bucket").isin(todo))
        # What a lost job left of these buckets goes: a bucket is replaced as a whole.
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
        for b in todo:
            files.create(mark(b), True).close()
    return todo


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path).drop("bucket")
