"""Text and CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from feederlens.operators.dimension import typed_dimension


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one or more text files: ``value`` and the ``file`` they come from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of text files with their ``file`` (full path) and ``line`` number from 1, whatever the number of
    tasks that read a file.

    A task numbers the rows that it reads one after another, and a block of a file is read by one task, so a
    line's place in its block follows from the block's first number, and the lines before the block from the
    sizes of the file's other blocks: one small row per block, no sort of lines."""
    read = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    blocks = read.groupBy("file", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("lines"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "file", "block", (F.coalesce(F.sum("lines").over(before), F.lit(0)) - F.col("first") + 1).alias("shift")
    )
    return read.join(starts, ["file", "block"]).select("value", "file", (F.col("place") + F.col("shift")).alias("line"))


def watch_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the lines of files that appear in a folder; every file is read once."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def read_dimension_csv(spark: SparkSession, path: str) -> DataFrame:
    """Transformer dimension from CSV without header: key, ratio text, capacity."""
    return typed_dimension(spark.read.schema("mp_id string, bl string, capacity string").csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path)


def write_lines(lines: DataFrame, path: str, files: int | None = None) -> None:
    """One text column, overwriting. Sorted input stays sorted over the part files.

    ``files=1`` gives a single file, which means a single task: only for small results.
    """
    (lines.coalesce(files) if files else lines).write.mode("overwrite").text(path)
