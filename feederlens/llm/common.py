"""Helpers shared by the operators: staged tables, skew-proof joins on unique keys, word splitting."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feederlens.sources.storage import delete

#: Rows of a hot key are spread over this many tasks by joins that would otherwise keep them together.
SALTS = 16


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, whose Python workers import it, unless that was done."""
    context = spark.sparkContext
    if getattr(context, "_llm_shipped", False):
        return
    top = Path(__file__).resolve().parents[2]
    path = f"{tempfile.mkdtemp(prefix='llm-package-')}/feederlens_llm.zip"
    with zipfile.ZipFile(path, "w") as packed:
        for file in sorted((top / "feederlens").rglob("*.py")):
            packed.write(file, file.relative_to(top))
    context.addPyFile(path)
    context._llm_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares; only a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: it cuts the lineage, so a lost
    executor costs only the tasks that it ran, and several readers don't compute it again."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read._staged_path = path
    for made in _made[-1:]:
        made.append(read)
    return read


def discard(*frames: DataFrame) -> None:
    """Deletes staged tables whose last reader has written its result; other frames are left alone."""
    for df in frames:
        if path := getattr(df, "_staged_path", None):
            delete(df.sparkSession, path)


#: Staged tables made so far in each open ``passing`` block.
_made: list[list[DataFrame]] = []


@contextmanager
def passing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose staged tables go at its end, but for those given to the function that it yields. These must not
    be read from the others any more, so they are staged themselves."""
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    _made.append([])
    try:
        yield keep
    finally:
        discard(*(df for df in _made.pop() if not any(df is k for k in kept)))
        for made in _made[-1:]:
            made.extend(kept)


def spread(*columns: str | Column) -> Column:
    """A salt that rows of one key share out between them."""
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def join_unique(
    left: DataFrame, right: DataFrame, keys: list[str], salt: Column, how: str = "inner"
) -> DataFrame:
    """Joins rows to a table that has each key once at most, whatever share of the rows one key holds.

    Each row of the right side is repeated for all salts, so the rows of a hot key on the left meet
    it in several tasks."""
    salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.withColumn("_salt", salt).join(salted, [*keys, "_salt"], how).drop("_salt")


def join_wide(
    left: DataFrame, right: DataFrame, keys: list[str], salt: Column, how: str = "inner"
) -> DataFrame:
    """The same for a right side of wide rows: each is repeated only for the salts that its key has on the left."""
    salted = left.withColumn("_salt", salt)
    return salted.join(right.join(salted.select(*keys, "_salt").distinct(), keys), [*keys, "_salt"], how).drop("_salt")


#: What separates words, and what fingerprints of normalised texts leave out.
BLANKS = b" \t\n\x0b\x0c\r"


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; bytes.split() and bytes.lower() know ASCII only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()
