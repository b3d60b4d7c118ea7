"""What several operators share: reading tables, words, and tables kept between jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catloom.session import shared_folder

#: Words are runs of anything but the six ASCII white-space characters.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"

#: Spark's switch to delete the shuffle files of a query at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_array(text: Column) -> Column:
    """The words of a text, in order; an empty array for null, empty or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; -1 for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % divisor, F.lit(-1))


def keep(df: DataFrame, purpose: str, *by: str, compression: str = "snappy") -> DataFrame:
    """Write a table to the shared folder and read it back, in folders by the columns ``by``.

    Whole texts are best kept with ``compression`` zstd, which takes more time and less disk.

    Later jobs start from the files, so neither a second use nor a lost executor
    repeats the work above. Nothing needs the shuffles of the write after it: Spark
    deletes their files at its end, where they would else stay until the driver's
    memory is next collected.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, purpose)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*by).parquet(folder, compression=compression)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def release(df: DataFrame) -> None:
    """Delete the files of a kept table (one without ``by`` columns or with one) that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        place = jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
