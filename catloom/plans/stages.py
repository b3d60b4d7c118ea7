"""Tables that several outputs of one run share."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Stages:
    """Named tables, each written once, when something first asks for it.

    What no output asks for is never planned. Later readers start from the files, so
    neither they nor a lost executor repeat the work before. ``rows`` counts what was
    written, by the writes themselves. Writing again replaces the files.
    """

    def __init__(self, spark: SparkSession, root: str, build: dict[str, Callable[[], DataFrame]]):
        self._spark, self._root, self._build = spark, f"{root.rstrip('/')}/processed", build
        self._tables: dict[str, DataFrame] = {}
        self._locks = {name: Lock() for name in build}
        self.rows: dict[str, int] = {}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._tables:
                df, seen, path = self._build[name](), Observation(), f"{self._root}/{name}"
                df.observe(seen, F.count("*").alias("n")).write.mode("overwrite").option("compression", "zstd").parquet(path)
                self.rows[name] = int(seen.get["n"])
                self._tables[name] = self._spark.read.schema(df.schema).parquet(path)
            return self._tables[name]

    def together(self, *names: str) -> list[DataFrame]:
        """Several tables; what one does not need of another is written at the same time."""
        with ThreadPoolExecutor(len(names)) as pool:
            return list(pool.map(inheritable_thread_target(self._spark)(self.__getitem__), names))

    def total(self, *names: str) -> int | None:
        """Rows of those tables together; none while one is not written."""
        return sum(self.rows[n] for n in names) if all(n in self.rows for n in names) else None
