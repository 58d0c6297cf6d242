"""What micro-batches leave to later ones, in Parquet folders whose number does not grow with the batches.

A folder of level l holds the state of ``fan ** l`` batches in a row, and the folders to read for the first n
batches are the digits of n to the base ``fan``: at most ``fan - 1`` of each level. A row is therefore written
once per level, and within a folder there is one file per part (several where a part is large).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyguard.plans.scratch import remove_folder
from tallyguard.sources.files import write_parquet


def live_folders(batches: int, fan: int) -> list[tuple[int, int]]:
    """(level, first batch) of the folders that together hold the first ``batches`` batches."""
    sizes = [1]
    while sizes[-1] * fan <= batches:
        sizes.append(sizes[-1] * fan)
    found, start = [], 0
    for level in range(len(sizes) - 1, -1, -1):
        while start + sizes[level] <= batches:
            found.append((level, start))
            start += sizes[level]
    return found


@dataclass(frozen=True)
class BatchState:
    """State below ``root``; ``schema`` has the integer column ``part`` that folders are divided by.

    ``fold`` shortens rows of several batches to fewer rows of the same schema. Batch numbers count from 0 without
    a gap. A repeated batch writes the same folders again: what it merges is removed by the batch after it.
    """

    root: str
    schema: StructType
    part: str
    fold: Callable[[DataFrame], DataFrame] = lambda rows: rows
    fan: int = 16

    def _path(self, level: int, start: int) -> str:
        return f"{self.root}/level={level}/start={start}"

    def _read(self, spark: SparkSession, folders: list[tuple[int, int]]) -> DataFrame:
        paths = [self._path(*folder) for folder in folders]
        return spark.read.schema(self.schema).option("basePath", self.root).parquet(*paths).select(*self.schema.names)

    def _merged(self, batches: int) -> list[tuple[int, list[int]]]:
        """Levels that fill up with batch number ``batches - 1``, and the starts of the folders they take in."""
        found, level, size = [], 1, self.fan
        while batches % size == 0:
            step = size // self.fan
            found.append((level, list(range(batches - size, batches, step))))
            level, size = level + 1, size * self.fan
        return found

    def before(self, spark: SparkSession, number: int, parts: list[int]) -> DataFrame | None:
        """State of the batches before ``number`` in the named parts; other parts' files are not opened."""
        if number == 0 or not parts:
            return None
        return self._read(spark, live_folders(number, self.fan)).where(F.col(self.part).isin(*parts))

    def batch(self, spark: SparkSession, number: int) -> DataFrame:
        return self._read(spark, [(0, number)])

    def add(self, rows: DataFrame, number: int) -> None:
        """Write the state of a batch."""
        write_parquet(rows.select(*self.schema.names), self._path(0, number), (self.part,))

    def merge(self, spark: SparkSession, number: int) -> None:
        """After batch ``number``: fill the levels that are due, and remove what the batch before has merged."""
        if number > 0:
            for level, starts in self._merged(number):
                for start in starts:
                    remove_folder(spark, self._path(level - 1, start))
        for level, starts in self._merged(number + 1):
            rows = self.fold(self._read(spark, [(level - 1, start) for start in starts]))
            write_parquet(rows, self._path(level, starts[0]), (self.part,))
