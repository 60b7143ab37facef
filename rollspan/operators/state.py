"""The newest record per key as a stored state that new days are added to.

A state is one folder per date, ``asof=yyyyMMdd``: the newest record of each key among the rows before that date. The next state is
the newest of the last one and of the days since, so a job reads one state and the new partitions, never the history, and
that gives what the whole history would: the newest of newest records is the newest of all, because ties are decided by a total order of rows.

A step is safe to run again: it starts from the state before its date whatever later states exist, writes its own folder anew, and
a folder counts only once it is complete (Spark's ``_SUCCESS``). Rows of days before the last state that come in late are seen by
``advance(..., since=date)``, which starts from an older state.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollspan.operators.windows import latest_per_key


@dataclass(frozen=True)
class NewestState:
    """States under ``path``; ``order`` says what is newest, ``day`` is the ``yyyyMMdd`` column the source is partitioned by."""

    spark: SparkSession
    path: str
    keys: Sequence[str]
    order: Sequence[str]
    day: str

    def dates(self) -> list[str]:
        """Dates of the complete states, oldest first."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return sorted(n.removeprefix("asof=") for n in names if n.startswith("asof="))

    def read(self, asof: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/asof={asof}")

    def base(self, upto: str, since: str | None = None) -> str | None:
        """The newest state before ``upto`` (and not after ``since``)."""
        return max((d for d in self.dates() if d < upto and (since is None or d <= since)), default=None)

    def step(self, source: DataFrame, upto: str, since: str | None = None) -> DataFrame:
        """The state as of ``upto``, from the state before it and the days since that one."""
        base = self.base(upto, since)
        rows = source.where(F.col(self.day) < upto)
        if base is None:
            return latest_per_key(rows, self.keys, self.order)
        new = rows.where(F.col(self.day) >= base)
        # both sides have few rows per key and meet in one shuffle; new rows are reduced before it
        return latest_per_key(self.read(base).unionByName(new), self.keys, self.order).select(*source.columns)

    def advance(self, source: DataFrame, upto: str, since: str | None = None) -> DataFrame:
        """Write and return the state as of ``upto``."""
        self.step(source, upto, since).write.mode("overwrite").parquet(f"{self.path}/asof={upto}")
        return self.read(upto)
