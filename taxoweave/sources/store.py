"""The result store: an append-only log of Parquet folders below one path.

A run appends only the rows it learnt. Every append is a folder of its own and
becomes visible through a marker, also a folder of its own, that is written
last; so a failed run leaves nothing behind that a reader sees, and runs that
write at the same time do not touch each other's files. A reader takes the
newest whole table, the *base*, and lays the later appends over it: of several
rows of a key the one of the latest append counts. ``compact`` writes a new base
and ``vacuum`` removes what it covers.

The log also remembers runs by their number: the results of a run that is
started again are read and not made a second time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxoweave.operators.incremental import newest_good
from taxoweave.schemas import RUN_RESULTS, STORE
from taxoweave.session import remove_path

_MARKERS = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("folder", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("run", T.StringType()), T.StructField("covers", T.ArrayType(T.StringType())),
])

#: Appends after which an upsert compacts the log.
COMPACT_AFTER = 20


@dataclass(frozen=True)
class _Log:
    """The markers: the newest base, the appends that it does not cover, and all of them."""

    marks: list
    base: T.Row | None
    appends: list

    @property
    def version(self) -> int:
        return max((m.version for m in self.marks), default=0)


class ResultStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _log(self) -> _Log:
        """All markers; their number is bounded by :meth:`vacuum`."""
        try:
            return self._of(self.spark.read.schema(_MARKERS).parquet(f"{self.path}/marks/*").collect())
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self._of([])

    @staticmethod
    def _of(marks: list) -> _Log:
        marks = sorted(marks, key=lambda m: (m.version, m.folder))
        bases = [m for m in marks if m.kind == "base"]
        base = bases[-1] if bases else None
        covered = set(base.covers) if base else set()
        return _Log(marks, base, [m for m in marks if m.kind == "append" and m.folder not in covered])

    def version(self) -> int:
        """The number of the last append or table, 0 when there is none."""
        return self._log().version

    def _commit(self, rows: DataFrame, kind: str, log: _Log, run: str | None = None) -> _Log:
        """Write rows to a fresh folder, then its marker; returns the log with it."""
        version = log.version + 1
        folder = f"{version:08d}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/rows/{folder}")
        covers = [m.folder for m in log.marks if m.kind != "run"] if kind == "base" else []
        mark = T.Row(*_MARKERS.fieldNames())(version, folder, kind, run, covers)
        self.spark.createDataFrame([mark], _MARKERS).coalesce(1).write.parquet(f"{self.path}/marks/{folder}")
        return self._of([*log.marks, mark])

    def _folder(self, mark: T.Row, schema: T.StructType = STORE) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows/{mark.folder}")

    def read(self) -> DataFrame:
        """The current store; an absent one is an empty table."""
        return self._read(self._log())

    def _read(self, log: _Log) -> DataFrame:
        base = self._folder(log.base) if log.base else self.spark.createDataFrame([], STORE)
        if not log.appends:
            return base
        rows = reduce(DataFrame.unionByName, [self._folder(m).withColumn("_order", F.lit(i)) for i, m in enumerate(log.appends)])
        newest = rows.groupBy("cache_key").agg(F.max("_order").alias("_order"))
        latest = rows.join(newest, ["cache_key", "_order"]).drop("_order") if len(log.appends) > 1 else rows.drop("_order")
        if not log.base:
            return latest
        return base.join(newest.select("cache_key"), "cache_key", "left_anti").unionByName(latest)

    def write(self, store: DataFrame) -> DataFrame:
        """Replace the store by a whole table and return it."""
        return self._read(self._commit(store.select(STORE.fieldNames()), "base", self._log()))

    def upsert(self, results: DataFrame, run: str | None = None) -> DataFrame:
        """Append the good results of a run, which carry ``cache_key``, and return the store.

        Only their keys are written. A ``run`` that is in the log already adds
        nothing.
        """
        log = self._log()
        if run is None or all(m.run != run for m in log.marks if m.kind == "append"):
            log = self._commit(newest_good(results), "append", log, run)
            if len(log.appends) >= COMPACT_AFTER:
                self.compact()
                log = self._log()
        return self._read(log)

    def recorded(self, run: str) -> DataFrame | None:
        """The results that a run has recorded, or None."""
        return self._recorded(run, self._log())

    def _recorded(self, run: str, log: _Log) -> DataFrame | None:
        marks = [m for m in log.marks if m.kind == "run" and m.run == run]
        return self._folder(marks[0], RUN_RESULTS) if marks else None

    def record(self, run: str, results: DataFrame) -> DataFrame:
        """Write down the new results of a run, errors included, and return them as written."""
        return self._recorded(run, self._commit(results.select(RUN_RESULTS.fieldNames()), "run", self._log(), run))

    def compact(self) -> None:
        """Write the present table as a new base; appends that come meanwhile stay on top of it."""
        log = self._log()
        if log.appends:
            self._commit(self._read(log), "base", log)

    def vacuum(self, keep_runs: int = 100) -> int:
        """Remove what the newest base covers and all but the last recorded runs; returns the number of folders.

        For times when nobody reads an older state.
        """
        log = self._log()
        runs = [m for m in log.marks if m.kind == "run"]
        covered = set(log.base.covers) if log.base else set()
        # An append's marker says that its run is in the store, so it stays as long as the run is remembered.
        remembered = {m.run for m in runs[max(0, len(runs) - keep_runs):]}
        gone = [m for m in log.marks if (m.kind == "run" and m.run not in remembered) or m.folder in covered]
        for mark in gone:
            if not (mark.kind == "append" and mark.run in remembered):
                remove_path(self.spark, f"{self.path}/marks/{mark.folder}")
            remove_path(self.spark, f"{self.path}/rows/{mark.folder}")
        return len(gone)
