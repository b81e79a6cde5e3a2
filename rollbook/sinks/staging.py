"""What the producing job knows between its runs, as Parquet in one folder.

- `resolved/version=n`: the outcome of every request that the n-th batch of responses decided, with the record and its
  final id, and of those that it tried and left open. Written once, and never more than the batch brought: an open
  request that a batch does not try stays where it is. `waited` marks a request that an older version has as open, so
  that the open ones of now are found among marked and open rows, without a look at the others.
- `commits/version=n`: one row, written after the version; names the stream's batch, so that a batch that is given
  again is not resolved again. Versions without a commit are not there.
- `runs/run=k`: one row, written before anything of the run is sent: the versions the run looks at, and the last
  request it goes through (null: all). `sent/run=k` follows when all is sent.

A request is gone through by a run that looks at its version and reaches its number. So what a run sends is settled
before it sends, and what no run has reached remains for the next one, however late it landed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.fixed import USER_COLUMNS

ACCEPTED = "accepted"
REJECTED = "rejected"
EXHAUSTED = "exhausted"
PENDING = "pending"

_OUTCOME = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("attempts", T.IntegerType()),
        *[T.StructField(name, T.StringType()) for name in ("outcome", "reason", "document")],
        *[T.StructField(name, T.StringType()) for name in USER_COLUMNS],
        T.StructField("waited", T.BooleanType()),
        T.StructField("version", T.LongType()),
    ]
)
_COMMIT = "query string, batch_id long, version long"
_RUN = "upto long, last long, run long"
_SENT = "done boolean, run long"


@dataclass(frozen=True)
class Run:
    number: int
    upto: int
    last: int | None

    def reaches(self) -> Column:
        """Whether the run went through a resolved request."""
        reached = F.col("version") <= self.upto
        return reached if self.last is None else reached & (F.col("request_id") <= self.last)


class Staging:
    """The folder of one producing job; one run of the job at a time writes to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._last: int | None = None

    def _read(self, name: str, schema: T.StructType | str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _write(self, frame: DataFrame, place: str) -> None:
        frame.write.mode("overwrite").parquet(f"{self.path}/{place}")

    # --- resolving ---

    def last_version(self) -> int:
        """-1 when there is none."""
        if self._last is None:
            last = self._read("commits", _COMMIT).agg(F.max("version")).first()[0]
            self._last = -1 if last is None else last
        return self._last

    def has(self, query: str, batch_id: int) -> bool:
        commits = self._read("commits", _COMMIT)
        mine = F.when((F.col("query") == query) & (F.col("batch_id") == batch_id), F.col("version"))
        last, version = commits.agg(F.max("version"), F.max(mine)).first()
        self._last = -1 if last is None else last
        return version is not None

    def resolved(self) -> DataFrame:
        """Every committed outcome, one per request; open requests count as of the last version."""
        last = self.last_version()
        rows = self._read("resolved", _OUTCOME).filter(F.col("version") <= last)
        decided = rows.filter(F.col("outcome") != PENDING)
        newest = lambda name: F.max_by(name, "version").alias(name)
        tried = rows.filter((F.col("outcome") == PENDING) | F.col("waited")).groupBy("request_id")
        still = tried.agg(newest("attempts"), newest("outcome")).filter(F.col("outcome") == PENDING)
        still = still.select("request_id", "attempts", F.lit(PENDING).alias("outcome"), F.lit(last).cast("long").alias("version"))
        return decided.unionByName(still, allowMissingColumns=True).drop("waited")

    def commit(self, outcomes: DataFrame, query: str, batch_id: int) -> None:
        version = self.last_version() + 1
        self._write(outcomes, f"resolved/version={version}")
        row = self.spark.createDataFrame([(query, batch_id)], "query string, batch_id long")
        self._write(row.coalesce(1), f"commits/version={version}")
        self._last = version

    # --- sending ---

    def runs(self) -> list[Run]:
        """One for each run of the job so far, in order."""
        rows = self._read("runs", _RUN).orderBy("run").collect()
        return [Run(row.run, row.upto, row.last) for row in rows]

    def is_sent(self, run: Run) -> bool:
        return bool(self._read("sent", _SENT).filter(F.col("run") == run.number).head(1))

    def begin(self, number: int, upto: int, last: int | None) -> Run:
        row = self.spark.createDataFrame([(upto, last)], "upto long, last long")
        self._write(row.coalesce(1), f"runs/run={number}")
        return Run(number, upto, last)

    def finish(self, run: Run) -> None:
        row = self.spark.createDataFrame([(True,)], "done boolean")
        self._write(row.coalesce(1), f"sent/run={run.number}")

    def left_by(self, runs: list[Run]) -> DataFrame:
        """The outcomes that none of these runs went through."""
        rows = self.resolved()
        for run in _edges(runs):
            rows = rows.filter(~F.coalesce(run.reaches(), F.lit(run.last is None)))
        return rows

    def progress(self) -> DataFrame:
        """Every outcome with the number of the run that went through it, null for what remains."""
        number = F.lit(None).cast("long")
        for run in reversed(self.runs()):
            number = F.when(run.reaches(), F.lit(run.number).cast("long")).otherwise(number)
        decided = F.when(F.col("outcome") != PENDING, number)
        return self.resolved().withColumn("run", decided).drop("version")


def _edges(runs: list[Run]) -> list[Run]:
    """The runs that matter: one that a later run outreaches says nothing more."""
    kept: list[Run] = []
    for run in reversed(runs):
        if not kept or kept[-1].last is not None and (run.last is None or run.last > kept[-1].last):
            kept.append(run)
    return kept
