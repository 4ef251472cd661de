"""Ledger tables laid out for what reads them: bucketed for joins, partitioned for reports.

Bucketed: runs and app builds are stored by a hash of the app build's id, each bucket sorted by it. A join on that
id then reads both as they lie; only the small build side is shuffled, to the runs' buckets. One build with
a great share of all runs makes one bucket large, and a bucket is one task; for such ledgers use
``ledger.join_runs``, whose shuffle adaptive execution can split.

Partitioned: results lie in folders by instance and quarter. A report names the instances and quarters that it
needs in a table; the names are known only when that table has been read, and then skip all other folders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchledger.operators import ledger
from benchledger.sources import records

BUCKETS = 16
#: Columns that the folders of a results ledger are named by.
RESULT_FOLDERS = ("instance_id", "quarter")


@dataclass(frozen=True)
class BucketedLedger:
    """Three tables ``<name>_runs``, ``<name>_app_builds``, ``<name>_framework_builds`` below ``path``.

    Use as many buckets as the session has shuffle partitions, or more: with fewer, Spark prefers to shuffle
    both sides for the sake of parallel work.
    """

    spark: SparkSession
    name: str
    path: str
    buckets: int = BUCKETS

    def _write(self, rows: DataFrame, table: str, key: str, mode: str) -> None:
        # Dealt out by the same hash first, so that a bucket is one file for each time it is added to.
        dealt = rows.repartition(self.buckets, key)
        dealt.write.mode(mode).format("parquet").bucketBy(self.buckets, key).sortBy(key).option(
            "path", f"{self.path}/{table}"
        ).saveAsTable(f"{self.name}_{table}")

    def store(self, test_runs: DataFrame, app_builds: DataFrame, framework_builds: DataFrame, mode: str = "overwrite") -> None:
        """``mode="append"`` adds records that the ledger does not hold yet."""
        self._write(test_runs, "runs", "app_build_id", mode)
        self._write(app_builds, "app_builds", "app_build_id", mode)
        self._write(framework_builds, "framework_builds", "framework_build_id", mode)

    def open(self, schemas: dict[str, str]) -> None:
        """Name the stored tables in a catalog that does not know them; ``schemas`` by table."""
        for table, schema in schemas.items():
            key = "framework_build_id" if table == "framework_builds" else "app_build_id"
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name}_{table} ({schema}) USING parquet "
                f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{table}'"
            )

    def table(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{table}")

    def joined_runs(self) -> DataFrame:
        """What ``ledger.join_runs`` gives; the runs are not shuffled."""
        return ledger.join_runs(self.table("runs"), self.table("app_builds"), self.table("framework_builds"))

    def latest_runs(self) -> DataFrame:
        """The last run per app build and test, without a shuffle: a bucket holds all runs of a build."""
        rest = [c for c in self.table("runs").columns if c not in ("app_build_id", "test_name")]
        return ledger.latest_by(self.table("runs"), ["app_build_id", "test_name"], ["end_time", "test_run_id"], rest)


def quarter_of(time: F.Column) -> F.Column:
    """Year and quarter as a number, such as 19983."""
    return F.year(time) * 10 + F.quarter(time)


def store_results(results: DataFrame, path: str, batch_id: int) -> None:
    """Add results (instance_id, end_time, test_run_id and others) as one batch, in folders by instance and quarter."""
    rows = results.withColumn("quarter", quarter_of(F.col("end_time")))
    # A folder's rows come together, so that a batch adds one file to it; adaptive execution splits large folders.
    records.append_batch(rows.hint("rebalance", *RESULT_FOLDERS), path, batch_id, RESULT_FOLDERS)


def results_in(spark: SparkSession, path: str, schema: str, windows: DataFrame) -> DataFrame:
    """The stored results of the instances and quarters in ``windows``, the last batch's row for each run.

    ``schema`` has the stored columns without the folders' ones. While ``windows`` is small enough to be broadcast
    (by the session's limit), its values skip folders at run time; a larger one is joined without that.
    """
    full = f"{schema}, instance_id int, quarter int"
    rows = records.read_batches(spark, path, full).join(windows.select(*RESULT_FOLDERS).distinct(), [*RESULT_FOLDERS], "left_semi")
    rest = [c for c in rows.columns if c not in ("test_run_id", "batch_id")]
    return ledger.latest_by(rows, ["test_run_id"], ["batch_id"], rest)
