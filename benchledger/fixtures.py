"""Native tables as views over the star-schema test data.

The SQL constants hold only the mapping from test data to input tables. Spark and the SQL oracle
both read them, so that each works on the same input; no operator is expressed here.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from benchledger.functions import parse, text
from benchledger.operators.ordering import number_rows
from benchledger.schemas import RecordLayout
from benchledger.session import settle

BRANCHES = 10
FIRST_BUILD = 1_400_000_000  # epoch seconds

_written: dict[tuple[str, str, str], DataFrame] = {}

# Some builds have an id that nothing refers to, so what would refer to them leads nowhere.
FRAMEWORK_BUILDS = """
SELECT md5(concat(CASE WHEN c_custkey % 13 = 0 THEN 'unused pb' ELSE 'pb' END, CAST(c_custkey AS STRING))) AS framework_build_id,
       CAST(c_nationkey AS INT) AS instance_id,
       md5(CAST((c_custkey - c_custkey % 3) * 10 AS STRING)) AS framework_commit,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'AUTOMOBILE' THEN NULL ELSE 0 END AS return_code,
       c_custkey % 5 <> 0 AS artefact_present,
       c_custkey AS build_seq
FROM {customer}
"""

APP_BUILDS = """
SELECT md5(concat(CASE WHEN o_orderkey % 11 = 0 THEN 'unused ab' ELSE 'ab' END, CAST(o_orderkey AS STRING))) AS app_build_id,
       md5(concat('pb', CAST(o_custkey AS STRING))) AS framework_build_id,
       o_orderpriority AS app_name,
       md5(CAST(year(o_orderdate) AS STRING)) AS apps_commit,
       CASE o_orderstatus WHEN 'P' THEN 1 ELSE 0 END AS return_code,
       o_orderkey % 4 <> 0 AS artefact_present,
       o_orderdate AS end_time
FROM {orders}
"""

TEST_RUNS = """
SELECT md5(concat_ws('|', CAST(l_orderkey AS STRING), CAST(l_partkey AS STRING),
           CAST(l_suppkey AS STRING), CAST(l_linenumber AS STRING),
           CAST(CAST(l_quantity AS INT) AS STRING), CAST(CAST(l_shipdate AS DATE) AS STRING))) AS test_run_id,
       md5(concat('ab', CAST(l_orderkey AS STRING))) AS app_build_id,
       concat(l_returnflag, '-', l_linestatus) AS test_name,
       l_shipdate AS end_time,
       CAST(l_linenumber AS BIGINT) * 30000000 AS duration_us,
       CAST(floor(l_extendedprice) AS BIGINT) AS requests,
       CAST(l_partkey * 1024 AS BIGINT) AS bytes,
       CASE WHEN l_suppkey % 10 = 0 THEN CAST(l_linenumber AS BIGINT) ELSE CAST(0 AS BIGINT) END AS err_connect,
       CAST(CASE WHEN l_partkey % 17 = 0 THEN 1 ELSE 0 END AS BIGINT) AS err_read,
       CAST(0 AS BIGINT) AS err_write,
       CAST(CASE WHEN l_partkey % 19 = 0 THEN 2 ELSE 0 END AS BIGINT) AS err_status,
       CAST(CASE WHEN l_partkey % 5 = 0 THEN 3 ELSE 0 END AS BIGINT) AS err_timeout,
       l_quantity * 100 AS latency_mean_us,
       CAST(l_quantity AS BIGINT) * 250 AS latency_p95_us,
       l_suppkey % 7 = 0 AS repeated_p95,
       l_partkey % 41 = 0 AS never_measured,
       CASE WHEN l_orderkey % 97 = 0 THEN 'no_stdout' WHEN l_orderkey % 89 = 0 THEN 'no_marker'
            WHEN l_orderkey % 83 = 0 THEN 'bad_json' ELSE 'ok' END AS output_kind
FROM {lineitem}
"""

# Runs that end ten days after their build for each line of the order; the seventh line's is later than any run should be.
TIMED_RUNS = """
SELECT md5(concat_ws('|', CAST(l_orderkey AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING),
                     CAST(l_linenumber AS STRING), CAST(CAST(l_quantity AS INT) AS STRING))) AS test_run_id,
       md5(concat('ab', CAST(l_orderkey AS STRING))) AS app_build_id, concat(l_returnflag, '-', l_linestatus) AS test_name,
       o_orderdate + INTERVAL '10' DAY * CAST(l_linenumber AS INT) AS end_time
FROM {lineitem} AS l JOIN {orders} AS o ON l_orderkey = o_orderkey
"""

# Position n = 3 (mod 5) is a side commit; the next one is a merge with the side as second parent.
COMMIT_LOG = """
WITH p AS (SELECT concat('b', CAST(o_custkey % 10 AS STRING)) AS branch,
                  md5(CAST(o_orderkey AS STRING)) AS commit_id, o_orderdate AS commit_time,
                  row_number() OVER (PARTITION BY o_custkey % 10 ORDER BY o_orderdate, o_orderkey) AS n
           FROM {orders})
SELECT branch, commit_id, commit_time, n,
       CASE WHEN n % 5 = 4 THEN lag(commit_id, 2) OVER w ELSE lag(commit_id, 1) OVER w END AS parent0,
       CASE WHEN n % 5 = 4 THEN lag(commit_id, 1) OVER w END AS parent1
FROM p WINDOW w AS (PARTITION BY branch ORDER BY n)
"""

# Histories with a side branch that leaves the trunk in its first eighth and is never merged: position n = 3
# (mod 5) is its next commit. Before, side commits are single and merged at once.
SIDE_BRANCHES = 4
SIDE_LOG = """
WITH p AS (SELECT concat('s', CAST(o_custkey % 4 AS STRING)) AS branch,
                  md5(concat('side', CAST(o_orderkey AS STRING))) AS commit_id, o_orderdate AS commit_time,
                  row_number() OVER (PARTITION BY o_custkey % 4 ORDER BY o_orderdate, o_orderkey) AS n,
                  count(*) OVER (PARTITION BY o_custkey % 4) AS top
           FROM {orders})
SELECT branch, commit_id, commit_time, n, top,
       CASE WHEN n % 5 = 4 THEN lag(commit_id, 2) OVER w
            WHEN n % 5 = 3 AND (n - 5) * 8 >= top THEN lag(commit_id, 5) OVER w
            ELSE lag(commit_id, 1) OVER w END AS parent0,
       CASE WHEN n % 5 = 4 AND n * 8 < top THEN lag(commit_id, 1) OVER w END AS parent1
FROM p WINDOW w AS (PARTITION BY branch ORDER BY n)
"""

SAMPLES = """
SELECT user_id AS run_key, ts, CAST(round(value * 100) AS BIGINT) * 10 AS latency_us, event_type AS outcome
FROM {events}
"""

# Matrix lines as a user may have typed them: some break a rule, some name unknown tests.
RAW_MATRIX = """
SELECT p_partkey AS config_id, p_brand AS branch,
       CASE p_partkey % 7 WHEN 5 THEN p_name WHEN 6 THEN concat(p_name, '..', p_type, '..HEAD')
            WHEN 4 THEN concat(p_name, '..') ELSE concat(p_name, '..HEAD') END AS revision_range,
       (p_size % 6) * 0.25E0 AS sampling,
       concat('apps-', CAST(p_size % 3 AS STRING)) AS apps_branch, 'HEAD' AS apps_revision,
       CASE p_size % 4 WHEN 0 THEN 'A-F,A-O,N-F' WHEN 1 THEN 'N-O,R-F' WHEN 2 THEN 'A-F,X-X' ELSE 'N-F' END AS test_list
FROM {part}
"""

# Lines that name commits by beginnings of one to nine characters, on known and unknown branches.
VAGUE_MATRIX = """
SELECT p_partkey AS config_id, 0 AS instance_id, concat('b', CAST(p_partkey % 12 AS STRING)) AS branch,
       concat(substring(md5(CAST(p_partkey AS STRING)), 1, 1 + p_size % 9), '..',
              CASE p_size % 2 WHEN 0 THEN 'HEAD' ELSE substring(md5(CAST(p_size AS STRING)), 1, 3) END) AS revision_range,
       0.5E0 AS sampling, concat('apps-', CAST(p_size % 5 AS STRING)) AS apps_branch,
       CASE p_size % 3 WHEN 0 THEN 'HEAD' WHEN 1 THEN substring(md5(CAST(199600 + p_size % 15 AS STRING)), 1, 8)
            ELSE substring(md5(CAST(p_size AS STRING)), 1, 1) END AS apps_revision
FROM {part}
"""

TESTS = """
SELECT * FROM (VALUES
  ('A-F', '1-URGENT', 'flag A closed', '<server.url>/simple'),
  ('A-O', '2-HIGH', 'flag A open', '<server.url>/download/51200'),
  ('N-F', '3-MEDIUM', 'flag N closed', '<server.url>/template/simple'),
  ('N-O', '4-NOT SPECIFIED', 'flag N open', '<server.url>/json/encode'),
  ('R-F', '5-LOW', 'flag R closed', '<server.url>/template/lang'),
  ('R-O', '1-URGENT', 'flag R open', '<server.url>/upload')
) AS t(test_name, app_name, description, url)
"""

# One line per branch and two more for b0: config 10 covers part of config 0 under another apps
# branch (both tasks stay), config 11 under the same one (whole-row distinct merges them).
# Some lines end at an older commit, on the chain or (config 3) on a side commit of its own.
# Starts lie on the chain (i % 3 = 0), on a side commit (1), at the head (2) or at the first commit.
PLAN_CONFIG = """
WITH heads AS (SELECT branch, max(n) AS top, CAST(substring(branch, 2) AS INT) AS i
               FROM {commit_log} GROUP BY branch),
lines AS (
  SELECT i AS config_id, branch, top, i AS pick, i % 3 AS apps FROM heads
  UNION ALL SELECT 10, branch, top, 0, 1 FROM heads WHERE i = 0
  UNION ALL SELECT 11, branch, top, 0, 0 FROM heads WHERE i = 0
)
SELECT config_id, pick % 4 AS instance_id, branch,
       CASE WHEN config_id % 4 = 3 THEN CAST(floor(top * 3 / 4) AS BIGINT) - CAST(floor(top * 3 / 4) AS BIGINT) % 5 + config_id % 5
            ELSE top END AS end_n,
       CASE WHEN pick = 2 THEN top
            WHEN pick % 3 = 0 THEN greatest(CAST(floor(top / 4) AS BIGINT) - CAST(floor(top / 4) AS BIGINT) % 5, 1)
            WHEN pick % 3 = 1 THEN CAST(floor(top / 2) AS BIGINT) - CAST(floor(top / 2) AS BIGINT) % 5 + 3
            ELSE 1 END AS start_n,
       CASE config_id % 4 WHEN 0 THEN 1.0E0 WHEN 1 THEN 0.25E0 WHEN 2 THEN 0.5E0 ELSE 0.0E0 END AS sampling,
       concat('apps-', CAST(apps AS STRING)) AS apps_branch,
       CASE config_id % 5 WHEN 3 THEN substring(md5(CAST((1995 + apps) * 100 + 3 AS STRING)), 1, 10)
            WHEN 4 THEN md5(CAST((1995 + apps) * 100 + 5 AS STRING)) ELSE 'HEAD' END AS apps_revision,
       CASE WHEN config_id % 2 = 0 THEN 'A-F,A-O,N-F,N-O,R-F,R-O' ELSE 'A-F,N-O,R-O' END AS test_list
FROM lines
"""

APPS_REFS = """
SELECT concat('apps-', CAST(y - 1995 AS STRING)) AS branch, md5(CAST(y AS STRING)) AS head
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM {orders}) AS years
"""

# The months of a branch's year are its older commits; the year is the head.
APPS_LOG = """
SELECT DISTINCT concat('apps-', CAST(year(o_orderdate) - 1995 AS STRING)) AS branch,
       md5(CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING)) AS commit_id
FROM {orders}
UNION
SELECT concat('apps-', CAST(year(o_orderdate) - 1995 AS STRING)), md5(CAST(year(o_orderdate) AS STRING)) FROM {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, text: str, source: str) -> DataFrame:
    return spark.sql(text, **{source: table(spark, sf_dir, source)})


def framework_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.timestamp_seconds(F.lit(FIRST_BUILD) + F.col("build_seq") * 60)
    return _successful(_view(spark, sf_dir, FRAMEWORK_BUILDS, "customer")).withColumn("end_time", end)


def app_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _successful(_view(spark, sf_dir, APP_BUILDS, "orders"))


def _successful(builds: DataFrame) -> DataFrame:
    """One execution per build: no return code means it was cut off."""
    return builds.withColumn("successful", F.coalesce(F.col("return_code") == 0, F.lit(False)))


def test_run_numbers(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    # The test files have one row group; the text that is made of the rows is worth all cores.
    rows = table(spark, sf_dir, "lineitem").repartition(parts or spark.sparkContext.defaultParallelism)
    return spark.sql(TEST_RUNS, lineitem=rows)


def timed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TIMED_RUNS, lineitem=table(spark, sf_dir, "lineitem"), orders=table(spark, sf_dir, "orders"))


def test_runs(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Runs as the engine sees them: the numbers exist only inside the captured text."""
    runs = test_run_numbers(spark, sf_dir, parts)
    return runs.select(
        "test_run_id", "app_build_id", "test_name", "end_time", _stdout().alias("stdout")
    )


def test_runs_with_executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with the raw [warm-up, measured] sequence; some were never measured.

    The measured execution takes as long as the run's duration says.
    """
    runs = test_run_numbers(spark, sf_dir)
    started = F.timestamp_micros(F.unix_micros(F.col("end_time").cast("timestamp")) - F.col("duration_us")).cast("timestamp_ntz")
    warm_up = F.struct(
        (F.col("end_time") - F.expr("INTERVAL 600 SECONDS")).alias("start_time"),
        (F.col("end_time") - F.expr("INTERVAL 500 SECONDS")).alias("end_time"),
        F.lit("warming up").alias("stdout"),
    )
    measured = F.struct(started.alias("start_time"), F.col("end_time"), _stdout().alias("stdout"))
    executions = F.when(
        F.col("never_measured"),
        F.array().cast("array<struct<start_time:timestamp_ntz,end_time:timestamp_ntz,stdout:string>>"),
    ).otherwise(F.array(warm_up, measured))
    return runs.select("test_run_id", "app_build_id", "test_name", executions.alias("executions"))


def _stdout() -> F.Column:
    """Load-generator text around the numbers of a run."""

    def text(column: str) -> F.Column:
        return F.col(column).cast("string")

    p95 = text("latency_p95_us")
    p95_pairs = F.when(
        F.col("repeated_p95"),
        F.concat(F.lit("[95,"), (F.col("latency_p95_us") - 1).cast("string"), F.lit("],[95,"), p95, F.lit("]")),
    ).otherwise(F.concat(F.lit("[95,"), p95, F.lit("]")))
    body = F.concat(
        F.lit('{"summary":{"duration":'), text("duration_us"),
        F.lit(',"requests":'), text("requests"),
        F.lit(',"bytes":'), text("bytes"),
        F.lit(',"errors":{"connect":'), text("err_connect"),
        F.lit(',"read":'), text("err_read"),
        F.lit(',"write":'), text("err_write"),
        F.lit(',"status":'), text("err_status"),
        F.lit(',"timeout":'), text("err_timeout"),
        F.lit('}},"latency":{"min":90,"mean":'), text("latency_mean_us"),
        F.lit(',"max":1.23457e+06,"stdev":300.1,"percentile":[[1,100],[50,'), p95, F.lit("],"), p95_pairs,
        F.lit(',[99,4000]]},"requests":{"min":1,"mean":2.5,"max":9,"stdev":1.5,"percentile":[[50,2],[95,8]]}'),
    )
    header = F.lit("Running 2m test @ http://localhost:9000/simple\n")
    kind = F.col("output_kind")
    return (
        F.when(kind == "no_stdout", F.lit(None).cast("string"))
        .when(kind == "no_marker", header)
        .when(kind == "bad_json", F.concat(header, F.lit(parse.MARKER), F.lit(" "), body))
        .otherwise(F.concat(header, F.lit(parse.MARKER), F.lit(" "), body, F.lit("}\n")))
    )


def commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(branch, commit_id, commit_time, n, parents): a written table, one per session and directory."""
    return _written_once(spark, sf_dir, "commit_log", lambda: _commit_rows(spark, sf_dir))


def _written_once(spark: SparkSession, sf_dir: str, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """An input that is a stored table in practice: derived and written at its first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = settle(rows(), name)
    return _written[key]


def _commit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("b"), (F.col("o_custkey") % BRANCHES).cast("string")).alias("branch"),
        F.md5(F.col("o_orderkey").cast("string")).alias("commit_id"),
        F.col("o_orderdate").alias("commit_time"),
        "o_orderkey",
    )
    order = [F.col("commit_time"), F.col("o_orderkey")]
    numbered = number_rows(commits, order, partition=["branch"], few_keys=True).withColumnRenamed("seq", "n")
    merge = F.col("n") % 5 == 4
    return _with_before(numbered.drop("o_orderkey"), (1, 2)).select(
        "branch", "commit_id", "commit_time", "n",
        F.filter(
            F.when(merge, F.array("before2", "before1")).otherwise(F.array("before1")),
            lambda p: p.isNotNull(),
        ).alias("parents"),
    )


#: Positions of a branch that one task looks back in.
LOOK_BACK_ROWS = 100_000


def _with_before(numbered: DataFrame, steps: tuple[int, ...]) -> DataFrame:
    """Add ``before<k>``, the id of the commit ``k`` positions before on the branch.

    Ranges of positions are blocks, and the last rows of each go to the next one, too.
    """
    own = F.floor((F.col("n") - 1) / LOOK_BACK_ROWS)
    sent = F.sequence(own, F.floor((F.col("n") - 1 + max(steps)) / LOOK_BACK_ROWS))
    dealt = numbered.withColumn("_block", F.explode(sent))
    earlier = Window.partitionBy("branch", "_block").orderBy("n")
    found = dealt.select("*", *[F.lag("commit_id", k).over(earlier).alias(f"before{k}") for k in steps])
    return found.filter(F.col("_block") == own).drop("_block")


def side_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(branch, commit_id, commit_time, n, top, parents): a written table, as ``commit_log``."""
    return _written_once(spark, sf_dir, "side_log", lambda: _side_rows(spark, sf_dir))


def _side_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    commits = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("s"), (F.col("o_custkey") % SIDE_BRANCHES).cast("string")).alias("branch"),
        F.md5(F.concat(F.lit("side"), F.col("o_orderkey").cast("string"))).alias("commit_id"),
        F.col("o_orderdate").alias("commit_time"),
        "o_orderkey",
    )
    order = [F.col("commit_time"), F.col("o_orderkey")]
    numbered = settle(number_rows(commits, order, partition=["branch"], few_keys=True).withColumnRenamed("seq", "n"), "numbered")
    place = F.col("n") % 5
    on_side = (place == 3) & ((F.col("n") - 5) * 8 >= F.col("top"))
    first = F.when(place == 4, F.col("before2")).when(on_side, F.col("before5")).otherwise(F.col("before1"))
    merged = F.when((place == 4) & (F.col("n") * 8 < F.col("top")), F.col("before1"))
    tops = settle(numbered.groupBy("branch").agg(F.count("*").alias("top")), "tops")
    return _with_before(numbered.drop("o_orderkey"), (1, 2, 5)).join(F.broadcast(tops), "branch").select(
        "branch", "commit_id", "commit_time", "n", "top",
        F.filter(F.array(first, merged), lambda p: p.isNotNull()).alias("parents"),
    )


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branch heads: the commit with the largest position."""
    commits = commit_log(spark, sf_dir)
    heads = commits.groupBy("branch").agg(F.max_by("commit_id", "n").alias("head"))
    return _written_once(spark, sf_dir, "refs", lambda: heads)


def apps_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, APPS_REFS, "orders")


def apps_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, APPS_LOG, "orders")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SAMPLES, "events")


def tests(spark: SparkSession) -> DataFrame:
    return spark.sql(TESTS).select(
        "test_name", "app_name", "description",
        F.array(F.lit("-s<assets.home>/report.lua"), F.col("url")).alias("wrk_args"),
    )


def raw_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, RAW_MATRIX, "part").withColumn(
        "test_names", F.split("test_list", ",")
    ).drop("test_list")


def vague_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, VAGUE_MATRIX, "part")


def plan_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test matrix over the commit log; ranges name the start commit by its full id."""
    return _written_once(spark, sf_dir, "plan_config", lambda: _plan_rows(commit_log(spark, sf_dir)))


def _plan_rows(commits: DataFrame) -> DataFrame:
    lines = commits.sparkSession.sql(PLAN_CONFIG, commit_log=commits)
    starts = commits.select(
        F.col("branch"), F.col("n").alias("start_n"), F.col("commit_id").alias("start_id")
    )
    ends = commits.select(F.col("branch"), F.col("n").alias("end_n"), F.col("commit_id").alias("end_id"))
    end = F.when(F.col("config_id") % 4 == 3, F.substring("end_id", 1, 12)).otherwise("HEAD")
    return lines.join(starts, ["branch", "start_n"]).join(ends, ["branch", "end_n"]).select(
        "config_id", "instance_id", "branch",
        F.concat("start_id", F.lit(".."), end).alias("revision_range"),
        "sampling", "apps_branch", "apps_revision",
        F.split("test_list", ",").alias("test_names"),
    )


LAYOUT = RecordLayout()

#: Records in a file of an archive. Files are compressed, so each is read by one task.
ARCHIVE_RECORDS = 100_000


def archive_scale(spark: SparkSession, sf_dir: str, files: int) -> int:
    """How many times ``files`` files the archive of runs needs."""
    return max(1, math.ceil(table(spark, sf_dir, "lineitem").count() / (files * ARCHIVE_RECORDS)))


def record_documents(spark: SparkSession, sf_dir: str, name: str, parts: int | None = None) -> DataFrame:
    """Native tables as full nested records, the way record files hold them.

    ``parts`` deals runs out to as many partitions, before they become text.
    """
    if name == "framework_builds":
        builds = framework_builds(spark, sf_dir)
        end = F.col("end_time")
        executions = F.when(
            F.col("build_seq") % 29 == 0, F.array().cast(f"array<{_execution(end, None, None)[1]}>")
        ).otherwise(F.array(_execution(end, None, F.lit(0))[0], _execution(end, None, F.col("return_code"))[0]))
        return builds.select(
            text.uuid_text(F.col("framework_build_id")).alias("id"),
            instance_uuid(F.col("instance_id")).alias(LAYOUT.instance_key),
            F.col("framework_commit").alias(LAYOUT.commit_key),
            _java(end).alias("javaVersionExecution"),
            executions.alias("buildExecutions"),
        )
    if name == "app_builds":
        end = F.col("end_time").cast("timestamp")
        return app_builds(spark, sf_dir).select(
            text.uuid_text(F.col("app_build_id")).alias("id"),
            text.uuid_text(F.col("framework_build_id")).alias(LAYOUT.framework_build_key),
            F.col("app_name").alias("appName"),
            F.col("apps_commit").alias("appsCommit"),
            _java(end).alias("javaVersionExecution"),
            F.array(_execution(end, None, F.col("return_code"))[0]).alias("buildExecutions"),
        )
    end = F.col("end_time").cast("timestamp")
    return test_runs(spark, sf_dir, parts).select(
        text.uuid_text(F.col("test_run_id")).alias("id"),
        text.uuid_text(F.col("app_build_id")).alias("appBuildId"),
        F.col("test_name").alias("testName"),
        _java(end).alias("javaVersionExecution"),
        _execution(end, None, None)[0].alias("serverExecution"),
        F.array(
            _execution(end - F.expr("INTERVAL 120 SECONDS"), F.lit("warming up"), F.lit(0))[0],
            _execution(end, F.col("stdout"), F.lit(0))[0],
        ).alias("wrkExecutions"),
    )


def instance_uuid(instance_id: F.Column) -> F.Column:
    return text.uuid_text(F.md5(F.concat(F.lit("instance"), instance_id.cast("string"))))


def _execution(end: F.Column, stdout: F.Column | None, code: F.Column | None) -> tuple[F.Column, str]:
    """An execution of one minute, and its type as written (times are epoch milliseconds)."""
    millis = F.unix_millis(end)
    command = F.struct(
        F.lit("wrk").alias("program"),
        F.array(F.lit("-t16"), F.lit("-c32")).alias("args"),
        F.lit("<apps.home>").alias("workingDir"),
        F.create_map(F.lit("LANG"), F.lit("en_US.UTF-8")).alias("env"),
    )
    value = F.struct(
        command.alias("command"),
        (millis - 60_000).alias("startTime"),
        millis.alias("endTime"),
        (F.lit(None) if stdout is None else stdout).cast("string").alias("stdout"),
        F.lit(None).cast("string").alias("stderr"),
        (F.lit(None) if code is None else code).cast("int").alias("returnCode"),
    )
    kind = (
        "struct<command:struct<program:string,args:array<string>,workingDir:string,env:map<string,string>>,"
        "startTime:bigint,endTime:bigint,stdout:string,stderr:string,returnCode:int>"
    )
    return value, kind


def _java(end: F.Column) -> F.Column:
    return _execution(end - F.expr("INTERVAL 600 SECONDS"), F.lit('java version "1.8.0_05"'), F.lit(0))[0]


def write_archive(
    spark: SparkSession, sf_dir: str, name: str, path: str, files: int | None = None, compressed: bool = False
) -> None:
    """Write records one per line, each with its id; ``files`` deals runs out to as many files.

    Compressed files are as ``write_lines`` names them, others end in ``.json``.
    """
    documents = record_documents(spark, sf_dir, name, files)
    if compressed:
        write_lines(json_lines(documents), path)
    else:
        documents.write.json(path)


def json_lines(documents: DataFrame) -> DataFrame:
    return documents.select(F.to_json(F.struct(*documents.columns)).alias("value"))


def write_lines(lines: DataFrame, path: str) -> None:
    """Add lines to an archive. A record's text is some ten times as long as what is in it, so it is compressed."""
    lines.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", ARCHIVE_RECORDS).text(path)


def damaged_documents(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Test-run records as text; the first digit of the id decides what is wrong with them."""
    digit = F.substring("id", 1, 1)
    server = F.col("serverExecution")
    broken = record_documents(spark, sf_dir, "test_runs", parts).select(
        F.when(digit == "1", F.replace("id", F.lit("-"), F.lit(""))).otherwise(F.col("id")).alias("id"),
        F.when(digit == "4", F.lit("none")).otherwise(F.col("appBuildId")).alias("appBuildId"),
        F.when(digit != "2", F.col("testName")).alias("testName"),
        "javaVersionExecution",
        F.when(digit == "3", server.dropFields("endTime").withField("endTime", F.lit(None).cast("string")))
        .when(digit == "5", server.dropFields("endTime").withField("endTime", F.lit("yesterday")))
        .otherwise(server.dropFields("endTime").withField("endTime", server["endTime"].cast("string")))
        .alias("serverExecution"),
        "wrkExecutions",
    )
    line = F.to_json(F.struct(*broken.columns))
    return broken.select(
        F.when(digit == "0", F.substring(line, 1, 200)).otherwise(line).alias("value")
    )
