"""The queries again, as SQL over the raw test tables.

Each text computes its answer on another path than the Spark query: numbers are read from the source
columns and never from generated text, history is a recursive walk, percentiles and latest rows are
ranked windows.
"""

from __future__ import annotations

from benchledger import fixtures as fx
from benchledger.functions import text
from benchledger.queries import (
    BUDGET_SECONDS,
    CAPTURE_LIMIT,
    LOAD_OVERRIDE_SECONDS,
    REPORT_END,
    REPORT_INSTANCE,
    REPORT_START,
    TOP_TASKS,
    WARM_UP_SECONDS,
)


def _input(sql: str) -> str:
    """A fixture mapping over the registered tables."""
    for name in ("customer", "orders", "lineitem", "events", "part", "commit_log"):
        sql = sql.replace("{" + name + "}", name)
    return f"({sql.strip()})"


BUILDS = f"""
framework_builds AS {_input(fx.FRAMEWORK_BUILDS)},
app_builds AS {_input(fx.APP_BUILDS)},
builds AS (
  SELECT a.app_build_id, a.framework_build_id, a.app_name, a.apps_commit, f.instance_id, f.framework_commit
  FROM app_builds a JOIN framework_builds f ON a.framework_build_id = f.framework_build_id)
"""

RUNS = f"test_runs AS {_input(fx.TEST_RUNS)}"

METRICS = """requests / CAST(duration_us AS DOUBLE) * 1000000 AS requests_per_second,
       latency_mean_us / 1000 AS latency_mean_ms,
       CAST(latency_p95_us AS DOUBLE) / 1000 AS latency_p95_ms"""

VALID = f"""
{RUNS},
{BUILDS},
valid AS (
  SELECT b.instance_id, b.framework_commit, r.test_name, r.test_run_id, r.end_time,
         CAST(r.requests AS DOUBLE) / CAST(r.duration_us AS DOUBLE) * 1000000 AS requests_per_second,
         r.latency_mean_us / 1000 AS latency_mean_ms,
         CAST(r.latency_p95_us AS DOUBLE) / 1000 AS latency_p95_ms
  FROM test_runs r JOIN builds b ON r.app_build_id = b.app_build_id
  WHERE r.output_kind = 'ok' AND r.err_connect = 0 AND r.err_read = 0 AND r.err_write = 0 AND r.err_status = 0),
current_results AS (
  SELECT * EXCLUDE (end_time, place) FROM (
    SELECT *, row_number() OVER (PARTITION BY instance_id, framework_commit, test_name
                                 ORDER BY end_time DESC, test_run_id DESC) AS place FROM valid) AS ranked
  WHERE place = 1)
"""

# Histories: every branch from its head by first parent, one step per level.
HISTORY = f"""
commit_log AS MATERIALIZED {_input(fx.COMMIT_LOG)},
heads AS (
  SELECT branch, commit_id AS head FROM (
    SELECT *, row_number() OVER (PARTITION BY branch ORDER BY n DESC) AS place FROM commit_log) AS ranked
  WHERE place = 1),
chain AS (
  SELECT c.branch, c.commit_id, c.commit_time, c.parent0, CAST(0 AS BIGINT) AS pos
  FROM heads h JOIN commit_log c ON c.branch = h.branch AND c.commit_id = h.head
  UNION ALL
  SELECT c.branch, c.commit_id, c.commit_time, c.parent0, k.pos + 1
  FROM chain k JOIN commit_log c ON c.branch = k.branch AND c.commit_id = k.parent0)
"""

HEADS = HISTORY.split("chain AS")[0].rstrip().rstrip(",")

REPORT_WINDOW = f"""
{HISTORY},
cut AS (
  SELECT branch, min(pos) AS last_pos FROM chain
  WHERE commit_time < TIMESTAMP '{REPORT_START:%Y-%m-%d %H:%M:%S}' GROUP BY branch),
branch_commits AS (
  SELECT c.branch, c.commit_id, c.commit_time, c.pos FROM chain c LEFT JOIN cut USING (branch)
  WHERE cut.last_pos IS NULL OR c.pos <= cut.last_pos)
"""

WINDOW_RESULTS = f"""
{REPORT_WINDOW},
{VALID},
window_results AS (
  SELECT * FROM current_results
  WHERE instance_id = {REPORT_INSTANCE} AND framework_commit IN (SELECT commit_id FROM branch_commits))
"""

RANGES = f"""
{HISTORY},
plan_config AS {_input(fx.PLAN_CONFIG)},
ranges AS (
  SELECT p.*, c.commit_id AS start_id FROM plan_config p
  JOIN commit_log c ON c.branch = p.branch AND c.n = p.start_n),
line_chain AS (
  SELECT r.config_id, c.branch, c.commit_id, c.commit_time, c.parent0, CAST(0 AS BIGINT) AS pos
  FROM ranges r JOIN commit_log c ON c.branch = r.branch AND c.n = r.end_n
  UNION ALL
  SELECT k.config_id, c.branch, c.commit_id, c.commit_time, c.parent0, k.pos + 1
  FROM line_chain k JOIN commit_log c ON c.branch = k.branch AND c.commit_id = k.parent0),
excluded AS (
  SELECT config_id, branch, start_id AS commit_id FROM ranges
  UNION
  SELECT e.config_id, e.branch, p.parent FROM excluded e
  JOIN (SELECT branch, commit_id, parent0 AS parent FROM commit_log WHERE parent0 IS NOT NULL
        UNION ALL SELECT branch, commit_id, parent1 FROM commit_log WHERE parent1 IS NOT NULL) AS p
    ON p.branch = e.branch AND p.commit_id = e.commit_id),
range_log AS (
  SELECT c.config_id, c.branch, c.commit_id, c.commit_time, c.pos FROM line_chain c
  WHERE NOT EXISTS (SELECT 1 FROM excluded e WHERE e.config_id = c.config_id AND e.commit_id = c.commit_id)),
planned AS (
  SELECT l.* FROM range_log l JOIN ranges r ON r.config_id = l.config_id
  JOIN (SELECT config_id, max(pos) AS oldest FROM range_log GROUP BY config_id) AS o ON o.config_id = l.config_id
  WHERE l.pos = o.oldest
     OR CAST(('0x' || substr(l.commit_id, 1, 7)) AS BIGINT) <= CAST(floor(268435455 * r.sampling + 0.5) AS BIGINT))
"""

TASKS = f"""
{RANGES},
tests AS {_input(fx.TESTS)},
apps_refs AS {_input(fx.APPS_REFS)},
apps_log AS {_input(fx.APPS_LOG)},
needed AS (
  SELECT DISTINCT r.instance_id, t.test_name, p.commit_id AS framework_commit, t.app_name, p.commit_time,
         p.branch, r.apps_branch, CASE WHEN r.apps_revision = 'HEAD' THEN a.head ELSE l.commit_id END AS apps_commit
  FROM planned p JOIN ranges r ON r.config_id = p.config_id
  JOIN tests t ON list_contains(string_split(r.test_list, ','), t.test_name)
  JOIN apps_refs a ON a.branch = r.apps_branch
  LEFT JOIN apps_log l ON l.branch = r.apps_branch AND r.apps_revision = substr(l.commit_id, 1, length(r.apps_revision)))
"""

TO_RUN = f"""
{TASKS},
{RUNS},
{BUILDS},
completed AS (
  SELECT r.test_name, b.framework_commit, b.app_name FROM test_runs r JOIN builds b ON r.app_build_id = b.app_build_id),
to_run AS (
  SELECT n.* FROM needed n WHERE NOT EXISTS (
    SELECT 1 FROM completed c WHERE c.test_name = n.test_name AND c.framework_commit = n.framework_commit
                               AND c.app_name = n.app_name)),
last_framework AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY build_seq DESC) AS place
                 FROM framework_builds) AS ranked WHERE place = 1),
marked AS (
  SELECT t.*, coalesce(t.framework_commit = f.framework_commit, false) AS is_current
  FROM to_run t LEFT JOIN last_framework f ON f.instance_id = t.instance_id)
"""

_TIES = "apps_commit, framework_commit, test_name, app_name, branch, apps_branch"
BY_DATE = f"is_current DESC, commit_time DESC, {_TIES}"
BY_ID = f"is_current DESC, framework_commit, {_TIES}"

DECISIONS = f"""
{TASKS},
{BUILDS},
last_framework AS (
  SELECT *, coalesce(return_code = 0, false) AS ok FROM (
    SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY build_seq DESC) AS place
    FROM framework_builds) AS ranked WHERE place = 1),
last_app AS (
  SELECT *, coalesce(return_code = 0, false) AS ok FROM (
    SELECT a.*, f.instance_id, row_number() OVER (PARTITION BY f.instance_id, a.app_name
                                                  ORDER BY a.end_time DESC, a.app_build_id DESC) AS place
    FROM app_builds a JOIN framework_builds f ON f.framework_build_id = a.framework_build_id) AS ranked
  WHERE place = 1),
framework_step AS (
  SELECT n.*, f.framework_build_id AS last_framework_build, f.ok AS last_framework_ok,
         CASE WHEN f.framework_build_id IS NULL THEN 'no current build'
              WHEN f.framework_commit <> n.framework_commit THEN 'commit changed'
              WHEN NOT f.artefact_present THEN 'repository missing' END AS framework_reason
  FROM needed n LEFT JOIN last_framework f ON f.instance_id = n.instance_id),
decisions AS (
  SELECT s.* EXCLUDE (last_framework_build, last_framework_ok, framework_reason),
         CASE WHEN s.framework_reason IS NULL THEN 'reuse' ELSE 'build' END AS framework_action,
         s.framework_reason,
         CASE WHEN a.app_build_id IS NULL OR s.framework_reason IS NOT NULL
                   OR a.framework_build_id <> s.last_framework_build
                   OR a.apps_commit <> s.apps_commit OR NOT a.artefact_present THEN 'build' ELSE 'reuse' END AS app_action,
         CASE WHEN a.app_build_id IS NULL THEN 'no current build'
              WHEN s.framework_reason IS NOT NULL OR a.framework_build_id <> s.last_framework_build
                THEN 'framework build changed'
              WHEN a.apps_commit <> s.apps_commit THEN 'apps commit changed'
              WHEN NOT a.artefact_present THEN 'binary missing' END AS app_reason,
         s.last_framework_ok, a.ok AS last_app_ok
  FROM framework_step s LEFT JOIN last_app a ON a.instance_id = s.instance_id AND a.app_name = s.app_name)
"""

TALLIES = """
framework_tallies AS (
  SELECT framework_commit, count(*) FILTER (WHERE return_code = 0) AS successes,
         count(*) FILTER (WHERE return_code IS NULL OR return_code <> 0) AS failures
  FROM framework_builds GROUP BY framework_commit),
app_tallies AS (
  SELECT a.apps_commit, f.framework_commit, count(*) FILTER (WHERE a.return_code = 0) AS successes,
         count(*) FILTER (WHERE a.return_code <> 0) AS failures
  FROM app_builds a JOIN framework_builds f ON f.framework_build_id = a.framework_build_id
  GROUP BY a.apps_commit, f.framework_commit)
"""

RAW_MATRIX = f"""
raw_matrix AS {_input(fx.RAW_MATRIX)},
tests AS {_input(fx.TESTS)},
named AS (SELECT m.*, unnest(string_split(m.test_list, ',')) AS test_name FROM raw_matrix m)
"""

SAMPLES = f"samples AS {_input(fx.SAMPLES)}"

# Characters outside ASCII by their size in bytes; three bytes first, as the replacement has three.
_ASCII_TEXT = (
    "regexp_replace(regexp_replace(regexp_replace(text, '[\\x{0800}-\\x{FFFF}]', repeat(chr(65533), 3), 'g'), "
    "'[\\x{10000}-\\x{10FFFF}]', repeat(chr(65533), 4), 'g'), '[\\x{0080}-\\x{07FF}]', repeat(chr(65533), 2), 'g')"
)


def _uuid(hex32: str) -> str:
    parts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({hex32}, {start}, {length})" for start, length in parts)


# The JSON of a run as the load generator wrote it, without its last brace.
_CAPTURED = """' {"summary":{"duration":' || l.duration_us || ',"requests":' || l.requests || ',"bytes":' || l.bytes
         || ',"errors":{"connect":' || l.err_connect || ',"read":' || l.err_read || ',"write":' || l.err_write
         || ',"status":' || l.err_status || ',"timeout":' || l.err_timeout || '}},"latency":{"min":90,"mean":'
         || l.latency_mean_us || ',"max":1.23457e+06,"stdev":300.1,"percentile":[[1,100],[50,' || l.latency_p95_us || '],'
         || CASE WHEN l.repeated_p95 THEN '[95,' || (l.latency_p95_us - 1) || '],' ELSE '' END || '[95,' || l.latency_p95_us
         || '],[99,4000]]},"requests":{"min":1,"mean":2.5,"max":9,"stdev":1.5,"percentile":[[50,2],[95,8]]}'"""

SAID = f"""{TASKS},
{RUNS},
{BUILDS},
last_run AS (
  SELECT * FROM (
    SELECT r.*, b.instance_id, b.framework_commit,
           row_number() OVER (PARTITION BY b.instance_id, b.framework_commit, r.test_name
                              ORDER BY r.end_time DESC, r.test_run_id DESC) AS place
    FROM test_runs r JOIN builds b ON r.app_build_id = b.app_build_id) AS ranked WHERE place = 1),
said AS (
  SELECT p.config_id, r.instance_id, p.branch, p.commit_id AS framework_commit, p.pos, t.test_name,
         CASE WHEN l.test_run_id IS NULL THEN 'no_result' WHEN l.output_kind = 'no_stdout' THEN 'no_stdout'
              WHEN l.output_kind = 'no_marker' THEN 'missing_json' WHEN l.output_kind = 'bad_json' THEN 'parse_failed'
              WHEN l.err_connect + l.err_read + l.err_write + l.err_status > 0 THEN 'errors' ELSE 'ok' END AS outcome,
         l.err_connect, l.err_read, l.err_write, l.err_status, l.requests, l.duration_us, l.latency_mean_us, l.latency_p95_us,
         {_CAPTURED} AS captured
  FROM planned p JOIN ranges r ON r.config_id = p.config_id
  JOIN tests t ON list_contains(string_split(r.test_list, ','), t.test_name)
  LEFT JOIN last_run l ON l.instance_id = r.instance_id AND l.framework_commit = p.commit_id AND l.test_name = t.test_name)
"""

# What is wrong with a run record, by the first digit of its id.
DAMAGED = f"""(
SELECT CASE WHEN substr(test_run_id, 1, 1) = '1' THEN test_run_id ELSE {_uuid("test_run_id")} END AS record_id,
       CASE substr(test_run_id, 1, 1) WHEN '0' THEN 'malformed' WHEN '1' THEN 'bad id' WHEN '2' THEN 'missing testName'
            WHEN '3' THEN 'incomplete serverExecution' WHEN '4' THEN 'bad appBuildId'
            ELSE 'bad time in serverExecution' END AS reason
FROM test_runs WHERE substr(test_run_id, 1, 1) IN ('0', '1', '2', '3', '4', '5')) AS damaged"""

# The log with long side branches: chains from the heads, and all that each start reaches.
SIDE = f"""
side_log AS MATERIALIZED {_input(fx.SIDE_LOG)},
side_heads AS (SELECT * FROM side_log WHERE n = top - CASE WHEN top % 5 = 3 THEN 1 ELSE 0 END),
side_chain AS (
  SELECT branch, commit_id, parent0, CAST(0 AS BIGINT) AS pos FROM side_heads
  UNION ALL
  SELECT c.branch, c.commit_id, c.parent0, k.pos + 1
  FROM side_chain k JOIN side_log c ON c.branch = k.branch AND c.commit_id = k.parent0),
starts AS (
  SELECT h.branch, s.place, s.n FROM side_heads h, LATERAL (VALUES
    (0, h.top - (h.top + 2) % 5), (1, h.top // 2 - (h.top // 2 + 2) % 5), (2, h.n),
    (3, h.top // 2 - (h.top // 2 + 2) % 5 + 2), (4, 1)) AS s(place, n)),
side_reached AS (
  SELECT s.branch, s.place, c.commit_id FROM starts s JOIN side_log c ON c.branch = s.branch AND c.n = s.n
  UNION
  SELECT r.branch, r.place, p.parent FROM side_reached r
  JOIN (SELECT branch, commit_id, parent0 AS parent FROM side_log WHERE parent0 IS NOT NULL
        UNION ALL SELECT branch, commit_id, parent1 FROM side_log WHERE parent1 IS NOT NULL) AS p
    ON p.branch = r.branch AND p.commit_id = r.commit_id)
"""

ORACLE: dict[str, str] = {
    "range_reachability": f"""WITH RECURSIVE {SIDE}
SELECT r.branch || '-' || r.place AS range_id, min(c.pos) AS cut
FROM side_reached r JOIN side_chain c ON c.branch = r.branch AND c.commit_id = r.commit_id GROUP BY 1""",
    "report_results": f"WITH {VALID} SELECT * FROM current_results",
    "report_window_results": f"WITH RECURSIVE {WINDOW_RESULTS} SELECT * FROM window_results",
    "runs_joined": f"""WITH {RUNS}, {BUILDS}
SELECT b.*, r.test_run_id, r.test_name FROM test_runs r JOIN builds b ON r.app_build_id = b.app_build_id""",
    "dangling_runs": f"""WITH {RUNS}, {BUILDS}
SELECT test_run_id, app_build_id, 'no app build' AS reason FROM test_runs r
WHERE NOT EXISTS (SELECT 1 FROM app_builds a WHERE a.app_build_id = r.app_build_id)
UNION ALL
SELECT r.test_run_id, r.app_build_id, 'no framework build' FROM test_runs r
JOIN app_builds a ON a.app_build_id = r.app_build_id
WHERE NOT EXISTS (SELECT 1 FROM framework_builds f WHERE f.framework_build_id = a.framework_build_id)""",
    "parse_outputs": f"""WITH {RUNS}
SELECT test_run_id,
       CASE output_kind WHEN 'no_stdout' THEN 'no_stdout' WHEN 'no_marker' THEN 'missing_json'
            WHEN 'bad_json' THEN 'parse_failed' ELSE 'parsed' END AS parse_status,
       CASE WHEN output_kind = 'ok' THEN duration_us END AS duration_us,
       CASE WHEN output_kind = 'ok' THEN requests END AS requests,
       CASE WHEN output_kind = 'ok' THEN bytes END AS bytes,
       CASE WHEN output_kind = 'ok' THEN err_connect END AS err_connect,
       CASE WHEN output_kind = 'ok' THEN err_read END AS err_read,
       CASE WHEN output_kind = 'ok' THEN err_write END AS err_write,
       CASE WHEN output_kind = 'ok' THEN err_status END AS err_status,
       CASE WHEN output_kind = 'ok' THEN err_timeout END AS err_timeout,
       CASE WHEN output_kind = 'ok' THEN latency_mean_us END AS latency_mean_us,
       CASE WHEN output_kind = 'ok' THEN 1234570.0::DOUBLE END AS latency_max_us,
       CASE WHEN output_kind = 'ok' THEN latency_p95_us END AS latency_p95_us
FROM test_runs""",
    "parse_status_counts": f"""WITH {RUNS}
SELECT CASE output_kind WHEN 'no_stdout' THEN 'no_stdout' WHEN 'no_marker' THEN 'missing_json'
            WHEN 'bad_json' THEN 'parse_failed' ELSE 'parsed' END AS parse_status, count(*) AS runs
FROM test_runs GROUP BY 1""",
    "percentile_lookup": f"""WITH {RUNS}
SELECT test_run_id, 100::BIGINT AS p1, latency_p95_us AS p50, latency_p95_us AS p95, 4000::BIGINT AS p99,
       CAST(NULL AS BIGINT) AS p42 FROM test_runs WHERE output_kind = 'ok'""",
    "measured_execution": f"""WITH {RUNS}
SELECT test_run_id, CASE WHEN never_measured THEN 'never measured' ELSE 'measured' END AS state,
       CASE WHEN NOT never_measured THEN end_time END AS measured_end,
       CASE WHEN NOT never_measured AND output_kind <> 'no_stdout' THEN false END AS is_warm_up FROM test_runs""",
    "error_gate": f"""WITH {RUNS}
SELECT test_run_id FROM test_runs
WHERE output_kind = 'ok' AND err_connect + err_read + err_write + err_status = 0""",
    "error_messages": f"""WITH {RUNS}
SELECT test_run_id, concat_ws(', ',
         CASE WHEN err_connect <> 0 THEN 'Connect errors: ' || err_connect END,
         CASE WHEN err_read <> 0 THEN 'Read errors: ' || err_read END,
         CASE WHEN err_write <> 0 THEN 'Write errors: ' || err_write END,
         CASE WHEN err_status <> 0 THEN 'Status errors: ' || err_status END) AS message
FROM test_runs WHERE output_kind = 'ok'""",
    "derived_metrics": f"""WITH {RUNS}
SELECT test_run_id, {METRICS.replace("requests /", "CAST(requests AS DOUBLE) /")}
FROM test_runs WHERE output_kind = 'ok'""",
    "overwritten_results": f"""WITH {VALID}
SELECT instance_id, framework_commit, test_name, count(*) AS runs FROM valid
GROUP BY instance_id, framework_commit, test_name HAVING count(*) > 1""",
    "execution_durations": f"""WITH {RUNS}
SELECT test_run_id, CASE WHEN NOT never_measured THEN duration_us END AS elapsed_us,
       CASE WHEN NOT never_measured THEN duration_us // 60000000 END AS elapsed_minutes FROM test_runs""",
    "build_success": f"""WITH {BUILDS}
SELECT 'framework' AS kind, framework_build_id AS build_id,
       build_seq % 29 = 0 OR coalesce(return_code = 0, false) AS successful FROM framework_builds
UNION ALL
SELECT 'app', app_build_id, dayofyear(end_time) % 29 = 0 OR coalesce(return_code = 0, false) FROM app_builds""",
    "build_tallies": f"WITH {BUILDS}, {TALLIES} SELECT * FROM framework_tallies",
    "app_build_tallies": f"WITH {BUILDS}, {TALLIES} SELECT * FROM app_tallies",
    "failure_budget": f"""WITH {BUILDS}, {TALLIES}
SELECT 'framework' AS kind, framework_commit, CAST(NULL AS VARCHAR) AS apps_commit, successes, failures
FROM framework_tallies WHERE failures - successes >= 2
UNION ALL
SELECT 'app', framework_commit, apps_commit, successes, failures FROM app_tallies WHERE failures - successes >= 2""",
    "latest_builds": f"""WITH RECURSIVE {DECISIONS}
SELECT 'framework' AS kind, instance_id, CAST(NULL AS VARCHAR) AS app_name, framework_build_id AS build_id,
       framework_commit AS built_commit, ok AS successful FROM last_framework
UNION ALL
SELECT 'app', instance_id, app_name, app_build_id, apps_commit, ok FROM last_app""",
    "commit_log_source": f"""WITH {HEADS}
SELECT branch, commit_id, CAST(epoch(commit_time) AS BIGINT) AS seconds,
       CASE WHEN parent0 IS NULL THEN 0 ELSE 1 END + CASE WHEN parent1 IS NULL THEN 0 ELSE 1 END AS parents FROM commit_log""",
    "first_parent_log": f"WITH RECURSIVE {HISTORY} SELECT branch, commit_id, commit_time, pos FROM chain",
    "first_parent_range": f"WITH RECURSIVE {RANGES} SELECT * FROM range_log",
    "log_to_date": f"WITH RECURSIVE {REPORT_WINDOW} SELECT * FROM branch_commits",
    "commit_sample": f"WITH RECURSIVE {RANGES} SELECT * FROM planned",
    "commit_sample_monotone": """WITH ids AS (SELECT CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 7)) AS BIGINT) AS prefix FROM orders)
SELECT rate, count(*) FILTER (WHERE prefix <= CAST(floor(268435455 * rate + 0.5) AS BIGINT)) AS commits,
       CAST(0 AS BIGINT) AS lost
FROM ids, (VALUES (0.0::DOUBLE), (0.1::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (1.0::DOUBLE)) AS r(rate)
GROUP BY rate""",
    "resolve_revisions": f"""WITH {HEADS},
names AS (
  SELECT branch, commit_id, unnest([commit_id, substr(commit_id, 1, 2), substr(commit_id, 1, 4), substr(commit_id, 1, 5),
    substr(commit_id, 1, 6), substr(commit_id, 1, 7), substr(commit_id, 1, 12)]) AS revision FROM commit_log),
wanted AS (
  SELECT branch, revision FROM names UNION SELECT branch, 'HEAD' FROM commit_log
  UNION SELECT branch, '-' || substr(commit_id, 1, 7) FROM commit_log),
matches AS (SELECT branch, revision, commit_id FROM names UNION ALL SELECT branch, 'HEAD', head FROM heads)
SELECT w.branch, w.revision, CASE WHEN count(m.commit_id) = 1 THEN max(m.commit_id) END AS resolved_id,
       CASE count(m.commit_id) WHEN 0 THEN 'unknown' WHEN 1 THEN 'resolved' ELSE 'ambiguous' END AS resolution
FROM wanted w LEFT JOIN matches m ON m.branch = w.branch AND m.revision = w.revision
GROUP BY w.branch, w.revision""",
    "unresolved_lines": f"""WITH {HEADS},
apps_refs AS {_input(fx.APPS_REFS)},
apps_log AS {_input(fx.APPS_LOG)},
vague AS {_input(fx.VAGUE_MATRIX)},
asked AS (
  SELECT config_id, branch, 'start' AS role, string_split(revision_range, '..')[1] AS revision FROM vague
  UNION ALL SELECT config_id, branch, 'end', string_split(revision_range, '..')[2] FROM vague
  UNION ALL SELECT config_id, apps_branch, 'apps', apps_revision FROM vague),
known AS (
  SELECT 'framework' AS side, branch, commit_id FROM commit_log UNION ALL SELECT 'apps', branch, commit_id FROM apps_log),
named AS (SELECT side, branch, substr(commit_id, 1, size) AS revision, count(*) AS commits
          FROM known, (SELECT DISTINCT length(revision) AS size FROM asked) AS sizes GROUP BY 1, 2, 3),
tops AS (SELECT 'framework' AS side, branch FROM heads UNION ALL SELECT 'apps', branch FROM apps_refs),
answered AS (
  SELECT a.*, CASE WHEN a.revision = 'HEAD' THEN CASE WHEN t.branch IS NULL THEN 0 ELSE 1 END
                   ELSE coalesce(n.commits, 0) END AS commits
  FROM (SELECT *, CASE role WHEN 'apps' THEN 'apps' ELSE 'framework' END AS side FROM asked) AS a
  LEFT JOIN tops t ON t.side = a.side AND t.branch = a.branch
  LEFT JOIN named n ON n.side = a.side AND n.branch = a.branch AND n.revision = a.revision)
SELECT config_id, branch, role, revision, CASE commits WHEN 0 THEN 'unknown' ELSE 'ambiguous' END AS resolution
FROM answered WHERE commits <> 1""",
    "reported_commits": f"WITH RECURSIVE {REPORT_WINDOW} SELECT DISTINCT commit_id FROM branch_commits",
    "branch_series": f"""WITH RECURSIVE {WINDOW_RESULTS}
SELECT b.branch, b.commit_id AS framework_commit, b.commit_time, b.pos, w.test_name, w.test_run_id,
       w.requests_per_second, w.latency_mean_ms, w.latency_p95_ms
FROM branch_commits b JOIN window_results w ON w.framework_commit = b.commit_id""",
    "missing_branches": f"""WITH raw_matrix AS {_input(fx.RAW_MATRIX)}
SELECT branch FROM raw_matrix
EXCEPT ALL SELECT 'Brand#' || (s_suppkey % 25 + 1) FROM supplier""",
    "matrix_explode": f"""WITH {RAW_MATRIX}
SELECT n.config_id, n.branch, n.sampling, n.apps_branch, n.apps_revision,
       string_split(n.revision_range, '..')[1] AS start_revision,
       string_split(n.revision_range, '..')[2] AS end_revision, n.test_name, t.app_name
FROM named n JOIN tests t ON t.test_name = n.test_name
WHERE n.sampling BETWEEN 0 AND 1 AND n.config_id % 7 NOT IN (4, 5, 6)""",
    "matrix_checks": f"""WITH {RAW_MATRIX}
SELECT 'sampling out of range' AS check_name, CAST(config_id AS VARCHAR) AS subject, CAST(1 AS BIGINT) AS occurrences
FROM raw_matrix WHERE sampling < 0 OR sampling > 1
UNION ALL SELECT 'range without two parts', CAST(config_id AS VARCHAR), 1 FROM raw_matrix WHERE config_id % 7 IN (4, 5, 6)
UNION ALL SELECT 'unknown test', test_name, count(*) FROM named
  WHERE test_name NOT IN (SELECT test_name FROM tests) GROUP BY test_name
UNION ALL SELECT 'unscheduled test', test_name, 1 FROM tests WHERE test_name NOT IN (SELECT test_name FROM named)
UNION ALL SELECT 'report branch not in matrix', 'Brand#' || (n_nationkey + 3), 1 FROM nation
  WHERE 'Brand#' || (n_nationkey + 3) NOT IN (SELECT branch FROM raw_matrix)""",
    "matrix_branches": f"""WITH {RAW_MATRIX}
SELECT 'framework' AS role, branch FROM raw_matrix UNION SELECT 'apps', apps_branch FROM raw_matrix""",
    "filter_matrix": f"""WITH {RAW_MATRIX}
SELECT config_id, branch, test_name FROM named
WHERE branch IN ('Brand#2', 'Brand#3', 'Brand#5') AND test_name IN ('A-F', 'N-F')""",
    "needed_tasks": f"WITH RECURSIVE {TASKS} SELECT * FROM needed",
    "tasks_to_run": f"WITH RECURSIVE {TO_RUN} SELECT * FROM to_run",
    "coverage_counts": f"""WITH RECURSIVE {TO_RUN}
SELECT 'completed' AS task_set, count(DISTINCT framework_commit) AS commits, count(*) AS tasks FROM completed
UNION ALL SELECT 'needed', count(DISTINCT framework_commit), count(*) FROM needed
UNION ALL SELECT 'to_run', count(DISTINCT framework_commit), count(*) FROM to_run""",
    "plan_order_date": f"""WITH RECURSIVE {TO_RUN}
SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY {BY_DATE}) AS seq FROM marked""",
    "plan_order_lexical": f"""WITH RECURSIVE {TO_RUN}
SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY {BY_ID}) AS seq FROM marked""",
    "plan_top_n": f"WITH RECURSIVE {TO_RUN} SELECT * FROM marked ORDER BY {BY_DATE}, instance_id LIMIT {TOP_TASKS}",
    "budgeted_plan": f"""WITH RECURSIVE {TO_RUN},
priced AS (
  SELECT *, CAST(least(30, {LOAD_OVERRIDE_SECONDS}) + least(120, {LOAD_OVERRIDE_SECONDS}) AS BIGINT) AS cost_seconds FROM marked),
placed AS (
  SELECT *, row_number() OVER w AS seq,
         CAST(coalesce(sum(cost_seconds) OVER (PARTITION BY instance_id ORDER BY {BY_DATE}
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS starts_after_seconds
  FROM priced WINDOW w AS (PARTITION BY instance_id ORDER BY {BY_DATE}))
SELECT * FROM placed WHERE starts_after_seconds <= {BUDGET_SECONDS}""",
    "rebuild_points": f"""WITH RECURSIVE {TO_RUN},
placed AS (SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY {BY_DATE}) AS seq FROM marked),
stepped AS (
  SELECT *, coalesce(framework_commit <> lag(framework_commit) OVER (PARTITION BY instance_id ORDER BY seq), true)
            AS framework_rebuild FROM placed),
counted AS (
  SELECT *, CAST(sum(CAST(framework_rebuild AS BIGINT)) OVER (PARTITION BY instance_id ORDER BY seq) AS BIGINT)
            AS framework_build FROM stepped)
SELECT instance_id, seq, framework_commit, app_name, apps_commit, framework_build, framework_rebuild,
       coalesce(framework_build <> lag(framework_build) OVER w OR apps_commit <> lag(apps_commit) OVER w, true) AS app_rebuild
FROM counted WINDOW w AS (PARTITION BY instance_id, app_name ORDER BY seq)""",
    "rebuild_decision": f"WITH RECURSIVE {DECISIONS} SELECT * FROM decisions",
    "skip_reasons": f"""WITH RECURSIVE {DECISIONS}, {TALLIES}
SELECT d.instance_id, d.test_name, d.framework_commit, d.app_name, d.apps_branch, d.apps_commit,
       CASE WHEN d.framework_action = 'build' AND f.failures - f.successes >= 2 THEN 'too many framework build failures'
            WHEN d.framework_action = 'reuse' AND NOT d.last_framework_ok THEN 'framework build failed'
            WHEN d.app_action = 'build' AND a.failures - a.successes >= 2 THEN 'too many app build failures'
            WHEN d.app_action = 'reuse' AND NOT d.last_app_ok THEN 'app build failed' END AS skip_reason
FROM decisions d LEFT JOIN framework_tallies f ON f.framework_commit = d.framework_commit
LEFT JOIN app_tallies a ON a.framework_commit = d.framework_commit AND a.apps_commit = d.apps_commit""",
    "render_commands": f"""WITH RECURSIVE {TASKS}
SELECT n.instance_id, n.test_name, n.framework_commit, n.app_name, n.apps_branch, n.apps_commit, 'wrk' AS program,
       '-t16 -c32 -d{LOAD_OVERRIDE_SECONDS}s -s/srv/assets/report.lua http://localhost:9000' || substr(t.url, 13) AS args,
       '/srv/apps' AS working_dir, CAST({(LOAD_OVERRIDE_SECONDS + 10) * 1000} AS BIGINT) AS timeout_ms
FROM needed n JOIN tests t ON t.test_name = n.test_name""",
    "effective_duration": """SELECT p_partkey,
       CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 400 < p_size * 10 THEN p_partkey % 400
            ELSE CAST(p_size * 10 AS BIGINT) END AS seconds FROM part""",
    "report_lines": f"""WITH RECURSIVE {SAID}
SELECT config_id, instance_id, branch, framework_commit, pos, test_name, outcome,
       CASE WHEN outcome = 'ok' THEN CAST(requests AS DOUBLE) / CAST(duration_us AS DOUBLE) * 1000000 END AS requests_per_second,
       CASE WHEN outcome = 'ok' THEN latency_mean_us / 1000 END AS latency_mean_ms,
       CASE WHEN outcome = 'ok' THEN CAST(latency_p95_us AS DOUBLE) / 1000 END AS latency_p95_ms
FROM said""",
    "report_text_values": f"""WITH RECURSIVE {SAID},
sizes AS (SELECT config_id, count(*) AS commits FROM planned GROUP BY config_id)
SELECT config_id, test_name, pos, substr(framework_commit, 1, 7) AS short_id,
       CASE outcome WHEN 'ok' THEN 'Requests/s: #, Mean latency: #, Latency 95%: #' WHEN 'no_result' THEN '<no result for commit>'
            WHEN 'no_stdout' THEN '<no wrk stdout for test run>' WHEN 'missing_json' THEN 'Missing JSON in result'
            WHEN 'parse_failed' THEN 'Failed to parse wrk result: ' || captured
            ELSE concat_ws(', ', CASE WHEN err_connect <> 0 THEN 'Connect errors: ' || err_connect END,
                           CASE WHEN err_read <> 0 THEN 'Read errors: ' || err_read END,
                           CASE WHEN err_write <> 0 THEN 'Write errors: ' || err_write END,
                           CASE WHEN err_status <> 0 THEN 'Status errors: ' || err_status END) END AS said,
       CASE WHEN outcome = 'ok' THEN CAST(requests AS DOUBLE) / CAST(duration_us AS DOUBLE) * 1000000 END AS requests_per_second,
       CASE WHEN outcome = 'ok' THEN latency_mean_us / 1000 END AS latency_mean_ms,
       CASE WHEN outcome = 'ok' THEN CAST(latency_p95_us AS DOUBLE) / 1000 END AS latency_p95_ms
FROM said
UNION ALL
SELECT r.config_id, t.test_name, -1, NULL,
       '=== Test ' || t.test_name || ' on ' || r.branch || ' - ' || coalesce(z.commits, 0) || ' commits ===', NULL, NULL, NULL
FROM ranges r JOIN tests t ON list_contains(string_split(r.test_list, ','), t.test_name)
LEFT JOIN sizes z ON z.config_id = r.config_id""",
    "report_js_values": f"""WITH RECURSIVE {WINDOW_RESULTS},
tests AS {_input(fx.TESTS)},
spans AS (SELECT branch, max(pos) AS last_pos FROM branch_commits GROUP BY branch),
per_commit AS (SELECT framework_commit, count(*) AS n FROM window_results GROUP BY framework_commit)
SELECT 0 AS section, '' AS name, 0::BIGINT AS ordinal, false AS comma,
       'var report = {{"start":' || epoch_ms(TIMESTAMP '{REPORT_START:%Y-%m-%d %H:%M:%S}') || ',"end":'
       || epoch_ms(TIMESTAMP '{REPORT_END:%Y-%m-%d %H:%M:%S}') || ',"branches":{{' AS value
UNION ALL SELECT 1, branch, -1, branch <> (SELECT min(branch) FROM spans), '"' || branch || '":[' FROM spans
UNION ALL SELECT 1, branch, pos, pos > 0, commit_id || '@' || epoch_ms(commit_time) FROM branch_commits
UNION ALL SELECT 1, branch, last_pos + 1, false, ']' FROM spans
UNION ALL SELECT 2, '', 0, false, '}},"tests":{{'
UNION ALL SELECT 3, test_name, 0, test_name <> (SELECT min(test_name) FROM tests), description FROM tests
UNION ALL SELECT 4, '', 0, false, '}},"results":{{'
UNION ALL SELECT 5, framework_commit, 0, framework_commit <> (SELECT min(framework_commit) FROM per_commit), CAST(n AS VARCHAR) FROM per_commit
UNION ALL SELECT 6, '', 0, false, '}}}};'""",
    "report_json_values": f"""WITH RECURSIVE {WINDOW_RESULTS}
SELECT framework_commit, count(*) OVER (PARTITION BY framework_commit) AS tests, test_name, test_run_id,
       requests_per_second, latency_mean_ms, latency_p95_ms FROM window_results""",
    "sample_totals": f"""WITH {SAMPLES}
SELECT run_key, epoch_us(max(ts)) - epoch_us(min(ts)) AS duration_us, count(*) AS requests,
       CAST(sum(latency_us) AS BIGINT) AS latency_sum_us,
       CAST(0 AS BIGINT) AS connect_errors, CAST(0 AS BIGINT) AS read_errors, CAST(0 AS BIGINT) AS write_errors,
       count(*) FILTER (WHERE outcome = 'error') AS status_errors, CAST(0 AS BIGINT) AS timeout_errors
FROM samples GROUP BY run_key""",
    "sample_stats": f"""WITH {SAMPLES},
sums AS (
  SELECT run_key, count(*) AS n, min(latency_us) AS min_us, max(latency_us) AS max_us,
         CAST(sum(latency_us) AS HUGEINT) AS total FROM samples GROUP BY run_key),
spreads AS (
  SELECT s.run_key, CAST(sum(s.latency_us - t.total // t.n) AS DOUBLE) AS off,
         CAST(sum((s.latency_us - t.total // t.n) * (s.latency_us - t.total // t.n)) AS DOUBLE) AS squares
  FROM samples s JOIN sums t ON t.run_key = s.run_key GROUP BY s.run_key)
SELECT t.run_key, n, min_us, CAST(total AS DOUBLE) / CAST(n AS DOUBLE) AS mean_us, max_us,
       CASE WHEN n > 1 THEN sqrt(greatest((squares - off * off / CAST(n AS DOUBLE)) / (CAST(n AS DOUBLE) - 1), 0.0::DOUBLE)) END
         AS stdev_us
FROM sums t JOIN spreads p ON p.run_key = t.run_key""",
    "sample_percentiles": f"""WITH {SAMPLES},
ranked AS (
  SELECT run_key, latency_us, row_number() OVER (PARTITION BY run_key ORDER BY latency_us) AS place,
         count(*) OVER (PARTITION BY run_key) AS n FROM samples),
levels AS (SELECT unnest([1, 5, 10, 25, 50, 75, 90, 95, 99]) AS percentile)
SELECT run_key, percentile, latency_us FROM ranked JOIN levels ON place = (percentile * n + 99) // 100""",
    "sample_percentiles_approx": f"""WITH {SAMPLES}
SELECT run_key, percentile, true AS within_error
FROM (SELECT DISTINCT run_key FROM samples) AS runs, (SELECT unnest([1, 5, 10, 25, 50, 75, 90, 95, 99]) AS percentile) AS levels""",
    "warmup_excluded": f"""WITH {SAMPLES}
SELECT s.* FROM samples s JOIN (SELECT run_key, min(ts) AS first_ts FROM samples GROUP BY run_key) AS f
  ON f.run_key = s.run_key WHERE s.ts >= f.first_ts + INTERVAL {WARM_UP_SECONDS} SECONDS""",
    "version_extract": """SELECT p_partkey,
       CASE p_partkey % 4 WHEN 1 THEN p_size || '.0" // "later' WHEN 3 THEN NULL ELSE p_size || '.0' END AS version
FROM part""",
    "cap_output": f"""WITH plain AS (SELECT doc_id, {_ASCII_TEXT} AS ascii_text FROM documents)
SELECT doc_id, CASE WHEN length(ascii_text) > {CAPTURE_LIMIT}
  THEN substr(ascii_text, 1, {CAPTURE_LIMIT}) || chr(10) || '--- Truncated output to {CAPTURE_LIMIT} bytes ---'
  ELSE ascii_text END AS captured FROM plain""",
    "ingest_records": f"""WITH {RUNS}, {BUILDS}
SELECT 'framework' AS kind, {_uuid("framework_build_id")} AS record_id,
       {_uuid("md5('instance' || instance_id)")} AS parent_id, framework_commit AS label,
       build_seq % 29 = 0 OR coalesce(return_code = 0, false) AS successful,
       CAST((1400000000 + build_seq * 60 - CASE WHEN build_seq % 29 = 0 THEN 600 ELSE 0 END) * 1000000 AS BIGINT) AS end_us
FROM framework_builds
UNION ALL
SELECT 'app', {_uuid("app_build_id")}, {_uuid("framework_build_id")}, app_name, return_code = 0, epoch_us(end_time) FROM app_builds
UNION ALL
SELECT 'run', {_uuid("test_run_id")}, {_uuid("app_build_id")}, test_name, NULL, epoch_us(end_time) FROM test_runs
WHERE substr(test_run_id, 1, 1) NOT IN ('0', '1', '2', '3', '4', '5')
UNION ALL SELECT 'quarantined', record_id, NULL, reason, NULL, NULL FROM {DAMAGED}""",
    "ingest_quarantine": f"WITH {RUNS} SELECT record_id, reason FROM {DAMAGED}",
    "repeated_ids": f"""WITH {RUNS}, {BUILDS}
SELECT {_uuid("app_build_id")} AS id, 2 * count(*) AS copies FROM app_builds WHERE substr(app_build_id, 1, 1) = 'a'
GROUP BY app_build_id
UNION ALL SELECT test_run_id, count(*) FROM test_runs GROUP BY test_run_id HAVING count(*) > 1""",
    "ledger_upsert": f"""WITH {BUILDS}
SELECT app_build_id, app_name, CASE WHEN dayofyear(end_time) % 7 = 0 THEN 9 ELSE return_code END AS return_code,
       end_time FROM app_builds""",
    "stream_ingest": f"""WITH {RUNS}
SELECT {_uuid("test_run_id")} AS test_run_id, {_uuid("app_build_id")} AS app_build_id,
       CASE WHEN substr(test_run_id, 1, 1) = 'a' THEN 'again' ELSE test_name END AS test_name,
       epoch_us(end_time) AS end_us, 2 AS executions, output_kind <> 'no_stdout' AS has_stdout, NULL AS reason
FROM test_runs WHERE substr(test_run_id, 1, 1) NOT IN ('0', '1', '2', '3', '4', '5')
UNION ALL SELECT record_id, NULL, NULL, NULL, NULL, NULL, reason FROM {DAMAGED}""",
    "stream_latest_results": f"WITH {VALID} SELECT * FROM current_results",
    # Sessions by gaps; the final watermark (newest sample - delay) has not passed those that stay open.
    "stream_sample_rollup": f"""WITH {SAMPLES},
marked AS (
  SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 21600000000 THEN 0 ELSE 1 END AS opens
  FROM samples WINDOW w AS (PARTITION BY run_key ORDER BY ts)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY run_key ORDER BY ts) AS session FROM marked),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run_key, session ORDER BY latency_us) AS place,
         count(*) OVER (PARTITION BY run_key, session) AS n FROM numbered),
sessions AS (
  SELECT run_key, max(CASE WHEN place = (n + 1) // 2 THEN latency_us END) AS p50_us,
         max(CASE WHEN place = (95 * n + 99) // 100 THEN latency_us END) AS p95_us, epoch_us(min(ts)) AS started, epoch_us(max(ts)) + 21600000000 AS closed, count(*) AS requests,
         CAST(sum(latency_us) AS BIGINT) AS latency_sum_us, min(latency_us) AS min_us, max(latency_us) AS max_us,
         count(*) FILTER (WHERE outcome = 'error') AS status_errors
  FROM ranked GROUP BY run_key, session)
SELECT *, CASE WHEN closed <= (SELECT epoch_us(max(ts)) // 1000 * 1000 FROM samples) - 3600000000
               THEN 'closed' ELSE 'open' END AS state FROM sessions""",
}
ORACLE["chain_index_append"] = ORACLE["first_parent_log"]
ORACLE["chain_index_to_date"] = ORACLE["log_to_date"]
ORACLE["chain_index_sample"] = ORACLE["commit_sample"]
ORACLE["runs_joined_bucketed"] = ORACLE["runs_joined"]
ORACLE["parse_variant"] = ORACLE["parse_outputs"]
ORACLE["latest_runs_bucketed"] = f"""WITH {RUNS}
SELECT app_build_id, test_name, test_run_id, requests FROM (
  SELECT *, row_number() OVER (PARTITION BY app_build_id, test_name ORDER BY end_time DESC, test_run_id DESC) AS place
  FROM test_runs) AS ranked WHERE place = 1"""
ORACLE["ledger_pruned"] = f"""WITH {RUNS}, {BUILDS}
SELECT r.test_run_id, r.test_name, b.framework_commit, r.end_time, b.instance_id,
       year(r.end_time) * 10 + quarter(r.end_time) AS quarter,
       CASE WHEN substr(r.test_run_id, 1, 1) = 'a' THEN -1 ELSE r.requests END AS requests
FROM test_runs r JOIN builds b ON r.app_build_id = b.app_build_id JOIN nation n ON n.n_nationkey = b.instance_id
WHERE n.n_regionkey = 2 AND year(r.end_time) = 1994 + n.n_nationkey % 3 AND quarter(r.end_time) <= 2"""
ORACLE["output_schema"] = f"""WITH {RUNS},
whole AS (SELECT *, CAST(duration_us AS VARCHAR) LIKE '3%' AS noted FROM test_runs WHERE output_kind = 'ok')
SELECT path, kind, count(*) AS outputs FROM whole, (VALUES
  ('$.summary', 'object'), ('$.summary.duration', 'number'), ('$.summary.requests', 'number'), ('$.summary.bytes', 'number'),
  ('$.summary.errors', 'object'), ('$.summary.errors.connect', 'number'), ('$.summary.errors.read', 'number'),
  ('$.summary.errors.write', 'number'), ('$.summary.errors.status', 'number'), ('$.summary.errors.timeout', 'number'),
  ('$.latency', 'object'), ('$.latency.min', 'number'), ('$.latency.mean', 'number'), ('$.latency.max', 'number'),
  ('$.latency.stdev', 'number'), ('$.latency.percentile', 'array'), ('$.requests', 'object'), ('$.requests.min', 'number'),
  ('$.requests.mean', 'number'), ('$.requests.max', 'number'), ('$.requests.stdev', 'number'),
  ('$.requests.percentile', 'array')) AS fields(path, kind) GROUP BY path, kind
UNION ALL
SELECT path, kind, count(*) FROM whole, (VALUES ('$.summary.note', 'object'), ('$.summary.note.p999', 'number')) AS fields(path, kind)
WHERE noted GROUP BY path, kind"""
ORACLE["sketch_windows"] = f"""WITH {SAMPLES},
placed AS (
  SELECT run_key, latency_us, unnest(range(floor((d - 30) / 10.0)::BIGINT * 10 + 10, d - d % 10 + 1, 10)) AS start
  FROM (SELECT *, CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) AS d FROM samples) AS dated),
windows AS (
  SELECT run_key, start, count(*) AS requests, CAST(sum(latency_us) AS BIGINT) AS latency_sum_us, min(latency_us) AS min_us,
         max(latency_us) AS max_us FROM placed GROUP BY run_key, start)
SELECT run_key || '@' || strftime(DATE '1970-01-01' + CAST(start AS INT), '%Y-%m-%d') AS "window", percentile, requests, latency_sum_us, min_us, max_us,
       true AS within_error FROM windows, (SELECT unnest([5, 25, 50, 75, 95]) AS percentile) AS levels"""
ORACLE["coverage_sketched"] = f"""WITH RECURSIVE {TO_RUN},
wanted AS (SELECT DISTINCT test_name, framework_commit, app_name FROM needed),
done AS (SELECT DISTINCT test_name, framework_commit, app_name FROM completed),
covered AS (SELECT * FROM wanted INTERSECT SELECT * FROM done)
SELECT 'completed' AS task_set, count(*) AS tasks, true AS within_error FROM done
UNION ALL SELECT 'needed', count(*), true FROM wanted
UNION ALL SELECT 'covered', count(*), true FROM covered
UNION ALL SELECT 'to_run', (SELECT count(*) FROM wanted) - (SELECT count(*) FROM covered), true"""
ORACLE["stream_open_sessions"] = ORACLE["stream_sample_rollup"]
# A run without a build waits until the watermark, a delay behind the newest row of either stream, has passed it.
ORACLE["stream_joined_results"] = f"""WITH runs AS {_input(fx.TIMED_RUNS)}, app_builds AS {_input(fx.APP_BUILDS)},
watermark AS (
  SELECT least((SELECT max(end_time) FROM runs), (SELECT max(end_time) FROM app_builds)) - INTERVAL '65 days 12 hours' AS passed)
SELECT r.test_run_id, r.app_build_id, a.app_name, CASE WHEN a.app_build_id IS NULL THEN 'dangling' ELSE 'joined' END AS state
FROM runs r LEFT JOIN app_builds a
  ON a.app_build_id = r.app_build_id AND r.end_time BETWEEN a.end_time AND a.end_time + INTERVAL '65 days'
WHERE a.app_build_id IS NOT NULL OR r.end_time <= (SELECT passed FROM watermark)"""
ORACLE["compacted_records"] = ORACLE["ingest_records"]
