"""Independent DuckDB SQL for each catalog query (the correctness oracle).

Log queries inline the corpus as a ``log_lines`` CTE rendered for DuckDB from
the same template Spark uses.  Queries without an exact SQL form (a random
draw) have no entry.
"""

from __future__ import annotations

from logscope.functions import patterns as P
from logscope.sources.fixture import log_lines_sql

ORACLE: dict[str, str] = {}

LOG_CTE = "log_lines AS (" + log_lines_sql("duckdb") + ")"


def logs_sql(body: str) -> str:
    """``WITH log_lines AS (...), <body>`` where body starts with further CTEs or SELECT."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {LOG_CTE}\n{body}"
    return f"WITH {LOG_CTE},\n{body}"


LEVEL_DIM = "(VALUES ('INFO', 1), ('WARN', 2), ('ERROR', 3), ('DEBUG', 4)) AS d(log_level, o)"
LEVEL_WORD = f"upper(regexp_extract(line, '{P.LEVEL_WORD}', 1))"
LEVEL_PLAIN = f"regexp_extract(line, '{P.LEVEL_PLAIN}', 1)"

# ------------------------------------------------------------------ family A
ORACLE["level_counts"] = logs_sql(f"""
c AS (SELECT {LEVEL_WORD} AS lv, count(*) AS n FROM log_lines GROUP BY 1)
SELECT d.log_level, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM {LEVEL_DIM} LEFT JOIN c ON c.lv = d.log_level ORDER BY d.o""")

ORACLE["level_counts_plain"] = logs_sql(f"""
c AS (SELECT {LEVEL_PLAIN} AS lv, count(*) AS n FROM log_lines GROUP BY 1)
SELECT d.log_level, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM {LEVEL_DIM} LEFT JOIN c ON c.lv = d.log_level ORDER BY d.o""")

ORACLE["level_summary"] = logs_sql(f"""
l AS (SELECT {LEVEL_WORD} AS lv FROM log_lines),
t AS (SELECT count(*) AS total_lines, count(*) FILTER (WHERE lv <> '') AS lines_with_level FROM l),
c AS (SELECT lv, count(*) AS n FROM l WHERE lv <> '' GROUP BY lv),
z AS (SELECT d.log_level, d.o, CAST(coalesce(c.n, 0) AS BIGINT) AS count
      FROM {LEVEL_DIM} LEFT JOIN c ON c.lv = d.log_level)
SELECT z.log_level, z.count,
       CASE WHEN t.lines_with_level = 0 THEN 0.0 ELSE 100.0::DOUBLE * z.count / t.lines_with_level END AS share_pct,
       t.total_lines, t.lines_with_level,
       CAST((SELECT count(*) FROM z WHERE count > 0) AS INTEGER) AS unique_levels
FROM z, t ORDER BY z.o""")

ORACLE["level_occurrences"] = logs_sql(f"""
m AS (SELECT unnest(regexp_extract_all(line, '{P.LEVEL_PLAIN}', 1)) AS log_level FROM log_lines)
SELECT log_level, CAST(count(*) AS BIGINT) AS occurrences FROM m GROUP BY 1""")

ORACLE["sample_lines_seeded"] = logs_sql(f"""
l AS (SELECT line_no, line, {LEVEL_WORD} AS log_level FROM log_lines)
SELECT line AS log_entry, log_level FROM l WHERE log_level <> ''
ORDER BY md5(concat(CAST(line_no AS VARCHAR), '|42')), line_no LIMIT 10""")

ORACLE["one_pass_summary"] = ORACLE["level_summary"]
ORACLE["one_pass_sample"] = logs_sql(f"""
l AS (SELECT line, {LEVEL_WORD} AS log_level, md5(concat(CAST(line_no AS VARCHAR), '|42')) AS draw FROM log_lines),
r AS (SELECT *, row_number() OVER (PARTITION BY floor(CAST('0x' || draw[1:8] AS BIGINT) * 10 / 4294967296.0) ORDER BY draw, line) AS k
      FROM l WHERE log_level <> '')
SELECT line AS log_entry, log_level FROM r WHERE k = 1""")

ORACLE["error_lines"] = logs_sql("""
SELECT path, line_no, line FROM log_lines WHERE contains(line, 'ERROR')""")

# ------------------------------------------------------------------ family B
TS_SQL = ("coalesce(try_strptime(s, '%y/%m/%d %H:%M:%S,%g'), try_strptime(s, '%y/%m/%d %H:%M:%S'), "
          "try_strptime(s, '%Y-%m-%d %H:%M:%S,%g'), try_strptime(s, '%Y-%m-%d %H:%M:%S'))")
APP_SQL = f"regexp_extract(path, '{P.APPLICATION_ID}', 1)"
PARSED = f"""parsed AS (
  SELECT path, line_no, line, {TS_SQL} AS ts, {APP_SQL} AS application_id
  FROM (SELECT *, regexp_extract(line, '{P.TS_ANY}', 1) AS s FROM log_lines))"""
TIMELINE = f"""{PARSED},
tl AS (
  SELECT regexp_extract(application_id, '{P.CLUSTER_ID}', 1) AS cluster_id, application_id,
         regexp_extract(application_id, '{P.APP_NUMBER}', 1) AS app_number,
         min(ts) AS start_time, max(ts) AS end_time
  FROM parsed WHERE application_id <> '' AND ts IS NOT NULL GROUP BY 1, 2, 3)"""
CLUSTERS = f"""{TIMELINE},
cs AS (
  SELECT cluster_id, count(*) AS num_applications, min(start_time) AS cluster_first_app,
         max(end_time) AS cluster_last_app
  FROM tl GROUP BY cluster_id)"""
BUSY = f"""{CLUSTERS},
busy AS (
  SELECT tl.*, (epoch_us(end_time) - epoch_us(start_time)) / 6e7 AS duration_min FROM tl
  WHERE cluster_id IN (SELECT cluster_id FROM cs ORDER BY num_applications DESC, cluster_id LIMIT 1))"""
ROLE_SQL = ("CASE WHEN container_no = '' THEN '' WHEN container_no = '000001' THEN 'ApplicationMaster' "
            "ELSE 'Executor' END")
IDS = f"""ids AS (
  SELECT *, regexp_extract(container_id, '{P.CONTAINER_PARTS}', 1) AS attempt,
            regexp_extract(container_id, '{P.CONTAINER_PARTS}', 2) AS container_no
  FROM (SELECT *, {APP_SQL} AS application_id, regexp_extract(path, '{P.CONTAINER_ID}', 1) AS container_id
        FROM files))"""


def histogram_sql(values_cte: str, bins: int = 30, lo_name="bin_lo", hi_name="bin_hi",
                  as_cte: str | None = None) -> str:
    w = f"((b.hi - b.lo) / {float(bins)}::DOUBLE)"
    final = f"""SELECT CAST(r.range AS INTEGER) AS bin, b.lo + r.range * {w} AS {lo_name},
       b.lo + (r.range + 1) * {w} AS {hi_name}, CAST(coalesce(c.n, 0) AS BIGINT) AS count, b.n AS n
FROM range({bins}) r CROSS JOIN b LEFT JOIN c ON c.bin = r.range"""
    head = f"""d AS (SELECT v FROM ({values_cte}) WHERE v IS NOT NULL),
b AS (SELECT min(v) AS lo, max(v) AS hi, count(*) AS n FROM d),
c AS (SELECT CAST(CASE WHEN b.hi = b.lo THEN 0 ELSE least(floor((d.v - b.lo) / {w}), {bins - 1}) END AS INTEGER) AS bin,
             count(*) AS n FROM d, b GROUP BY 1)"""
    if as_cte:
        return f"{head},\n{as_cte} AS ({final})"
    return f"{head}\n{final} ORDER BY 1"


ORACLE["path_ids"] = logs_sql(f"""
files AS (SELECT DISTINCT path FROM log_lines),
{IDS}
SELECT path, application_id, regexp_extract(application_id, '{P.CLUSTER_ID}', 1) AS cluster_id,
       regexp_extract(application_id, '{P.APP_NUMBER}', 1) AS app_number, container_id, attempt,
       container_no, {ROLE_SQL} AS role
FROM ids""")

ORACLE["app_timeline"] = logs_sql(f"""{TIMELINE}
SELECT cluster_id, application_id, app_number, start_time, end_time FROM tl ORDER BY cluster_id, app_number""")

ORACLE["container_timeline"] = logs_sql(f"""{PARSED},
files AS (SELECT path, min(ts) AS start_time, max(ts) AS end_time, count(*) AS num_lines FROM parsed GROUP BY path),
{IDS}
SELECT application_id, container_id, attempt, container_no, {ROLE_SQL} AS role, start_time, end_time,
       num_lines, (epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS duration_sec, num_lines <= 41 AS short_lived
FROM ids WHERE container_id <> ''""")

ORACLE["cluster_summary"] = logs_sql(f"""{CLUSTERS}
SELECT * FROM cs ORDER BY num_applications DESC, cluster_id""")

ORACLE["usage_stats"] = logs_sql(f"""{CLUSTERS}
SELECT count(*) AS total_clusters, CAST(coalesce(sum(num_applications), 0) AS BIGINT) AS total_applications,
       CASE WHEN count(*) = 0 THEN 0.0 ELSE CAST(sum(num_applications) AS DOUBLE) / count(*) END AS avg_apps_per_cluster
FROM cs""")

ORACLE["top_clusters"] = logs_sql(f"""{CLUSTERS}
SELECT * FROM cs ORDER BY num_applications DESC, cluster_id LIMIT 5""")

ORACLE["cluster_start_month"] = logs_sql(f"""{CLUSTERS}
SELECT cluster_id, num_applications, epoch_ms(CAST(cluster_id AS BIGINT)) AS cluster_start,
       strftime(epoch_ms(CAST(cluster_id AS BIGINT)), '%b %Y') AS start_month
FROM cs ORDER BY num_applications DESC, cluster_id""")

ORACLE["busiest_cluster_durations"] = logs_sql(f"""{BUSY}
SELECT cluster_id, application_id, app_number, start_time, end_time, duration_min FROM busy""")

ORACLE["duration_histogram"] = logs_sql(f"""{BUSY},
{histogram_sql("SELECT duration_min AS v FROM busy")}""")

ORACLE["duration_histogram_log"] = logs_sql(f"""{BUSY},
{histogram_sql("SELECT log10(duration_min) AS v FROM busy WHERE duration_min > 0", lo_name="log10_lo",
               hi_name="log10_hi", as_cte="h")}
SELECT h.*, (SELECT count(*) FILTER (WHERE NOT (duration_min > 0)) FROM busy) AS excluded_nonpositive
FROM h ORDER BY bin""")

ORACLE["duration_density"] = logs_sql(f"""{BUSY},
d AS (SELECT log10(duration_min) AS v FROM busy WHERE duration_min > 0),
s AS (SELECT count(*) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM d),
g AS (SELECT n, sd * pow(n, -0.2) AS h, lo - 3 * sd * pow(n, -0.2) AS lo, (hi - lo + 6 * sd * pow(n, -0.2)) / 199 AS step
      FROM s WHERE n > 1 AND sd > 0),
x AS (SELECT floor((v - lo) / step) AS j, (v - lo) / step - floor((v - lo) / step) AS f FROM d, g),
w AS (SELECT j, sum(w) AS w FROM (SELECT j, 1 - f AS w FROM x UNION ALL SELECT j + 1, f FROM x) GROUP BY j),
k AS (SELECT CAST(r.range AS INTEGER) AS point, sum(w.w * exp(-pow((r.range - w.j) * g.step / g.h, 2) / 2)) AS z
      FROM range(200) r, w, g GROUP BY 1)
SELECT point, n, round(lo + point * step, 9) AS log10_x, round(z / (n * h * sqrt(2 * pi())), 9) AS density, round(h, 9) AS bandwidth
FROM k, g""")

APP_FILES = f"""files AS (SELECT path, {APP_SQL} AS application_id, sum(strlen(line) + 1) AS file_bytes
          FROM log_lines GROUP BY path),
af AS (SELECT application_id, count(*) AS num_files, CAST(sum(file_bytes) AS BIGINT) AS app_bytes
       FROM files WHERE application_id <> '' GROUP BY application_id)"""

ORACLE["app_inventory"] = logs_sql(f"""{APP_FILES}
SELECT count(*) AS num_applications, CAST(coalesce(sum(num_files), 0) AS BIGINT) AS num_files,
       avg(num_files) AS mean_files_per_app, min(app_bytes) AS min_app_bytes, avg(app_bytes) AS mean_app_bytes,
       max(app_bytes) AS max_app_bytes
FROM af""")

ORACLE["top_apps_by_files"] = logs_sql(f"""{APP_FILES}
SELECT application_id, num_files, app_bytes FROM af ORDER BY num_files DESC, application_id LIMIT 5""")

# ------------------------------------------------------------------ family C
DAY_KEYS = ("CAST(year({ts}) AS INTEGER) AS dt_year, CAST(month({ts}) AS INTEGER) AS dt_month, "
            "CAST(day({ts}) AS INTEGER) AS dt_day")
YEAR_1996 = "{ts} >= TIMESTAMP '1996-01-01 00:00:00' AND {ts} < TIMESTAMP '1997-01-01 00:00:00'"

LINEITEM_DAILY = f"""SELECT {DAY_KEYS.format(ts='l_shipdate')}, count(*) AS num_rows,
       avg(l_quantity) AS mean_quantity, max(l_tax) AS max_tax,
       quantile_disc(l_extendedprice, 0.95) AS q95_extendedprice, min(l_discount) AS min_discount,
       CAST(ceil(avg(l_linenumber)) AS BIGINT) AS ceil_mean_linenumber
FROM lineitem WHERE {YEAR_1996.format(ts='l_shipdate')}
GROUP BY 1, 2, 3"""

ORACLE["daily_summary_lineitem"] = LINEITEM_DAILY + "\nORDER BY 1 DESC, 2 DESC, 3 DESC"

ORACLE["daily_summary_orders"] = f"""SELECT {DAY_KEYS.format(ts='o_orderdate')}, count(*) AS num_rows,
       avg(o_totalprice) AS mean_totalprice, max(o_totalprice) AS max_totalprice,
       quantile_disc(o_totalprice, 0.95) AS q95_totalprice, min(o_totalprice) AS min_totalprice
FROM orders WHERE {YEAR_1996.format(ts='o_orderdate')}
GROUP BY 1, 2, 3 ORDER BY 1 DESC, 2 DESC, 3 DESC"""

ORACLE["period_totals"] = f"""WITH d AS ({LINEITEM_DAILY})
SELECT count(*) AS num_days, CAST(coalesce(sum(num_rows), 0) AS BIGINT) AS total_num_rows,
       avg(num_rows) AS mean_daily_num_rows, min(make_date(dt_year, dt_month, dt_day)) AS first_date,
       max(make_date(dt_year, dt_month, dt_day)) AS last_date
FROM d"""

# ------------------------------------------------------------------ log events
CONT_SQL = f"regexp_extract(path, '{P.CONTAINER_ID}', 1)"


def events_cte(pattern: str, groups: dict[str, tuple[int, str]], container: bool = False) -> str:
    cols = [f"{APP_SQL} AS application_id"] + ([f"{CONT_SQL} AS container_id"] if container else [])
    for name, (i, typ) in groups.items():
        g = f"regexp_extract(line, '{pattern}', {i})"
        cols.append(f"{g} AS {name}" if typ == "string" else f"TRY_CAST(NULLIF({g}, '') AS {typ}) AS {name}")
    first = next(iter(groups.values()))[0]
    return (f"ev AS (SELECT {', '.join(cols)} FROM log_lines "
            f"WHERE regexp_extract(line, '{pattern}', {first}) <> '')")


def size_sql(v: str, u: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {float(1024 ** e)}::DOUBLE" for k, e in P.UNIT_EXPONENT.items())
    return f"(TRY_CAST({v} AS DOUBLE) * CASE {u} {whens} END)"


EXEC_EV = events_cte(P.EXECUTOR_REQUEST, {
    "executors": (1, "BIGINT"), "cores": (2, "BIGINT"), "memory_mb": (3, "BIGINT"), "overhead_mb": (4, "BIGINT")})

ORACLE["executor_requests"] = logs_sql(f"""{EXEC_EV}
SELECT application_id, count(*) AS num_requests, CAST(sum(executors) AS BIGINT) AS total_executors,
       avg(executors) AS avg_executors, avg(cores) AS avg_cores, avg(memory_mb) AS avg_memory_mb,
       avg(overhead_mb) AS avg_overhead_mb
FROM ev GROUP BY application_id""")

ORACLE["container_requests"] = logs_sql(f"""{events_cte(P.CONTAINER_REQUEST, {
    "host": (1, "string"), "memory_mb": (2, "BIGINT"), "vcores": (3, "BIGINT")})}
SELECT application_id, host, memory_mb, vcores, count(*) AS num_requests FROM ev GROUP BY ALL""")

ORACLE["request_shapes"] = logs_sql(f"""{EXEC_EV}
SELECT executors, cores, memory_mb, count(*) AS num_requests, count(DISTINCT application_id) AS num_applications,
       100.0::DOUBLE * count(*) / (SELECT count(*) FROM ev) AS share_pct
FROM ev GROUP BY ALL ORDER BY num_requests DESC, executors, cores, memory_mb""")

ORACLE["input_splits"] = logs_sql(f"""{events_cte(P.INPUT_SPLIT, {
    "input_file": (1, "string"), "off": (2, "BIGINT"), "len": (3, "BIGINT")})}
SELECT application_id, input_file, count(*) AS num_splits, CAST(sum(len) AS BIGINT) AS total_bytes,
       max(off + len) AS max_end_offset
FROM ev GROUP BY ALL""")

ORACLE["python_worker_times"] = logs_sql(f"""{events_cte(P.WORKER_TIMES, {
    "total_ms": (1, "BIGINT"), "boot_ms": (2, "BIGINT"), "init_ms": (3, "BIGINT"), "finish_ms": (4, "BIGINT")})}
SELECT application_id, count(*) AS num_reports, avg(total_ms) AS avg_total_ms, avg(boot_ms) AS avg_boot_ms,
       avg(init_ms) AS avg_init_ms, avg(finish_ms) AS avg_finish_ms, max(total_ms) AS max_total_ms,
       quantile_disc(total_ms, 0.95) AS p95_total_ms,
       count(*) FILTER (WHERE boot_ms < 0) AS negative_boot,
       count(*) FILTER (WHERE total_ms <> boot_ms + init_ms + finish_ms) AS identity_mismatch
FROM ev GROUP BY application_id""")

ORACLE["memory_capacity"] = logs_sql(f"""{events_cte(P.MEMORY_CAPACITY, {
    "value": (1, "string"), "unit": (2, "string")}, container=True)}
SELECT application_id, container_id, max({size_sql('value', 'unit')}) AS capacity_bytes, count(*) AS num_starts
FROM ev GROUP BY ALL""")

ORACLE["stored_blocks"] = logs_sql(f"""{events_cte(P.STORED_BLOCK, {
    "block_id": (1, "string"), "stored_as": (2, "string"), "sv": (3, "string"), "su": (4, "string"),
    "fv": (5, "string"), "fu": (6, "string")})}
SELECT application_id, split_part(block_id, '_', 1) AS block_kind, stored_as, count(*) AS num_blocks,
       sum({size_sql('sv', 'su')}) AS total_size_bytes, min({size_sql('fv', 'fu')}) AS min_free_bytes
FROM ev GROUP BY ALL""")

ORACLE["broadcast_reads"] = logs_sql(f"""{events_cte(P.BROADCAST_READ, {
    "broadcast_id": (1, "BIGINT")})}
SELECT application_id, count(*) AS num_reads, count(DISTINCT broadcast_id) AS distinct_broadcasts
FROM ev GROUP BY application_id""")

ORACLE["cache_hits"] = logs_sql(f"""{events_cte(P.CACHE_HIT, {
    "block_id": (1, "string"), "location": (2, "string")})}
SELECT application_id, location, count(*) AS hits, count(DISTINCT block_id) AS distinct_blocks
FROM ev GROUP BY ALL""")

ORACLE["shuffle_fetches"] = logs_sql(f"""{events_cte(P.SHUFFLE_FETCH, {
    "fetches": (1, "BIGINT"), "fetch_ms": (2, "BIGINT")})}
SELECT application_id, count(*) AS num_reports, CAST(sum(fetches) AS BIGINT) AS total_fetches,
       avg(fetch_ms) AS avg_fetch_ms, max(fetch_ms) AS max_fetch_ms
FROM ev GROUP BY application_id""")

# ------------------------------------------------------------------ tasks
TASKS = f"""te AS (
  SELECT * FROM (
    SELECT {APP_SQL} AS application_id, regexp_extract(path, '{P.CONTAINER_ID}', 1) AS container_id, {TS_SQL} AS ts,
           regexp_extract(line, '{P.TASK_EVENT}', 1) AS event,
           TRY_CAST(NULLIF(regexp_extract(line, '{P.TASK_EVENT}', 2), '') AS BIGINT) AS task_index,
           TRY_CAST(NULLIF(regexp_extract(line, '{P.TASK_EVENT}', 3), '') AS BIGINT) AS task_attempt,
           TRY_CAST(NULLIF(regexp_extract(line, '{P.TASK_EVENT}', 4), '') AS BIGINT) AS stage_id,
           TRY_CAST(NULLIF(regexp_extract(line, '{P.TASK_EVENT}', 5), '') AS BIGINT) AS stage_attempt,
           TRY_CAST(NULLIF(regexp_extract(line, '{P.TASK_EVENT}', 6), '') AS BIGINT) AS tid
    FROM (SELECT *, regexp_extract(line, '{P.TS_ANY}', 1) AS s FROM log_lines))
  WHERE event <> ''),
tk AS (
  SELECT application_id, stage_id, stage_attempt, task_index, task_attempt, tid,
         min(CASE WHEN event = 'Running' THEN ts END) AS start_time,
         max(CASE WHEN event = 'Finished' THEN ts END) AS end_time, bool_or(event = 'Finished') AS finished
  FROM te GROUP BY ALL),
t AS (SELECT *, (epoch_us(end_time) - epoch_us(start_time)) / 1e6 AS duration_sec FROM tk)"""

ORACLE["task_lifecycle"] = logs_sql(f"""{TASKS}
SELECT * FROM t""")

ORACLE["task_time_by_app"] = logs_sql(f"""{TASKS}
SELECT application_id, count(*) AS num_tasks, count(*) FILTER (WHERE finished) AS finished_tasks,
       avg(duration_sec) AS avg_task_sec, max(duration_sec) AS max_task_sec, sum(duration_sec) AS total_task_sec
FROM t GROUP BY application_id""")

ORACLE["unfinished_tasks"] = logs_sql(f"""{TASKS},
a AS (SELECT application_id, count(*) AS num_tasks, count(*) FILTER (WHERE NOT finished) AS unfinished_tasks,
             count(*) FILTER (WHERE task_attempt > 0) AS retried_tasks FROM t GROUP BY application_id),
err AS (SELECT {APP_SQL} AS application_id, count(*) AS error_lines FROM log_lines
        WHERE {LEVEL_WORD} = 'ERROR' GROUP BY 1)
SELECT a.application_id, num_tasks, unfinished_tasks, 100.0::DOUBLE * unfinished_tasks / num_tasks AS unfinished_pct,
       retried_tasks, CAST(coalesce(error_lines, 0) AS BIGINT) AS error_lines
FROM a LEFT JOIN err ON a.application_id = err.application_id""")

ORACLE["stage_skew"] = logs_sql(f"""{TASKS},
s AS (SELECT application_id, stage_id, count(*) AS num_tasks, quantile_disc(duration_sec, 0.5) AS median_sec,
             quantile_disc(duration_sec, 0.95) AS p95_sec, max(duration_sec) AS max_sec
      FROM t WHERE duration_sec IS NOT NULL GROUP BY ALL)
SELECT *, CASE WHEN median_sec > 0 THEN max_sec / median_sec END AS max_over_median,
          CASE WHEN median_sec > 0 THEN p95_sec / median_sec END AS p95_over_median
FROM s""")

ORACLE["stage_bottlenecks"] = logs_sql(f"""{TASKS},
s AS (SELECT application_id, stage_id, count(*) AS num_tasks, coalesce(sum(duration_sec), 0.0) AS total_task_sec,
             max(duration_sec) AS max_task_sec FROM t GROUP BY ALL)
SELECT application_id, stage_id, num_tasks, total_task_sec, max_task_sec,
       CASE WHEN sum(total_task_sec) OVER (PARTITION BY application_id) > 0
            THEN 100.0::DOUBLE * total_task_sec / sum(total_task_sec) OVER (PARTITION BY application_id)
            ELSE 0.0 END AS share_pct,
       CAST(rank() OVER (PARTITION BY application_id ORDER BY total_task_sec DESC, stage_id) AS INTEGER) AS stage_rank
FROM s""")

ORACLE["stages_per_app"] = logs_sql(f"""{TASKS}
SELECT application_id, count(DISTINCT stage_id) AS num_stages, count(*) AS num_tasks,
       CASE WHEN count(DISTINCT stage_id) > 0 THEN count(*) / count(DISTINCT stage_id) END AS avg_tasks_per_stage
FROM t GROUP BY application_id""")

ORACLE["slowest_tasks"] = logs_sql(f"""{TASKS}
SELECT application_id, stage_id, stage_attempt, task_index, task_attempt, tid, start_time, end_time, duration_sec
FROM t WHERE duration_sec IS NOT NULL
ORDER BY duration_sec DESC, application_id, stage_id, stage_attempt, task_index, task_attempt, tid LIMIT 10""")

ORACLE["container_failures"] = logs_sql(f"""{TASKS},
k AS (SELECT application_id, container_id, stage_id, stage_attempt, task_index, task_attempt, tid,
             bool_or(event = 'Finished') AS finished FROM te GROUP BY ALL),
a AS (SELECT application_id, container_id, count(*) AS num_tasks, count(*) FILTER (WHERE NOT finished) AS unfinished_tasks,
             count(*) FILTER (WHERE task_attempt > 0) AS retried_tasks FROM k GROUP BY ALL),
err AS (SELECT {APP_SQL} AS application_id, regexp_extract(path, '{P.CONTAINER_ID}', 1) AS container_id,
               count(*) AS error_lines FROM log_lines WHERE {LEVEL_WORD} = 'ERROR' GROUP BY ALL)
SELECT application_id, container_id, coalesce(num_tasks, 0) AS num_tasks, coalesce(unfinished_tasks, 0) AS unfinished_tasks,
       coalesce(retried_tasks, 0) AS retried_tasks, CAST(coalesce(error_lines, 0) AS BIGINT) AS error_lines
FROM a FULL JOIN err USING (application_id, container_id) WHERE container_id <> ''""")

ORACLE["cache_hits_by_rdd"] = logs_sql(f"""{events_cte(P.CACHE_HIT, {
    "block_id": (1, "string"), "location": (2, "string")})}
SELECT application_id, TRY_CAST(regexp_extract(block_id, '{P.RDD_BLOCK}', 1) AS BIGINT) AS rdd_id, count(*) AS hits,
       count(*) FILTER (WHERE location = 'remotely') AS remote_hits,
       count(DISTINCT regexp_extract(block_id, '{P.RDD_BLOCK}', 2)) AS distinct_partitions
FROM ev WHERE regexp_matches(block_id, '{P.RDD_BLOCK}') GROUP BY ALL""")

# ------------------------------------------------------------------ stage precedence
PRECEDES = ("{a}.application_id = {b}.application_id AND {a}.stage_id <> {b}.stage_id AND ({a}.z < {b}.a OR ({a}.z = {b}.a AND NOT "
            "({a}.a = {a}.z AND {b}.a = {b}.z AND {a}.stage_id > {b}.stage_id)))").format
STAGES = f"""{TASKS},
sg AS (SELECT application_id, stage_id, min(start_time) AS a, max(greatest(start_time, end_time)) AS z FROM t
       WHERE start_time IS NOT NULL AND end_time IS NOT NULL GROUP BY ALL),
pr AS (SELECT x.application_id, x.stage_id AS f, y.stage_id AS t, x.z, y.a FROM sg x JOIN sg y ON {PRECEDES(a='x', b='y')}),
red AS (SELECT pr.* FROM pr LEFT JOIN (SELECT p.application_id, p.f, q.t FROM pr p JOIN pr q ON p.application_id = q.application_id AND p.t = q.f) v
        ON v.application_id = pr.application_id AND v.f = pr.f AND v.t = pr.t WHERE v.f IS NULL)"""

ORACLE["stage_precedence"] = logs_sql(f"""{STAGES}
SELECT application_id, f AS from_stage, t AS to_stage, (epoch_us(a) - epoch_us(z)) / 1e6 AS wait_sec FROM red""")

# every chain of stages that follow one another directly, by recursion
ORACLE["critical_paths"] = logs_sql(f"""{STAGES},
ch AS (
  WITH RECURSIVE c(application_id, last, us, path) AS (
    SELECT application_id, stage_id, epoch_us(z) - epoch_us(a), [stage_id] FROM sg
    UNION ALL
    SELECT c.application_id, sg.stage_id, c.us + epoch_us(sg.z) - epoch_us(sg.a), list_append(c.path, sg.stage_id)
    FROM c JOIN red ON red.application_id = c.application_id AND red.f = c.last
           JOIN sg ON sg.application_id = c.application_id AND sg.stage_id = red.t)
  SELECT *, row_number() OVER (PARTITION BY application_id ORDER BY us DESC, len(path) DESC, list_reverse(path)) AS k FROM c),
r AS (SELECT application_id, count(*) AS num_stages, epoch_us(max(z)) - epoch_us(min(a)) AS span FROM sg GROUP BY 1)
SELECT r.application_id, num_stages, CAST(len(path) AS BIGINT) AS path_stages, us / 1e6 AS path_sec, array_to_string(path, '>') AS path,
       span / 1e6 AS span_sec, CASE WHEN span > 0 THEN 100.0::DOUBLE * us / span ELSE 0.0 END AS path_pct
FROM r JOIN ch USING (application_id) WHERE k = 1""")

# ------------------------------------------------------------------ work over time
# brute force: every instant is joined with all containers that are open at it
CONTAINERS = f"""{PARSED},
files AS (SELECT path, min(ts) AS start_time, max(ts) AS end_time FROM parsed GROUP BY path),
{IDS},
c AS (SELECT regexp_extract(application_id, '{P.CLUSTER_ID}', 1) AS cluster_id, start_time, end_time FROM ids
      WHERE container_id <> '' AND start_time IS NOT NULL),
pts AS (SELECT a.cluster_id, a.t, count(*) AS open FROM (SELECT DISTINCT cluster_id, start_time AS t FROM c) a
       JOIN c b ON a.cluster_id = b.cluster_id AND b.start_time <= a.t AND b.end_time >= a.t GROUP BY ALL)"""
SECS = "(epoch_us({b}) - epoch_us({a})) / 1e6".format

ORACLE["concurrency_by_cluster"] = logs_sql(f"""{CONTAINERS},
s AS (SELECT cluster_id, count(*) AS num_containers, min(start_time) AS first_time, max(end_time) AS last_time,
             CAST(sum(epoch_us(end_time) - epoch_us(start_time)) AS DOUBLE) AS us FROM c GROUP BY cluster_id),
p AS (SELECT cluster_id, max(open) AS peak_containers, arg_max(t, (open, -epoch_us(t))) AS peak_time FROM pts GROUP BY cluster_id)
SELECT s.cluster_id, num_containers, first_time, last_time, peak_containers, peak_time, us / 1e6 AS container_sec,
       CASE WHEN last_time > first_time THEN us / (epoch_us(last_time) - epoch_us(first_time)) ELSE 0.0 END AS mean_containers
FROM s JOIN p ON s.cluster_id = p.cluster_id""")

ORACLE["concurrency_over_time"] = logs_sql(f"""{CONTAINERS},
m AS (SELECT cluster_id, time_bucket(INTERVAL 1 HOUR, start_time) AS b, 1 AS s, 0 AS e FROM c
      UNION ALL SELECT cluster_id, time_bucket(INTERVAL 1 HOUR, end_time), 0, 1 FROM c),
r AS (SELECT cluster_id, b, CAST(sum(s) AS BIGINT) AS started, CAST(sum(e) AS BIGINT) AS ended FROM m GROUP BY ALL),
o AS (SELECT r.cluster_id, r.b, count(*) FILTER (WHERE c.start_time < r.b) AS open_before,
             CAST(sum(epoch_us(least(c.end_time, r.b + INTERVAL 1 HOUR)) - epoch_us(greatest(c.start_time, r.b))) AS DOUBLE) / 3.6e9 AS mean_containers
      FROM r JOIN c ON c.cluster_id = r.cluster_id AND c.end_time >= r.b AND c.start_time < r.b + INTERVAL 1 HOUR GROUP BY ALL),
p AS (SELECT cluster_id, time_bucket(INTERVAL 1 HOUR, t) AS b, max(open) AS peak FROM pts GROUP BY ALL)
SELECT r.cluster_id, r.b AS range_start, open_before, started, ended, greatest(open_before, coalesce(peak, 0)) AS peak_containers,
       mean_containers
FROM r JOIN o USING (cluster_id, b) LEFT JOIN p USING (cluster_id, b)""")

SPELLS = f"""{TASKS},
iv AS (SELECT application_id, container_id, min(CASE WHEN event = 'Running' THEN ts END) AS a,
              max(CASE WHEN event = 'Finished' THEN ts END) AS z
       FROM te WHERE container_id <> ''
       GROUP BY application_id, container_id, stage_id, stage_attempt, task_index, task_attempt, tid),
ok AS (SELECT application_id, container_id, a, greatest(a, z) AS z FROM iv WHERE a IS NOT NULL AND z IS NOT NULL),
g AS (SELECT *, max(z) OVER (PARTITION BY application_id, container_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM ok),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END)
             OVER (PARTITION BY application_id, container_id ORDER BY a, z ROWS UNBOUNDED PRECEDING) AS spell FROM g),
sp AS (SELECT application_id, container_id, spell, min(a) AS spell_start, max(z) AS spell_end, count(*) AS num_tasks FROM i GROUP BY ALL)"""

ORACLE["busy_spells"] = logs_sql(f"""{SPELLS}
SELECT application_id, container_id, CAST(spell AS BIGINT) AS spell, spell_start, spell_end, num_tasks,
       {SECS(a='spell_start', b='spell_end')} AS spell_sec FROM sp""")

ORACLE["container_activity"] = logs_sql(f"""{SPELLS},
n AS (SELECT *, lead(spell_start) OVER (PARTITION BY application_id, container_id ORDER BY spell) AS nxt FROM sp),
q AS (SELECT application_id, container_id, CAST(sum(num_tasks) AS BIGINT) AS num_tasks, min(spell_start) AS first_start,
             max(spell_end) AS last_end, count(*) AS num_spells,
             CAST(sum(epoch_us(spell_end) - epoch_us(spell_start)) AS DOUBLE) AS busy,
             CAST(coalesce(sum(epoch_us(nxt) - epoch_us(spell_end)), 0) AS DOUBLE) AS idle,
             CAST(coalesce(max(epoch_us(nxt) - epoch_us(spell_end)), 0) AS DOUBLE) AS longest FROM n GROUP BY ALL)
SELECT application_id, container_id, num_tasks, first_start, last_end, num_spells, busy / 1e6 AS busy_sec, idle / 1e6 AS idle_sec,
       longest / 1e6 AS longest_gap_sec,
       CASE WHEN last_end > first_start THEN 100.0::DOUBLE * idle / (epoch_us(last_end) - epoch_us(first_start)) ELSE 0.0 END AS idle_pct
FROM q""")

STATES = f"""mem AS (
  SELECT *, {APP_SQL} AS application_id, {CONT_SQL} AS container_id, {TS_SQL} AS ts
  FROM (SELECT *, regexp_extract(line, '{P.TS_ANY}', 1) AS s, regexp_extract(line, '{P.STORED_BLOCK}', 1) AS block_id,
               regexp_extract(line, '{P.MEMORY_CAPACITY}', 1) AS cv FROM log_lines)),
blocks AS (
  SELECT application_id, container_id, ts, block_id, regexp_extract(line, '{P.STORED_BLOCK}', 2) AS stored_as,
         {size_sql(f"regexp_extract(line, '{P.STORED_BLOCK}', 3)", f"regexp_extract(line, '{P.STORED_BLOCK}', 4)")} AS size_bytes,
         {size_sql(f"regexp_extract(line, '{P.STORED_BLOCK}', 5)", f"regexp_extract(line, '{P.STORED_BLOCK}', 6)")} AS free_bytes
  FROM mem WHERE block_id <> ''),
caps AS (
  SELECT application_id, container_id, ts, max({size_sql('cv', f"regexp_extract(line, '{P.MEMORY_CAPACITY}', 2)")}) AS cap
  FROM mem WHERE cv <> '' AND ts IS NOT NULL GROUP BY ALL),
st AS (
  SELECT b.*, caps.cap AS capacity_bytes, CASE WHEN caps.cap > 0 THEN free_bytes / caps.cap END AS free_share
  FROM blocks b ASOF LEFT JOIN caps
       ON b.application_id = caps.application_id AND b.container_id = caps.container_id AND b.ts >= caps.ts)"""

ORACLE["memory_states"] = logs_sql(f"{STATES}\nSELECT * FROM st")
ORACLE["memory_lows"] = logs_sql(f"""{STATES}
SELECT application_id, container_id, count(*) AS num_blocks, sum(size_bytes) AS stored_bytes, count(capacity_bytes) AS blocks_with_capacity,
       min(free_bytes) AS min_free_bytes, min(free_share) AS min_free_share FROM st GROUP BY ALL""")

# ------------------------------------------------------------------ text sources and sinks
ORACLE["text_level_counts"] = ORACLE["level_counts"]
ORACLE["level_groups"] = logs_sql(f"SELECT {LEVEL_PLAIN} AS log_level, count(*) AS count FROM log_lines GROUP BY 1")
ORACLE["text_glob_lines"] = logs_sql(f"SELECT {APP_SQL} AS application_id, count(*) AS num_lines FROM log_lines GROUP BY 1")
ORACLE["text_numbered_lines"] = logs_sql(f"""
SELECT application_id, row_number() OVER (PARTITION BY application_id ORDER BY line_no) - 1 AS line_no, line
FROM (SELECT *, {APP_SQL} AS application_id FROM log_lines)""")
ORACLE["text_app_subset"] = logs_sql(f"""
SELECT {APP_SQL} AS application_id, {LEVEL_WORD} AS log_level, count(*) AS count FROM log_lines
WHERE {APP_SQL} = 'application_1485248649253_0001' GROUP BY ALL""")
ORACLE["text_inventory"] = logs_sql(f"""
files AS (SELECT {APP_SQL} AS application_id, CAST(sum(strlen(line) + 1) AS BIGINT) AS b FROM log_lines GROUP BY 1)
SELECT count(*) AS num_applications, count(*) AS num_files, 1.0::DOUBLE AS mean_files_per_app, min(b) AS min_app_bytes,
       avg(b) AS mean_app_bytes, max(b) AS max_app_bytes FROM files""")
TREE = f"""files AS (SELECT {APP_SQL} AS application_id, count(*) AS num_lines, CAST(sum(strlen(line)) AS BIGINT) AS line_bytes
          FROM log_lines GROUP BY 1)"""
ORACLE["text_top_apps"] = logs_sql(f"""{TREE}
SELECT application_id, CAST(1 AS BIGINT) AS num_files, line_bytes + num_lines AS app_bytes FROM files ORDER BY 2 DESC, 1 LIMIT 5""")
ORACLE["incremental_timeline"] = ORACLE["app_timeline"]
ORACLE["incremental_runs"] = logs_sql(f"""{TREE},
f AS (SELECT line_bytes + num_lines AS b, application_id LIKE 'application_1485248649253_%' AS first FROM files),
t AS (SELECT count(*) AS n, sum(b) AS b, count(*) FILTER (WHERE first) AS n1, sum(b) FILTER (WHERE first) AS b1 FROM f)
SELECT 1 AS version, n1 AS files_listed, CAST(b1 AS BIGINT) AS bytes_listed, n1 AS files_read, CAST(b1 AS BIGINT) AS bytes_read FROM t
UNION ALL SELECT 2, n, CAST(b AS BIGINT), n - n1, CAST(b - b1 AS BIGINT) FROM t
UNION ALL SELECT 3, n, CAST(b AS BIGINT), 0, 0 FROM t""")
ORACLE["read_accounting"] = logs_sql(f"""{TREE}
SELECT application_id, num_lines, line_bytes, line_bytes + num_lines AS text_bytes, 'whole' AS status, CAST(0 AS BIGINT) AS missing_bytes FROM files""")
ORACLE["read_accounting_gzip"] = ORACLE["read_accounting"]
ORACLE["crlf_csv_roundtrip"] = logs_sql(f"""
c AS (SELECT {LEVEL_WORD} AS lv, count(*) AS n FROM log_lines GROUP BY 1),
z AS (SELECT d.log_level, CAST(coalesce(c.n, 0) AS BIGINT) AS count FROM {LEVEL_DIM} LEFT JOIN c ON c.lv = d.log_level)
SELECT 'log_level,count' || chr(13) || chr(10) || string_agg(log_level || ',' || count || chr(13) || chr(10), '' ORDER BY count DESC, log_level)
       AS file_text FROM z""")
ORACLE["distributed_csv_roundtrip"] = ORACLE["error_lines"]
ORACLE["timeline_csv_roundtrip"] = ORACLE["app_timeline"]
ORACLE["sample_csv_roundtrip"] = ORACLE["sample_lines_seeded"]
ORACLE["error_lines_roundtrip"] = logs_sql("SELECT line FROM log_lines WHERE contains(line, 'ERROR')")
ORACLE["concat_frames"] = logs_sql("""
SELECT path, line_no, line FROM log_lines WHERE contains(line, 'ERROR')
UNION ALL SELECT path, line_no, NULL FROM log_lines WHERE contains(line, 'DEBUG')""")
ORACLE["sample_random_check"] = logs_sql(f"""
n AS (SELECT least(10, count(*)) AS k FROM log_lines WHERE {LEVEL_WORD} <> '')
SELECT k AS sample_size, k AS found, k AS right_level FROM n""")
ORACLE["period_scan"] = """SELECT o_orderkey, o_totalprice, 1996 AS yyyy, CAST(month(o_orderdate) AS INTEGER) AS mm FROM orders
WHERE year(o_orderdate) = 1996 AND month(o_orderdate) BETWEEN 3 AND 8"""
ORACLE["multi_file_scan"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"

# ------------------------------------------------------------------ records
COMP_SQL = f"regexp_extract(line, '{P.COMPONENT}', 2)"

ORACLE["parsed_records"] = logs_sql(f"""
SELECT path, line_no, try_strptime(regexp_extract(line, '{P.TS_ANCHORED}', 1), '%y/%m/%d %H:%M:%S') AS ts,
       {LEVEL_PLAIN} AS level, {COMP_SQL} AS component, line AS message
FROM log_lines""")

ORACLE["component_counts"] = logs_sql(f"""
SELECT {COMP_SQL} AS component, count(*) AS count FROM log_lines GROUP BY 1 ORDER BY 2 DESC, 1""")

ORACLE["parse_audit"] = logs_sql(f"""
p AS (SELECT {APP_SQL} AS application_id, {TS_SQL} AS ts, {LEVEL_WORD} AS lv, {COMP_SQL} AS comp
      FROM (SELECT *, regexp_extract(line, '{P.TS_ANY}', 1) AS s FROM log_lines)),
a AS (SELECT application_id, count(*) AS num_lines, count(*) FILTER (WHERE ts IS NULL) AS no_timestamp,
             count(*) FILTER (WHERE lv = '') AS no_level, count(*) FILTER (WHERE comp = '') AS no_component
      FROM p GROUP BY 1)
SELECT *, 100.0::DOUBLE * no_timestamp / num_lines AS no_timestamp_pct,
       100.0::DOUBLE * no_level / num_lines AS no_level_pct,
       100.0::DOUBLE * no_component / num_lines AS no_component_pct
FROM a""")

MASKED = "line"
for _pattern, _mask in P.SHAPE_MASKS:
    MASKED = f"regexp_replace({MASKED}, '{_pattern}', '{_mask}', 'g')"

ORACLE["unparsed_templates"] = logs_sql(f"""
u AS (SELECT *, {TS_SQL} IS NULL AS nt, {LEVEL_WORD} = '' AS nl, {COMP_SQL} = '' AS nc
      FROM (SELECT *, regexp_extract(line, '{P.TS_ANY}', 1) AS s FROM log_lines)),
sh AS (SELECT string_split_regex(regexp_replace({MASKED}, '^\\s+|\\s+$', '', 'g'), '\\s+') AS words, count(*) AS n, min(line) AS example,
              count(*) FILTER (WHERE nt) AS nt, count(*) FILTER (WHERE nl) AS nl, count(*) FILTER (WHERE nc) AS nc
       FROM u WHERE nt OR nl OR nc GROUP BY 1),
tot AS (SELECT len(words) AS k, words[1:2] AS prefix, sum(n) AS n, count(*) AS m, sum(nt) AS nt, sum(nl) AS nl, sum(nc) AS nc, min(example) AS example
        FROM sh GROUP BY ALL),
pl AS (SELECT len(words) AS k, words[1:2] AS prefix, unnest(words) AS w, unnest(range(len(words))) AS i FROM sh),
tp AS (SELECT k, prefix, string_agg(w, ' ' ORDER BY i) AS template
       FROM (SELECT k, prefix, i, CASE WHEN min(w) = max(w) THEN min(w) ELSE '<*>' END AS w FROM pl GROUP BY ALL) GROUP BY ALL)
SELECT template, CAST(k AS INTEGER) AS num_words, CAST(n AS BIGINT) AS num_lines, m AS num_shapes, CAST(nt AS BIGINT) AS no_timestamp,
       CAST(nl AS BIGINT) AS no_level, CAST(nc AS BIGINT) AS no_component, example
FROM tot JOIN tp USING (k, prefix) ORDER BY num_lines DESC, template""")

ORACLE["host_activity"] = logs_sql(f"""
h AS (SELECT path, unnest(list_distinct(regexp_extract_all(line, '{P.HOST}', 1))) AS host FROM log_lines
      WHERE {' OR '.join(f"contains(line, '{x}')" for x in P.HOST_HINTS)})
SELECT host, count(*) AS lines, count(DISTINCT path) AS containers,
       count(DISTINCT {APP_SQL}) AS applications
FROM h GROUP BY host""")

ORACLE["stitched_entries"] = logs_sql(f"""
h AS (SELECT path, line_no, line, regexp_matches(line, '{P.ENTRY_HEADER}') AS is_header FROM log_lines),
e AS (SELECT *, max(CASE WHEN is_header THEN line_no END) OVER (
        PARTITION BY path ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS entry FROM h)
SELECT path, entry AS entry_line_no, true AS has_header, count(*) AS num_lines,
       string_agg(line, chr(10) ORDER BY line_no) AS entry_text
FROM e WHERE entry IS NOT NULL GROUP BY path, entry
UNION ALL SELECT path, line_no, false, 1, line FROM e WHERE entry IS NULL""")

ORACLE["parse_audit_by_file"] = logs_sql(f"""
p AS (SELECT path, {TS_SQL} AS ts, {LEVEL_WORD} AS lv, {COMP_SQL} AS comp
      FROM (SELECT *, regexp_extract(line, '{P.TS_ANY}', 1) AS s FROM log_lines)),
a AS (SELECT path, count(*) AS num_lines, count(*) FILTER (WHERE ts IS NULL) AS no_timestamp,
             count(*) FILTER (WHERE lv = '') AS no_level, count(*) FILTER (WHERE comp = '') AS no_component
      FROM p GROUP BY 1)
SELECT *, 100.0::DOUBLE * no_timestamp / num_lines AS no_timestamp_pct,
       100.0::DOUBLE * no_level / num_lines AS no_level_pct,
       100.0::DOUBLE * no_component / num_lines AS no_component_pct
FROM a""")

# ------------------------------------------------------------------ sources and SQL surface
def profile_sql(table: str, cols: list[tuple[str, str]]) -> str:
    parts = [f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS num_rows, "
             f"count(*) - count({c}) AS num_nulls FROM {table}" for c, t in cols]
    return "\nUNION ALL\n".join(parts)


ORACLE["source_profile_orders"] = profile_sql("orders", [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
    ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")])

ORACLE["source_profile_lineitem"] = profile_sql("lineitem", [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")])

ORACLE["view_row_count"] = "SELECT COUNT(*) AS total FROM lineitem"

ORACLE["even_keys_doubled"] = "SELECT o_orderkey * 2 AS doubled FROM orders WHERE o_orderkey % 2 = 0"

# ------------------------------------------------------------------ text reports (K5)
ORACLE["level_report"] = logs_sql(f"""
l AS (SELECT {LEVEL_WORD} AS lv FROM log_lines),
t AS (SELECT count(*) AS tl, count(*) FILTER (WHERE lv <> '') AS w FROM l),
c AS (SELECT d.log_level, d.o, coalesce((SELECT count(*) FROM l WHERE l.lv = d.log_level), 0) AS n
      FROM {LEVEL_DIM}),
r AS (
  SELECT 0 AS line_no, 'Total log lines processed: ' || format('{{:,}}', tl) AS text FROM t
  UNION ALL SELECT 1, 'Total lines with log levels: ' || format('{{:,}}', w) FROM t
  UNION ALL SELECT 2, 'Unique log levels found: ' || CAST((SELECT count(*) FROM c WHERE n > 0) AS VARCHAR)
  UNION ALL SELECT 3, ''
  UNION ALL SELECT 4, 'Log level distribution:'
  UNION ALL SELECT 4 + c.o, printf('  %-5s: %10s (%6.2f%%)', c.log_level, format('{{:,}}', c.n),
                                   CASE WHEN t.w = 0 THEN 0.0 ELSE 100.0::DOUBLE * c.n / t.w END)
  FROM c, t)
SELECT CAST(line_no AS INTEGER) AS line_no, text FROM r ORDER BY line_no""")

ORACLE["usage_report"] = logs_sql(f"""{CLUSTERS},
st AS (SELECT count(*) AS nc, CAST(coalesce(sum(num_applications), 0) AS BIGINT) AS na FROM cs),
top AS (SELECT *, row_number() OVER (ORDER BY num_applications DESC, cluster_id) AS rk FROM cs
        ORDER BY num_applications DESC, cluster_id LIMIT 5),
r AS (
  SELECT 0 AS line_no, 'Total unique clusters: ' || CAST(nc AS VARCHAR) AS text FROM st
  UNION ALL SELECT 1, 'Total applications: ' || CAST(na AS VARCHAR) FROM st
  UNION ALL SELECT 2, printf('Average applications per cluster: %.2f',
                             CASE WHEN nc = 0 THEN 0.0 ELSE CAST(na AS DOUBLE) / nc END) FROM st
  UNION ALL SELECT 3, ''
  UNION ALL SELECT 4, 'Most heavily used clusters:'
  UNION ALL SELECT 4 + rk, printf('  Cluster %s: %d applications', cluster_id, num_applications) FROM top)
SELECT CAST(line_no AS INTEGER) AS line_no, text FROM r ORDER BY line_no""")

ORACLE["period_report"] = f"""WITH d AS ({LINEITEM_DAILY}),
t AS (SELECT count(*) AS nd, CAST(coalesce(sum(num_rows), 0) AS BIGINT) AS tot, avg(num_rows) AS mean_daily,
             min(make_date(dt_year, dt_month, dt_day)) AS fd, max(make_date(dt_year, dt_month, dt_day)) AS ld FROM d),
r AS (
  SELECT 0 AS line_no, 'Days with data: ' || CAST(nd AS VARCHAR) AS text FROM t
  UNION ALL SELECT 1, 'Date range: ' || strftime(fd, '%m/%d/%Y') || ' to ' || strftime(ld, '%m/%d/%Y') FROM t
  UNION ALL SELECT 2, 'Total rows: ' || format('{{:,}}', tot) FROM t
  UNION ALL SELECT 3, 'Average rows per day: ' || format('{{:,.0f}}', mean_daily) FROM t)
SELECT CAST(line_no AS INTEGER) AS line_no, text FROM r ORDER BY line_no"""

ORACLE["app_timeline_anchored"] = logs_sql(f"""
p AS (SELECT {APP_SQL} AS application_id,
             try_strptime(regexp_extract(line, '{P.TS_ANCHORED}', 1), '%y/%m/%d %H:%M:%S') AS ts FROM log_lines)
SELECT regexp_extract(application_id, '{P.CLUSTER_ID}', 1) AS cluster_id, application_id,
       regexp_extract(application_id, '{P.APP_NUMBER}', 1) AS app_number, min(ts) AS start_time, max(ts) AS end_time
FROM p WHERE application_id <> '' AND ts IS NOT NULL GROUP BY 1, 2, 3 ORDER BY cluster_id, app_number""")
