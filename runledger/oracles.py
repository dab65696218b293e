"""DuckDB SQL for the queries of :mod:`runledger.queries`, written in other ways than these.

State machines are folded row by row in recursive CTEs; families meet the next day by a self-join.
"""

from __future__ import annotations

LOG = """
slog AS (
  SELECT 2 * event_id AS line_no, CAST(ts AS DATE) AS record_date, ts,
         concat('/suite', (user_id // 10) % 5, '/fam', user_id // 10, '/t', user_id) AS node_path, 'task' AS node_type, command,
         CASE WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN 'by rule' END AS info
  FROM named
  UNION ALL
  SELECT 2 * event_id + 1, CAST(ts AS DATE), ts, concat('/suite', (user_id // 10) % 5, '/fam', user_id // 10), 'family', command, NULL
  FROM named)"""
NAMED = """
named AS (
  SELECT *, CASE event_type WHEN 'signup' THEN 'queued' WHEN 'view' THEN 'submitted' WHEN 'click' THEN 'active' WHEN 'purchase' THEN 'complete'
              ELSE CASE WHEN event_id % 10 = 0 THEN 'aborted' ELSE 'suspend' END END AS command FROM events)"""
WITH = f"WITH RECURSIVE {NAMED.strip()},{LOG}"
T = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def _t(*names: str) -> str:
    return ", ".join(f"{T.format(n)} AS {n}" for n in names)


#: Only the days of the calendar.
DAYS = "SELECT CAST(g AS DATE) AS run_date FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) x(g)"
STATUS = "command IN ('queued', 'submitted', 'active', 'complete', 'aborted')"


def _placed(where: str, ts: str = "ts", more: str = "TRUE") -> str:
    return f"""
days AS ({DAYS}),
src AS (SELECT node_path, record_date, {ts} AS ts, line_no, command FROM slog WHERE {where}),
placed AS (SELECT node_path, run_date, ts, line_no, command, row_number() OVER (PARTITION BY node_path, run_date ORDER BY ts, line_no) AS rn
           FROM src JOIN days ON record_date = run_date OR record_date = run_date + 1 WHERE {STATUS} AND {more})"""


def _fold(machine: str) -> str:
    """The state machine, one status change at a time."""
    if machine == "task":
        state = """CASE WHEN w.command = 'queued' THEN 'Queued' WHEN w.command = 'submitted' THEN 'Submitted'
          WHEN f.st = 'Submitted' AND w.command = 'active' THEN 'Active' WHEN f.st = 'Active' AND w.command = 'complete' THEN 'Complete'
          WHEN f.st IN ('Submitted', 'Active') AND w.command = 'aborted' THEN 'Error' ELSE f.st END"""
        s = "CASE WHEN w.command = 'queued' THEN NULL WHEN w.command = 'submitted' THEN w.ts ELSE f.s END"
        a = "CASE WHEN w.command IN ('queued', 'submitted') THEN NULL WHEN f.st = 'Submitted' AND w.command = 'active' THEN w.ts ELSE f.a END"
    else:
        error = "WHEN f.st IN ('Submitted', 'Active') AND w.command = 'aborted' THEN 'Error'" if machine == "strict" else ""
        state = f"""CASE WHEN w.command = 'queued' THEN 'Queued' WHEN f.st IN ('Initial', 'Queued') AND w.command = 'submitted' THEN 'Submitted'
          WHEN f.st = 'Submitted' AND w.command = 'active' THEN 'Active' WHEN f.st IN ('Submitted', 'Active') AND w.command = 'complete' THEN 'Complete'
          {error} ELSE f.st END"""
        s = "CASE WHEN w.command = 'queued' THEN NULL WHEN f.st IN ('Initial', 'Queued') AND w.command = 'submitted' THEN w.ts ELSE f.s END"
        a = "CASE WHEN w.command = 'queued' THEN NULL WHEN f.st = 'Submitted' AND w.command = 'active' THEN w.ts ELSE f.a END"
    stops = "('Complete', 'Error')" if machine == "strict" else "('Complete')"
    return f"""
f AS (
  SELECT node_path, run_date, CAST(0 AS BIGINT) AS rn, 'Initial' AS st, CAST(NULL AS TIMESTAMP) AS s, CAST(NULL AS TIMESTAMP) AS a,
         CAST(NULL AS TIMESTAMP) AS c, CAST(NULL AS TIMESTAMP) AS e
  FROM (SELECT DISTINCT node_path, run_date FROM placed)
  UNION ALL
  SELECT f.node_path, f.run_date, w.rn, {state}, {s}, {a},
         CASE WHEN w.command = 'complete' THEN w.ts END, CASE WHEN w.command = 'aborted' THEN w.ts ELSE f.e END
  FROM f JOIN placed w ON w.node_path = f.node_path AND w.run_date = f.run_date AND w.rn = f.rn + 1 WHERE f.st NOT IN {stops}),
folded AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY node_path, run_date ORDER BY rn DESC) = 1),
sizes AS (SELECT node_path, run_date, count(*) AS n FROM placed GROUP BY ALL),
sit AS (
  SELECT n.node_path, d.run_date, coalesce(z.n, 0) AS n_records, coalesce(x.st, 'Initial') AS situation, x.s AS tp_submitted, x.a AS tp_active,
         CASE WHEN x.st = 'Complete' THEN x.c END AS tp_complete, x.e AS tp_aborted, strftime(d.run_date, '%Y%m%d00') AS run_key
  FROM (SELECT DISTINCT node_path FROM src) n CROSS JOIN days d
  LEFT JOIN folded x ON x.node_path = n.node_path AND x.run_date = d.run_date
  LEFT JOIN sizes z ON z.node_path = n.node_path AND z.run_date = d.run_date)"""


SIT = f"SELECT node_path, run_date, n_records, situation, run_key, {_t('tp_submitted', 'tp_active', 'tp_complete', 'tp_aborted')} FROM sit"
TASK, FAMILY = "node_type = 'task'", "node_type = 'family'"


def _situations(where: str, machine: str, ts: str = "ts", more: str = "TRUE") -> str:
    return f"{WITH},{_placed(where, ts, more)},{_fold(machine)}"


def _us(a: str, b: str) -> str:
    return f"(epoch_us({b}) - epoch_us({a}))"


PERIOD = f"""
per AS (SELECT node_path, run_date, run_key, CASE WHEN tp_complete IS NOT NULL THEN {_us('CAST(run_date AS TIMESTAMP)', 'tp_submitted')} END AS start_clock,
          {_us('CAST(run_date AS TIMESTAMP)', 'tp_complete')} AS end_clock,
          CASE WHEN tp_complete IS NOT NULL THEN {_us('tp_submitted', 'tp_complete')} END AS duration FROM sit)"""


def _trim(source: str, by: str, col: str, name: str, ratio: str = "0.25") -> str:
    return f"""
{name} AS (SELECT {by}, sum(v) // count(*) AS m FROM (
  SELECT {by}, {col} AS v, row_number() OVER (PARTITION BY {by} ORDER BY {col}) AS r, count(*) OVER (PARTITION BY {by}) AS n FROM {source} WHERE {col} IS NOT NULL)
  WHERE r > floor(n * {ratio}) AND r <= n - floor(n * {ratio}) GROUP BY {by})"""


RUN4 = "command IN ('submitted', 'active', 'complete', 'aborted')"
DAILY = f"""
d AS (SELECT node_path, record_date, ts, command, info, row_number() OVER (PARTITION BY node_path, record_date ORDER BY ts, line_no) AS rn
      FROM slog WHERE {RUN4} AND {{where}})"""


def _span(name: str, a: str, b: str) -> str:
    return f"({_us(a, b)} // 1000000) // 86400 AS {name}_days, ({_us(a, b)} // 1000000) % 86400 AS {name}_seconds"


_TASK_DAY = f"""{WITH},{DAILY.format(where=TASK)},
s AS (SELECT node_path, record_date, min(rn) AS rn FROM d WHERE command = 'submitted' GROUP BY ALL),
a AS (SELECT d.node_path, d.record_date, min(d.rn) AS rn FROM d JOIN s USING (node_path, record_date) WHERE command = 'active' AND d.rn > s.rn GROUP BY ALL),
c AS (SELECT d.node_path, d.record_date, min(d.rn) AS rn FROM d JOIN a USING (node_path, record_date) WHERE command = 'complete' AND d.rn > a.rn GROUP BY ALL),
k AS (SELECT node_path, record_date, min(rn) AS rn FROM d WHERE command = 'complete' GROUP BY ALL),
r AS (SELECT k.node_path, k.record_date FROM k JOIN d ON d.node_path = k.node_path AND d.record_date = k.record_date AND d.rn = k.rn + 1
      WHERE command = 'complete' AND info = 'by rule'),
e AS (SELECT DISTINCT node_path, record_date FROM d WHERE command = 'aborted'),
g AS (SELECT DISTINCT node_path, record_date FROM d),
x AS (SELECT g.node_path, g.record_date, CASE WHEN e.node_path IS NOT NULL THEN 'error' WHEN s.rn IS NULL AND r.node_path IS NOT NULL THEN 'complete by rule'
          WHEN c.rn IS NULL THEN 'unknown' ELSE 'normal' END AS situation, s.rn AS sr, a.rn AS ar, c.rn AS cr
      FROM g LEFT JOIN e USING (node_path, record_date) LEFT JOIN s USING (node_path, record_date) LEFT JOIN a USING (node_path, record_date)
      LEFT JOIN c USING (node_path, record_date) LEFT JOIN r USING (node_path, record_date)),
y AS (SELECT x.node_path, x.record_date, situation, ds.ts AS submitted, da.ts AS active, dc.ts AS complete FROM x
      LEFT JOIN d ds ON situation = 'normal' AND ds.node_path = x.node_path AND ds.record_date = x.record_date AND ds.rn = sr
      LEFT JOIN d da ON situation = 'normal' AND da.node_path = x.node_path AND da.record_date = x.record_date AND da.rn = ar
      LEFT JOIN d dc ON situation = 'normal' AND dc.node_path = x.node_path AND dc.record_date = x.record_date AND dc.rn = cr)"""

_FAMILY_DAY = f"""{WITH},{DAILY.format(where=FAMILY)},
g AS (SELECT node_path, record_date, bool_or(command = 'aborted') AS bad, max(rn) AS n, min(rn) FILTER (WHERE command = 'complete') AS c,
        min(rn) FILTER (WHERE command IN ('complete', 'aborted')) AS e FROM d GROUP BY ALL),
x AS (SELECT g.node_path, g.record_date, g.bad, fr.command AS first, la.command AS last, fr.ts AS fts, la.ts AS lts, af.command AS behind, af.ts AS bts, nd.command AS next, nd.ts AS nts
      FROM g JOIN d fr ON fr.node_path = g.node_path AND fr.record_date = g.record_date AND fr.rn = 1
      JOIN d la ON la.node_path = g.node_path AND la.record_date = g.record_date AND la.rn = g.n
      LEFT JOIN d af ON af.node_path = g.node_path AND af.record_date = g.record_date AND af.rn = g.c + 1
      LEFT JOIN g g2 ON g2.node_path = g.node_path AND g2.record_date = g.record_date + 1
      LEFT JOIN d nd ON nd.node_path = g.node_path AND nd.record_date = g.record_date + 1 AND nd.rn = g2.e),
z AS (SELECT *, CASE WHEN bad THEN 'error' WHEN last = 'complete' THEN CASE WHEN first = 'submitted' THEN 'normal' ELSE 'unknown' END
        WHEN behind = 'submitted' AND next = 'aborted' THEN 'error' WHEN behind = 'submitted' AND next = 'complete' THEN 'normal' ELSE 'unknown' END AS situation FROM x),
y AS (SELECT node_path, record_date, situation, CASE WHEN situation = 'normal' THEN CASE WHEN last = 'complete' THEN fts ELSE bts END END AS submitted,
        CASE WHEN situation = 'normal' THEN CASE WHEN last = 'complete' THEN lts ELSE nts END END AS complete FROM z)"""

_NODES = f"""{WITH},
nodes AS (SELECT node_path, record_date FROM slog
  UNION ALL SELECT '/' || split_part(node_path, '/', 2), record_date FROM slog WHERE line_no % 7 = 1
  UNION ALL SELECT node_path || ':limit', record_date FROM slog WHERE line_no % 7 = 2
  UNION ALL SELECT node_path || '/alias0', record_date FROM slog WHERE line_no % 7 = 4
  UNION ALL SELECT node_path || '/alias1/deep', record_date FROM slog WHERE line_no % 7 = 6 AND line_no % 2 = 0),
paths AS (SELECT DISTINCT node_path FROM nodes),
asked AS (SELECT node_path FROM paths UNION SELECT '/' || split_part(node_path, '/', 2) FROM paths
  UNION SELECT '/' || split_part(node_path, '/', 2) FROM paths
  UNION SELECT '/' || split_part(node_path, '/', 2) || CASE WHEN split_part(node_path, '/', 3) <> '' THEN '/' || split_part(node_path, '/', 3) ELSE '' END FROM paths
  UNION SELECT '/' UNION SELECT node_path || '/absent' FROM paths UNION SELECT substr(node_path, 2, 100) FROM paths)"""


def _sql_text(form: str | None) -> str:
    if form is None:
        return "NULL"
    parts = form.replace("{t}", "\0clock\0").replace("{c}", "\0command\0").replace("{p}", "\0node_path\0").split("\0")
    return " || ".join(x if i % 2 else "'" + x.replace("'", "''") + "'" for i, x in enumerate(parts) if x)


def _lines() -> str:
    from .queries import _FORMS

    n = len(_FORMS)
    line = " ".join(f"WHEN {k} THEN {_sql_text(f[0])}" for k, f in enumerate(_FORMS))
    field = lambda i: " ".join(f"WHEN {k} THEN {_sql_text(f[i])}" for k, f in enumerate(_FORMS))
    return f"""{WITH},
src AS (SELECT *, (line_no // 2) % {n + 3} AS n, concat(hour(ts), ':', minute(ts), ':', second(ts), ' ', day(ts), '.', month(ts), '.', year(ts)) AS clock
        FROM slog WHERE {TASK}),
lines AS (SELECT line_no, n, date_trunc('second', ts) AS cut, CASE n {line} WHEN {n} THEN 'readlists' WHEN {n + 1} THEN '#x without a space'
            ELSE '# MSG:open ' || command END AS value,
            CASE n {field(1)} WHEN {n + 2} THEN 'MSG' END AS record_type, CASE n {field(2)} END AS cmd, CASE n {field(3)} END AS path, CASE n {field(4)} END AS info FROM src),
parsed AS (SELECT *, CASE WHEN n < {n} THEN cut END AS t FROM lines)"""


def _files() -> str:
    """Lines of the files, numbered, with the day that they belong to."""
    return f"""{_lines()},
filed AS (SELECT p.*, substr(s.node_path, 2, 6) || '-' || (day(s.ts) // 10) AS file, row_number() OVER (PARTITION BY substr(s.node_path, 2, 6), day(s.ts) // 10
            ORDER BY s.ts, s.line_no) - 1 AS no FROM parsed p JOIN src s USING (line_no)),
days AS (SELECT *, coalesce(last_value(CAST(t AS DATE) IGNORE NULLS) OVER (PARTITION BY file ORDER BY no ROWS UNBOUNDED PRECEDING),
            first_value(CAST(t AS DATE) IGNORE NULLS) OVER (PARTITION BY file ORDER BY no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS log_date FROM filed),
kept AS (SELECT file, no AS line_no, log_date, record_type, {T.format('t')} AS ts, cmd AS command, path AS node_path, info FROM days WHERE starts_with(value, '#') OR no = 0)"""


_HEADS = f"""{WITH},
v AS (SELECT *, CAST(regexp_extract(node_path, '^/suite([0-9]+)', 1) AS BIGINT) AS repo_id FROM slog)"""

_TIE = "date_trunc('hour', ts)"
_TABLE = """SELECT node_path, run_date, run_key, strftime(run_date, '%Y-%m-%d 00:00:00.000000') AS start_time, situation"""


def _table_sql() -> str:
    done = lambda c: f"CASE WHEN situation = 'Complete' THEN {T.format(c)} END"
    out = _TABLE + "".join(f", {done('tp_' + c)} AS time_point_{c}" for c in ("submitted", "active", "complete", "aborted"))
    for name, a, b in (("in_all", "submitted", "complete"), ("in_submitted", "submitted", "active"), ("in_active", "active", "complete")):
        out += f", CASE WHEN situation = 'Complete' THEN {_us('tp_' + a, 'tp_' + b)} END AS time_period_{name}"
        out += f", {done('tp_' + a)} AS time_period_{name}_start, {done('tp_' + b)} AS time_period_{name}_end"
    return f"{_situations(TASK, 'task')} {out} FROM sit"


_CLOCK = _us("CAST(run_date AS TIMESTAMP)", "tp_submitted")

ORACLES = {
    "status_changes": f"{WITH} SELECT line_no, node_path, record_date, {_t('ts')}, command AS status FROM slog WHERE {STATUS}",
    "node_day_counts": f"""{WITH} SELECT node_path, record_date, count(*) AS n_records, count(*) FILTER (WHERE command = 'aborted') > 0 AS any_abort FROM slog
        WHERE record_date >= DATE '2024-01-05' AND record_date <= DATE '2024-01-20' GROUP BY ALL""",
    "run_windows": f"{WITH},{_placed('TRUE')} SELECT node_path, run_date, line_no FROM placed",
    "run_calendar": f"""{WITH},{_placed('TRUE')} SELECT n.node_path, d.run_date, count(p.rn) AS n_records
        FROM (SELECT DISTINCT node_path FROM src) n CROSS JOIN days d LEFT JOIN placed p ON p.node_path = n.node_path AND p.run_date = d.run_date GROUP BY ALL""",
    "stream_run_windows": f"{WITH},{_placed('TRUE')} SELECT node_path, run_date, count(*) AS n_records FROM placed GROUP BY ALL",
    "stream_situations": f"{_situations(TASK, 'task')} {SIT}",
    "situations_task": f"{_situations(TASK, 'task')} {SIT}",
    "situations_ties": f"{_situations(TASK, 'task', _TIE)} {SIT}",
    "situations_family": f"{_situations(FAMILY, 'family')} {SIT}",
    "situations_family_strict": f"{_situations(FAMILY, 'strict')} {SIT}",
    "situations_by_table": f"{_situations(TASK, 'task')} SELECT node_path, run_date, situation FROM sit",
    "earliest_time_runs": f"{_situations(TASK, 'task', more='ts >= run_date + INTERVAL 6 HOUR')} {SIT}",
    "node_table": _table_sql(),
    "time_point": f"""{_situations(TASK, 'task')},
        c AS (SELECT node_path, run_date, run_key, CASE WHEN situation = 'Complete' THEN {_CLOCK} END AS clock FROM sit)
        SELECT *, CASE WHEN clock IS NOT NULL THEN printf('%d days %02d:%02d:%02d', clock // 86400000000, clock // 3600000000 % 24, clock // 60000000 % 60, clock // 1000000 % 60)
          || CASE WHEN clock % 1000000 = 0 THEN '' ELSE printf('.%06d', clock % 1000000) END END AS shown FROM c""",
    "time_point_summary": f"""{_situations(FAMILY, 'family')},{PERIOD},{_trim('per', 'node_path', 'end_clock', 't')}
        SELECT p.node_path, count(end_clock) AS n, CAST(sum(end_clock) // count(end_clock) AS BIGINT) AS mean, CAST(any_value(t.m) AS BIGINT) AS trimmed_mean
        FROM per p LEFT JOIN t ON t.node_path = p.node_path GROUP BY p.node_path""",
    "time_period": f"{_situations(TASK, 'task')},{PERIOD} SELECT * FROM per",
    "time_period_summary": f"""{_situations(FAMILY, 'family')},{PERIOD},{_trim('per', 'node_path', 'start_clock', 't')},{_trim('per', 'node_path', 'end_clock', 'u')}
        SELECT p.node_path, count(start_clock) AS n, CAST(any_value(t.m) AS BIGINT) AS start_mean, CAST(any_value(u.m) AS BIGINT) AS end_mean
        FROM per p LEFT JOIN t ON t.node_path = p.node_path LEFT JOIN u ON u.node_path = p.node_path GROUP BY p.node_path""",
    "late_runs": f"""{_situations(FAMILY, 'family')},{PERIOD},{_trim('per', 'node_path', 'end_clock', 'u')}
        SELECT p.*, TRUE AS end_clock_late FROM per p JOIN u ON u.node_path = p.node_path WHERE end_clock - m > 1800000000""",
    "model_run_report": f"""{_situations(TASK, 'task')},{PERIOD},{_trim('per', 'node_path', 'end_clock', 'u')}
        SELECT p.*, end_clock - m > 1800000000 AS end_clock_late FROM per p JOIN u ON u.node_path = p.node_path WHERE end_clock IS NOT NULL""",
    "trimmed_mean_value": f"""WITH e AS (SELECT event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events),{_trim('e', 'event_type', 'cents', 't', '0.1')}
        SELECT event_type, CAST(m AS BIGINT) AS trimmed_mean FROM t""",
    "task_situation_daily": f"""{_TASK_DAY} SELECT node_path, record_date, situation, {_t('submitted', 'active', 'complete')}, {_span('in_submitted', 'submitted', 'active')},
        {_span('in_active', 'active', 'complete')}, {_span('in_all', 'submitted', 'complete')} FROM y""",
    "complete_by_rule": f"{_TASK_DAY} SELECT node_path, record_date FROM y WHERE situation = 'complete by rule'",
    "family_situation_daily": f"{_FAMILY_DAY} SELECT node_path, record_date, situation, {_t('submitted', 'complete')}, {_span('in_all', 'submitted', 'complete')} FROM y",
    "run_timeline": f"""{_FAMILY_DAY} SELECT record_date AS run_date, node_path, {T.format('submitted')} AS start, {T.format('complete')} AS "end",
        CASE CAST(regexp_extract(node_path, '([0-9]+)$', 1) AS INT) % 3 WHEN 0 THEN 'serial' WHEN 1 THEN 'operation' ELSE 'unknown' END AS class
        FROM y WHERE situation = 'normal' AND record_date >= DATE '2024-01-03' AND record_date < DATE '2024-01-28'""",
    "node_tree": f"""{_NODES},
        p AS (SELECT DISTINCT node_path, string_split(node_path, '/') AS parts FROM nodes WHERE record_date = DATE '2024-01-10'),
        e AS (SELECT DISTINCT array_to_string(parts[1:k], '/') AS path FROM p, range(2, 20) r(k) WHERE k <= len(parts)),
        q AS (SELECT path, CASE WHEN regexp_matches(path, '^/[^/]*$') THEN '/' ELSE regexp_replace(path, '/[^/]*$', '') END AS parent FROM e)
        SELECT path, parent, regexp_extract(path, '([^/]*)$', 1) AS name, CAST(len(string_split(path, '/')) - 1 AS BIGINT) AS depth,
               path NOT IN (SELECT parent FROM q) AS is_leaf FROM q""",
    "node_types": f"""{_NODES}
        SELECT a.node_path, CASE WHEN a.node_path = '/' THEN 'root' WHEN NOT starts_with(a.node_path, '/') THEN 'unknown'
            WHEN a.node_path NOT IN (SELECT node_path FROM paths) THEN 'unknown' WHEN strpos(substr(a.node_path, 2), '/') = 0 THEN 'suite'
            WHEN EXISTS (SELECT 1 FROM paths p WHERE starts_with(p.node_path, a.node_path || '/') AND NOT starts_with(p.node_path, a.node_path || '/alias')) THEN 'family'
            WHEN contains(a.node_path, ':') THEN 'non-task' ELSE 'task' END AS node_type FROM asked a""",
    "node_exists": f"{_NODES} SELECT node_path, node_path IN (SELECT node_path FROM paths) AS present FROM asked",
    "parse_sms": f"""{_lines()} SELECT line_no, record_type, CAST(t AS DATE) AS record_date, {T.format('t')} AS ts, cmd AS command, path AS node_path, info
        FROM parsed WHERE starts_with(value, '#') OR line_no = 0""",
    "parse_ecflow": f"""{WITH} SELECT line_no, 'LOG' AS record_type, record_date, {T.format("date_trunc('second', ts)")} AS ts,
        CASE WHEN line_no % 5 <> 0 THEN command END AS command, CASE WHEN line_no % 5 <> 0 THEN node_path END AS node_path,
        CASE WHEN line_no % 5 <> 0 THEN info END AS info FROM slog WHERE {TASK}""",
    "pre_filter": f"{_lines()} SELECT line_no, value FROM parsed WHERE regexp_matches(value, '/fam[0-9]*[02468]/t[0-9]+([^0-9:]|$)')",
    "log_file_info": f"""{_lines()} SELECT coalesce(strftime(t, '%Y-%m-%d'), 'undated') AS file_path, count(*) AS line_count,
        {T.format('min(t)')} AS first_ts, {T.format('max(t)')} AS last_ts FROM parsed GROUP BY ALL""",
    "register_versions": f"""{_HEADS},
        fl AS (SELECT repo_id, record_date AS version_day, hour(ts) AS h, min(line_no) AS seen_at, arg_min(node_path, line_no) AS head FROM v GROUP BY ALL),
        o AS (SELECT repo_id, version_day, head || ' ' || seen_at AS head_line, seen_at,
                row_number() OVER (PARTITION BY repo_id, version_day ORDER BY CASE WHEN seen_at % 4 < 2 THEN 0 ELSE 1 END, seen_at) AS version_seq FROM fl)
        SELECT repo_id, version_day, version_seq, head_line, strftime(version_day, '%Y%m%d') || CASE WHEN version_seq < 10 THEN '0' ELSE '' END || version_seq AS version_id,
               'version.' || strftime(version_day, '%Y-%m-%d') || '.' || version_seq AS version_name FROM o""",
    "incremental_rows": f"""{_HEADS}, r AS (SELECT 'o' AS owner, CAST(repo_id AS VARCHAR) AS repo, strftime(record_date, '%Y%m%d') AS version_id, line_no FROM v)
        SELECT * FROM r WHERE NOT EXISTS (SELECT 1 FROM r s WHERE s.repo = r.repo AND s.version_id = r.version_id AND s.line_no % 11 = 0
          AND s.version_id < '20240120' AND s.line_no >= r.line_no)""",
    "resolve_repo": f"""{_HEADS} SELECT DISTINCT 'suite' || repo_id AS user_name, regexp_extract(node_path, '([^/]*)$', 1) AS repo_name FROM v WHERE {FAMILY}""",
    "upsert_dim": f"{_HEADS} SELECT DISTINCT repo_id, node_path, CASE WHEN repo_id < 2 THEN 'old' ELSE 'new' END AS state FROM v",
    "export_keyed": f"""{WITH} SELECT substr(sha256('20240110.' || line_no), 1, 8) || '-' || printf('%08x', CAST(epoch(date_trunc('second', ts)) AS BIGINT)) AS row_key, line_no, node_path
        FROM slog WHERE {TASK} AND record_date = DATE '2024-01-10'""",
    "scan_by_key": f"""{WITH}, k AS (SELECT substr(sha256(strftime(record_date, '%Y%m%d') || '.' || line_no), 1, 8) || '-'
          || printf('%08x', CAST(epoch(date_trunc('second', ts)) AS BIGINT)) AS row_key, line_no FROM slog WHERE {TASK})
        SELECT * FROM k WHERE regexp_matches(row_key, '^[0-7].*-659[0-9a-f]{{5}}$')""",
    "records_as_json": f"""{WITH} SELECT '{{"line_no":' || line_no || ',"node_path":"' || node_path || '","command":"' || command || '"'
        || CASE WHEN info IS NULL THEN '' ELSE ',"info":"' || info || '"' END || '}}' AS json FROM slog WHERE {TASK}""",
    "load_resumes": f"{_files()} SELECT * FROM kept",
    "load_days": f"{_files()} SELECT * FROM kept WHERE log_date >= DATE '2024-01-08' AND log_date < DATE '2024-01-22'",
    "stream_tail": f"{_files()} SELECT * EXCLUDE (log_date) FROM kept",
    "stream_machine": f"{_situations(TASK, 'task')} {SIT}",
    "stream_fold": f"{_situations(TASK, 'task')} SELECT node_path, run_date, situation FROM sit",
    # Nodes in the order of a walk; each opens its document, and closes those that end before the next node.
    "node_tree_nested": f"""{_NODES},
        p AS (SELECT DISTINCT string_split(node_path, '/') AS parts FROM nodes WHERE record_date = DATE '2024-01-10'),
        e AS (SELECT DISTINCT parts[2:k] AS parts FROM p, range(2, 20) r(k) WHERE k <= len(parts)),
        c AS (SELECT a.parts, count(*) AS n, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM e x WHERE len(x.parts) = len(b.parts) + 1 AND x.parts[1:len(b.parts)] = b.parts)) AS l
              FROM e a JOIN e b ON b.parts[1:len(a.parts)] = a.parts GROUP BY a.parts),
        w AS (SELECT *, lead(len(parts)) OVER (PARTITION BY parts[1] ORDER BY parts) AS next FROM c),
        s AS (SELECT parts, n, l, '{{"name":' || to_json(parts[-1]) || ',"nodes":' || n || ',"leaves":' || l || ',"children":['
                || CASE WHEN next > len(parts) THEN '' ELSE repeat(']}}', (len(parts) - coalesce(next, 1) + 1)::INT) || CASE WHEN next IS NULL THEN '' ELSE ',' END END AS text FROM w)
        SELECT '/' || parts[1] AS suite, max(n) AS n_nodes, arg_max(l, n) AS n_leaves, string_agg(text, '' ORDER BY parts) AS document FROM s GROUP BY parts[1]""",
}
ORACLES["maintained_means"] = ORACLES["time_period_summary"]
ORACLES["scan_sorted"] = ORACLES["scan_by_key"]
_SOME = "node_path IN ('/suite0/fam0/t3', '/suite0/fam0/t7', '/suite1/fam1/t12', '/suite2/fam2/t21')"
ORACLES["situations_clipped"] = (
    _situations(f"{TASK} AND {_SOME}", "task", more="record_date < DATE '2024-01-15'").replace("2024-01-30", "2024-01-14") + " " + SIT
)
ORACLES["line_numbers"] = f"{_files()} SELECT file, no AS line_no, value FROM filed"
ORACLES["read_ecflow"] = ORACLES["parse_ecflow"].replace("SELECT line_no, 'LOG'", "SELECT 'LOG'")
ORACLES["report_csv"] = (
    f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in ('run_key', 'node_path', 'run_date', 'start_clock', 'end_clock', 'duration', 'end_clock_late'))} "
    f"FROM ({ORACLES['model_run_report']})"
)
ORACLES["timeline_json"] = ORACLES["run_timeline"]
ORACLES["import_csv"] = f"""{WITH} SELECT 'o' AS owner, 'r, with a comma' AS repo, strftime(record_date, '%Y%m%d') AS version_id, line_no, record_date, {T.format('ts')} AS ts,
    command, node_path, info, 'say "' || node_path || '", ' || command AS raw FROM slog WHERE {TASK}"""
ORACLES["resolve_version"] = f"""{_HEADS},
    fl AS (SELECT repo_id, record_date AS version_day, min(line_no) AS seen_at, arg_min(node_path, line_no) AS head_line FROM v GROUP BY ALL),
    k AS (SELECT repo_id, head_line, arg_min(version_day, (seen_at, version_day)) AS version_day, min(seen_at) AS met FROM fl WHERE seen_at % 3 < 2 GROUP BY ALL),
    n AS (SELECT *, row_number() OVER (PARTITION BY repo_id, version_day ORDER BY met, head_line) AS version_seq FROM k)
    SELECT f.repo_id, f.head_line, f.seen_at, strftime(n.version_day, '%Y%m%d') || CASE WHEN version_seq < 10 THEN '0' ELSE '' END || version_seq AS version_id,
           n.version_day, coalesce(n.version_seq, 0) AS version_seq FROM fl f LEFT JOIN n ON n.repo_id = f.repo_id AND n.head_line = f.head_line"""
