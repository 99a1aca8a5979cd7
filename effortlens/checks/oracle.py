"""An independent SQL statement for each query, in DuckDB's dialect."""

from __future__ import annotations

AS_OF = "DATE '1998-06-17'"


def _jst(column: str) -> str:
    return f"({column} AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Tokyo')"


def _month(column: str) -> str:
    return f"strftime({_jst(column)}, '%Y-%m')"


def _day(column: str) -> str:
    return f"CAST({_jst(column)} AS DATE)"


def _iso(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%dT%H:%M:%SZ')"


RAW = """raw AS (
  SELECT l_orderkey || '-' || l_linenumber AS task_id,
         p_name AS task_name,
         p_brand AS project_id,
         ' ' || p_brand || ' ' AS project_name,
         CASE WHEN l_suppkey % 10 = 0 THEN NULL
              WHEN l_suppkey % 10 = 1 THEN '' ELSE s_name END AS assignee_name,
         CASE WHEN l_linestatus = 'F' THEN l_shipdate + to_hours(l_suppkey % 24) END
           AS completed_at,
         o_orderdate AS created_at,
         CASE WHEN l_partkey % 17 <> 0
              THEN CAST(l_shipdate AS DATE) + CAST(l_partkey % 21 - 10 AS INTEGER) END AS due_on,
         l_shipdate + to_minutes(l_partkey) AS modified_at,
         l_shipdate + to_minutes(l_partkey + l_suppkey) AS inserted_at,
         CASE WHEN l_tax <> 0 THEN l_quantity * 10 END AS estimated_time,
         CASE WHEN l_discount <> 0 THEN floor(l_extendedprice / 100) END / 60.0 AS actual_time,
         CASE WHEN l_discount <> 0 THEN floor(l_extendedprice / 100) END AS actual_time_raw,
         l_linenumber > 1 AS is_subtask,
         CASE WHEN l_linenumber > 1 THEN l_orderkey || '-1' END AS parent_task_id,
         p_brand AS project_gid,
         CASE WHEN l_suppkey % 10 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS assignee_gid,
         CASE WHEN l_tax <> 0 THEN l_quantity * 10 END AS estimated_minutes,
         CASE WHEN l_discount <> 0 THEN floor(l_extendedprice / 100) END AS actual_minutes
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey)"""

VERSION_ORDER = (
    "modified_at DESC, inserted_at DESC, project_gid, coalesce(assignee_gid, ''), task_name"
)

UNIQUE = (
    RAW
    + f""", ranked AS (
  SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY {VERSION_ORDER}) AS rn
  FROM raw WHERE completed_at IS NOT NULL),
uniq AS (
  SELECT task_id, task_name, parent_task_id, trim(project_name) AS project_name, project_gid,
         assignee_name, assignee_gid, completed_at, modified_at, inserted_at, estimated_time,
         actual_time, actual_time_raw, estimated_minutes, actual_minutes, is_subtask
  FROM ranked WHERE rn = 1)"""
)

SNAPSHOT = (
    RAW
    + f""", snap AS (
  SELECT {AS_OF} AS snapshot_date, TIMESTAMP '1998-06-17 07:00:00' AS snapshot_at,
         task_id, task_name, project_gid, project_name, assignee_gid, assignee_name, due_on,
         created_at, modified_at, coalesce(due_on < {AS_OF}, FALSE) AS is_overdue,
         coalesce(estimated_minutes, 0) <> 0 OR coalesce(actual_minutes, 0) <> 0
           AS has_time_fields,
         estimated_minutes, actual_minutes
  FROM raw WHERE completed_at IS NULL)"""
)

PROJECTS = f"""dated AS (
  SELECT o_custkey % 20 AS n, min(o_orderdate) AS first, max(o_orderdate) AS last
  FROM orders GROUP BY 1),
projects AS (
  SELECT 'P' || n AS gid, ' Project ' || n AS name,
         CASE WHEN n % 7 = 0 THEN TRUE WHEN n % 7 <> 1 THEN FALSE END AS archived,
         first, last
  FROM dated)"""

# Parent tasks; minutes follow the way each priority writes its duration.
PARENTS = """parents AS (
  SELECT 'P' || (o_custkey % 20) AS project_gid, ' Project ' || (o_custkey % 20) AS project_name,
         CAST(o_orderkey AS VARCHAR) AS task_id, 'Order ' || o_orderkey AS task_name,
         o_orderstatus = 'F' AS completed,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_hours(o_custkey % 24) END
           AS completed_at,
         o_orderdate AS created_at, o_orderdate + INTERVAL 1 HOUR AS modified_at,
         CASE WHEN o_orderkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) + 7 END AS due_on,
         CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS assignee_gid,
         CASE WHEN o_custkey % 10 <> 0 THEN 'User ' || o_custkey END AS assignee_name,
         CASE WHEN o_custkey % 3 = 0 THEN floor(o_totalprice / 1000) END AS native,
         CASE o_orderpriority[1]
              WHEN '1' THEN floor(o_totalprice / 1000)
              WHEN '2' THEN floor(o_totalprice / 1000) * 60
              WHEN '3' THEN floor(o_totalprice / 1000)
              WHEN '4' THEN floor(o_totalprice / 1000) + 0.5 END AS parsed,
         o_orderkey % 11 <> 0 AS has_subtasks
  FROM orders)"""

ITEMS = (
    PARENTS
    + """, items AS (
  SELECT task_id, task_name, project_gid, project_name, assignee_name, assignee_gid, completed,
         completed_at, created_at, due_on, modified_at,
         CAST(parsed AS DOUBLE) AS est, CAST(coalesce(native, parsed) AS DOUBLE) AS act,
         FALSE AS is_subtask, CAST(NULL AS VARCHAR) AS parent_task_id
  FROM parents
  UNION ALL
  SELECT l_orderkey || '-' || l_linenumber, '[Subtask] ' || p_name, project_gid, project_name,
         CASE WHEN l_suppkey % 10 = 1 THEN '' WHEN l_suppkey % 10 <> 0 THEN s_name END,
         CASE WHEN l_suppkey % 10 <> 0 THEN CAST(l_suppkey AS VARCHAR) END,
         l_linestatus = 'F',
         CASE WHEN l_linestatus = 'F' THEN l_shipdate + to_hours(l_suppkey % 24) END,
         p.created_at,
         CASE WHEN l_partkey % 17 <> 0
              THEN CAST(l_shipdate AS DATE) + CAST(l_partkey % 21 - 10 AS INTEGER) END,
         l_shipdate + to_minutes(l_partkey), NULL,
         CASE WHEN l_discount <> 0 THEN floor(l_extendedprice / 100) END,
         TRUE, p.task_id
  FROM lineitem
  JOIN parents p ON p.task_id = CAST(l_orderkey AS VARCHAR) AND p.has_subtasks
  JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey
  {open_parents_only})"""
)

FLAT_COLUMNS = """task_id, task_name, project_gid AS project_id, project_gid, project_name,
       assignee_name, assignee_gid, completed_at, created_at, due_on, modified_at,
       est AS estimated_time, act / 60.0 AS actual_time, act AS actual_time_raw,
       est AS estimated_minutes, act AS actual_minutes, is_subtask, parent_task_id"""

OPEN_COLUMNS = """task_id, task_name, project_gid, project_name, assignee_gid, assignee_name,
       due_on, created_at, modified_at,
       coalesce(est, 0) <> 0 OR coalesce(act, 0) <> 0 AS has_time_fields,
       est AS estimated_minutes, act AS actual_minutes"""

ALL_ITEMS = ITEMS.format(open_parents_only="")
OPEN_ITEMS = ITEMS.format(open_parents_only="WHERE NOT p.completed")

# Some subtasks were landed several times.
NEWEST_ITEMS = """newest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY modified_at DESC) AS version
    FROM items)
  WHERE version = 1)"""

ENTRIES = f"""entries AS (
  SELECT CAST(event_id AS VARCHAR) AS entry_id, event_id AS number,
         CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS VARCHAR) END AS task_id,
         CASE WHEN event_id % 5 <> 0 THEN 'Task ' || user_id END AS task_name,
         CASE WHEN event_id % 7 <> 0 THEN 'P' || (user_id % 20) END AS project_id,
         CASE WHEN event_id % 7 <> 0 THEN ' Project ' || (user_id % 20) END AS project_name,
         'User ' || user_id AS user_name,
         {_day('ts')} AS entered_on,
         CASE WHEN event_id % 13 <> 0 THEN floor(value) END AS duration_minutes,
         ts AS created_at, ts AS modified_at
  FROM events)"""

ENTRY_COLUMNS = """entry_id, task_id, task_name, project_id, project_name, user_name, entered_on,
       duration_minutes, created_at, modified_at"""

HOURS = """count(task_id) AS tasks_count,
       sum(coalesce(actual_minutes, 0)) / 60.0 AS total_actual_hours,
       sum(coalesce(estimated_minutes, 0)) / 60.0 AS total_estimated_hours"""

NAMED = "assignee_name IS NOT NULL AND assignee_name <> ''"
ALLOWED = "('Supplier#000000002', 'Supplier#000000003', 'Supplier#000000004')"
LEFT = "greatest(coalesce(estimated_minutes, 0) - coalesce(actual_minutes, 0), 0)"


def _label(minutes: str) -> str:
    """Hours and minutes as text; half minutes round to even."""
    whole = f"CAST(round_even(coalesce({minutes}, 0), 0) AS BIGINT)"
    return f"(({whole}) // 60) || '時間' || (({whole}) % 60) || '分'"


def _report(keys: list[str], where: str = "TRUE") -> str:
    names = ", ".join(keys)
    return f"""SELECT {_month('completed_at')} AS month, {names}, {HOURS}
      FROM uniq WHERE {where} GROUP BY ALL"""


def _sheet(keys: dict[str, str], where: str = "TRUE") -> str:
    shown = ", ".join(f'{c} AS "{h}"' for c, h in keys.items())
    return f"""WITH {UNIQUE}, report AS ({_report(list(keys), where)})
      SELECT month AS "対象期間", {shown}, tasks_count AS "完了タスク数",
             round(coalesce(total_actual_hours, 0), 2) AS "合計実績時間",
             round(coalesce(total_estimated_hours, 0), 2) AS "合計見積時間",
             '2002-01-01 00:00:00' AS "最終更新日時"
      FROM report"""


def _top_hours(name: str, where: str) -> str:
    guard = f"AND {NAMED}" if name == "assignee_name" else ""
    return f"""WITH {UNIQUE}
      SELECT {name}, count(task_id) AS tasks, sum(coalesce(actual_minutes, 0)) / 60.0 AS hours
      FROM uniq WHERE {where} {guard}
      GROUP BY 1 ORDER BY hours DESC, {name} ASC NULLS FIRST LIMIT 5"""


def _top_count(name: str) -> str:
    guard = f"WHERE {NAMED}" if name == "assignee_name" else ""
    return f"""WITH {SNAPSHOT}
      SELECT {name}, count(*) AS cnt FROM snap {guard}
      GROUP BY 1 ORDER BY cnt DESC, {name} ASC NULLS FIRST LIMIT 5"""


def _matching(
    name: str, shown: str, where: str, condition: str, tasks: str, minutes: str
) -> str:
    return f"""WITH {SNAPSHOT}
      SELECT {shown} AS {name}, count(CASE WHEN {condition} THEN 1 END) AS {tasks},
             CAST(sum(CASE WHEN {condition} THEN {LEFT} ELSE 0 END) AS DOUBLE) AS {minutes}
      FROM snap WHERE {where} GROUP BY {shown}
      HAVING count(CASE WHEN {condition} THEN 1 END) > 0
      ORDER BY {minutes} DESC, {shown} ASC NULLS FIRST LIMIT 10"""


def _plan(shown: str, where: str) -> str:
    week = "due_on BETWEEN DATE '1998-06-15' AND DATE '1998-06-21'"
    before = "due_on < DATE '1998-06-15'"
    return f"""WITH {SNAPSHOT}
      SELECT {shown} AS assignee_name,
             count(CASE WHEN {week} THEN 1 END) AS this_week_tasks,
             CAST(sum(CASE WHEN {week} THEN {LEFT} ELSE 0 END) AS DOUBLE)
               AS this_week_remaining_minutes,
             count(CASE WHEN {before} THEN 1 END) AS prev_overdue_tasks,
             CAST(sum(CASE WHEN {before} THEN {LEFT} ELSE 0 END) AS DOUBLE)
               AS prev_overdue_remaining_minutes
      FROM snap WHERE {where} GROUP BY {shown}"""


DAILY = f"""{UNIQUE}, days AS (
  SELECT {_day('completed_at')} AS d, count(task_id) AS tasks,
         sum(coalesce(actual_minutes, 0)) / 60.0 AS hours
  FROM uniq GROUP BY 1),
recent AS (
  SELECT * FROM days
  WHERE d BETWEEN {AS_OF} - 30 AND {AS_OF} - 1 AND dayofweek(d) NOT IN (0, 6)
  ORDER BY d DESC LIMIT 7),
base AS (SELECT avg(tasks) AS avg_tasks, avg(hours) AS avg_hours FROM recent),
today AS (
  SELECT count(task_id) AS tasks_count,
         coalesce(sum(coalesce(actual_minutes, 0)), 0) / 60.0 AS total_hours,
         coalesce(sum(coalesce(estimated_minutes, 0)), 0) / 60.0 AS estimated_hours
  FROM uniq WHERE {_day('completed_at')} = {AS_OF}),
so_far AS (
  SELECT coalesce(sum(coalesce(actual_minutes, 0)), 0) / 60.0 AS mtd_hours,
         count(task_id) AS mtd_tasks
  FROM uniq WHERE {_day('completed_at')} BETWEEN DATE '1998-06-01' AND {AS_OF}),
compared AS (
  SELECT tasks_count, total_hours, estimated_hours, mtd_hours, mtd_tasks,
         coalesce(avg_tasks, 0) AS avg_tasks, coalesce(avg_hours, 0) AS avg_hours,
         CASE WHEN avg_tasks >= 1
              THEN round_even((tasks_count - avg_tasks) / avg_tasks * 100.0, 1) END AS tasks_vs,
         CASE WHEN avg_hours >= 1
              THEN round_even((total_hours - avg_hours) / avg_hours * 100.0, 1) END AS hours_vs
  FROM today, base, so_far),
figures AS (
  SELECT *, coalesce(abs(tasks_vs) >= 50, FALSE) OR coalesce(abs(hours_vs) >= 50, FALSE) AS warn
  FROM compared)"""


def _verify(where: str = "TRUE") -> str:
    return f"""WITH {UNIQUE}, chosen AS (
        SELECT * FROM uniq
        WHERE project_name = 'Brand#11' AND assignee_name = 'Supplier#000000003' AND {where}),
      total AS (
        SELECT count(*) AS tasks_count,
               sum(coalesce(actual_time, 0.0)) AS total_actual_hours,
               sum(coalesce(estimated_time, 0.0)) AS total_estimated_minutes
        FROM chosen)
      SELECT * REPLACE (round(total_actual_hours, 6) AS total_actual_hours),
             {_label('total_actual_hours * 60')} AS actual_label,
             {_label('total_estimated_minutes')} AS estimated_label
      FROM total"""


def _dim(key: str, name: str, expression: str, existing: str, kept: str, added: str) -> str:
    return f"""WITH {UNIQUE}, seen AS (
        SELECT {key}, max({expression}) AS seen_name FROM uniq
        WHERE {key} IS NOT NULL AND {key} <> '' GROUP BY 1),
      existing AS ({existing})
      SELECT coalesce(e.{key}, s.{key}) AS {key},
             CASE WHEN s.{key} IS NULL THEN 'old' ELSE s.seen_name END AS {name}, {kept}
             s.{key} IS NOT NULL AS active,
             CASE WHEN e.{key} IS NULL THEN {added} ELSE TIMESTAMP '1990-01-01' END AS created_at,
             CASE WHEN s.{key} IS NULL THEN TIMESTAMP '1990-01-01' ELSE {added} END AS updated_at
      FROM existing e FULL OUTER JOIN seen s ON e.{key} = s.{key}"""


RUN_TS = "TIMESTAMP '2002-01-01'"

RAW_COLUMNS = [
    "task_id", "task_name", "project_id", "project_name", "assignee_name", "completed_at",
    "created_at", "due_on", "modified_at", "inserted_at", "estimated_time", "actual_time",
    "actual_time_raw", "is_subtask", "parent_task_id", "project_gid", "assignee_gid",
    "estimated_minutes", "actual_minutes",
]
KEPT = ["project_gid", "assignee_gid", "estimated_minutes", "actual_minutes"]


def _merge(where: str = "TRUE") -> str:
    def side(name: str, test: str) -> str:
        return f"""{name} AS (
          SELECT * FROM (
            SELECT *, row_number() OVER (
              PARTITION BY task_id
              ORDER BY coalesce(modified_at, inserted_at) DESC, inserted_at DESC, project_gid,
                       coalesce(assignee_gid, ''), task_name) AS rn
            FROM raw WHERE modified_at {test} TIMESTAMP '1999-01-01' AND {where}) WHERE rn = 1)"""

    columns = ", ".join(
        f"coalesce(s.{c}, t.{c}) AS {c}"
        if c in KEPT or c == "task_id"
        else f"CASE WHEN s.task_id IS NULL THEN t.{c} ELSE s.{c} END AS {c}"
        for c in RAW_COLUMNS
    )
    return f"""WITH {RAW}, {side('target', '<')}, {side('batch', '>=')}
      SELECT {columns} FROM target t FULL OUTER JOIN batch s ON t.task_id = s.task_id"""


def _first_number(text: str) -> str:
    return f"TRY_CAST(regexp_extract({text}, '[-+]?[0-9]*\\.?[0-9]+') AS DOUBLE)"


SNAPSHOT_COLUMNS = """snapshot_date, snapshot_at, task_id, task_name, project_gid, project_name,
       assignee_gid, assignee_name, due_on, created_at, modified_at, is_overdue,
       has_time_fields, estimated_minutes, actual_minutes"""

YESTERDAY_SNAPSHOT = """SELECT * REPLACE (DATE '1998-06-16' AS snapshot_date,
         TIMESTAMP '1998-06-16 07:00:00' AS snapshot_at) FROM snap"""

STATEMENTS: dict[str, str] = {
    "active_projects": f"WITH {PROJECTS} SELECT gid, name FROM projects WHERE archived IS NOT TRUE",
    "project_filter": f"""WITH {PROJECTS} SELECT gid, name FROM projects
      WHERE archived IS NOT TRUE AND contains(name, 'Project 1')""",
    "project_directory": f"""WITH {PROJECTS}
      SELECT name AS project_name, gid AS project_gid, first AS created_at, last AS modified_at,
             CASE archived WHEN TRUE THEN 'アーカイブ済み' WHEN FALSE THEN 'アクティブ' END
               AS archive_state
      FROM projects""",
    "project_tasks": f"""WITH {PROJECTS}, {PARENTS}
      SELECT project_gid, count(*) AS tasks FROM parents
      WHERE project_gid IN (SELECT gid FROM projects WHERE archived IS NOT TRUE) GROUP BY 1""",
    "sync_watermark": f"""WITH {RAW}
      SELECT strftime(max(modified_at), '%Y-%m-%dT%H:%M:%S.%gZ') AS last_modified FROM raw""",
    "jst_day_start": """SELECT o_orderkey,
             strftime(o_orderdate, '%Y-%m-%d')
               || CASE WHEN o_orderkey % 13 = 0 THEN 'T00' ELSE '' END AS date_jst,
             CASE WHEN o_orderkey % 13 <> 0
                  THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) - INTERVAL 9 HOUR END
               AS start_utc
      FROM orders""",
    "completed_since_scan": f"""WITH {PARENTS}
      SELECT task_id AS gid, completed, {_iso('completed_at')} AS completed_at FROM parents
      WHERE NOT completed OR completed_at >= TIMESTAMP '1998-01-01'""",
    "modified_since_scan": f"""WITH {PARENTS}
      SELECT task_id AS gid, completed, {_iso('modified_at')} AS modified_at FROM parents
      WHERE NOT completed OR modified_at >= TIMESTAMP '1998-01-01'""",
    "completed_tasks_flat": f"""WITH {ALL_ITEMS}
      SELECT {FLAT_COLUMNS} FROM items WHERE completed AND completed_at IS NOT NULL""",
    "completed_tasks_with_incomplete_subtasks": f"""WITH {ALL_ITEMS}
      SELECT {FLAT_COLUMNS} FROM items
      WHERE is_subtask OR (completed AND completed_at IS NOT NULL)""",
    "open_tasks": f"WITH {OPEN_ITEMS} SELECT {OPEN_COLUMNS} FROM items WHERE NOT completed",
    "open_tasks_overdue": f"""WITH {OPEN_ITEMS}, listed AS (
        SELECT {OPEN_COLUMNS} FROM items WHERE NOT completed)
      SELECT *, {AS_OF} AS snapshot_date, TIMESTAMP '1998-06-17 07:00:00' AS snapshot_at,
             coalesce(due_on < {AS_OF}, FALSE) AS is_overdue
      FROM listed""",
    "duration_parse": f"WITH {PARENTS} SELECT task_id AS gid, CAST(parsed AS DOUBLE) AS minutes FROM parents",
    "duration_parse_prose": f"""SELECT doc_id, CASE
             WHEN contains(lower(text), 'h') OR contains(text, '時間')
             THEN {_first_number('text')} * 60.0 ELSE {_first_number('text')} END AS minutes
      FROM documents""",
    "custom_field_effort": f"""WITH {PARENTS}
      SELECT task_id AS gid, CAST(parsed AS DOUBLE) AS estimated_time,
             CAST(coalesce(native, parsed) AS DOUBLE) / 60.0 AS actual_time,
             CAST(coalesce(native, parsed) AS DOUBLE) AS actual_time_raw
      FROM parents""",
    "time_entries_range": f"""WITH {ENTRIES}
      SELECT entry_id AS gid, CAST(entered_on AS VARCHAR) AS entered_on, duration_minutes
      FROM entries WHERE entered_on BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'""",
    "time_entries_of_project": f"""WITH {ENTRIES}
      SELECT entry_id AS gid, CAST(entered_on AS VARCHAR) AS entered_on, duration_minutes
      FROM entries
      WHERE entered_on BETWEEN DATE '2024-01-03' AND DATE '2024-01-09' AND project_id = 'P3'""",
    "time_entries_yesterday": f"""WITH {ENTRIES}
      SELECT entry_id AS gid, CAST(entered_on AS VARCHAR) AS entered_on, duration_minutes
      FROM entries WHERE entered_on = DATE '2024-01-09'""",
    "time_entries_flat": f"WITH {ENTRIES} SELECT {ENTRY_COLUMNS} FROM entries",
    "stage_batch": f"""WITH {ALL_ITEMS}
      SELECT {FLAT_COLUMNS}, {RUN_TS} AS inserted_at
      FROM items WHERE completed AND completed_at IS NOT NULL""",
    "batch_dedup": f"""WITH {RAW}, numbered AS (
        SELECT *, row_number() OVER (
          PARTITION BY task_id
          ORDER BY coalesce(modified_at, inserted_at) DESC, inserted_at DESC, project_gid,
                   coalesce(assignee_gid, ''), task_name) AS rn
        FROM raw)
      SELECT * EXCLUDE (rn) FROM numbered WHERE rn = 1""",
    "merge_upsert": _merge(),
    "stored_merge": _merge(),
    "streamed_upsert": f"""WITH {PROJECTS}, {ALL_ITEMS}, {NEWEST_ITEMS}
      SELECT {FLAT_COLUMNS}, {RUN_TS} AS inserted_at
      FROM newest WHERE completed AND completed_at IS NOT NULL
        AND project_gid IN (SELECT gid FROM projects WHERE archived IS NOT TRUE)""",
    "streamed_late_subtasks": f"""WITH {PROJECTS}, {ALL_ITEMS}, {NEWEST_ITEMS}
      SELECT {FLAT_COLUMNS}, {RUN_TS} AS inserted_at
      FROM newest WHERE completed AND completed_at IS NOT NULL
        AND project_gid IN (SELECT gid FROM projects WHERE archived IS NOT TRUE)""",
    # Each version of a line that is complete counts, whatever the project.
    "stream_metrics": f"""WITH {ALL_ITEMS}
      SELECT CAST(2 AS BIGINT) AS batches, count(*) AS tasks_processed,
             CAST(0 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS refused
      FROM items WHERE completed AND completed_at IS NOT NULL""",
    # Late lines count where their order is open, or was completed after all that was held.
    "synced_late_subtasks": f"""WITH {PROJECTS}, {ALL_ITEMS}, wanted AS (
        SELECT * FROM items
        WHERE project_gid IN (SELECT gid FROM projects WHERE archived IS NOT TRUE)),
      landed AS (
        SELECT *, is_subtask AND TRY_CAST(split_part(task_id, '-', 2) AS INTEGER) % 2 = 0 AS late,
               row_number() OVER (PARTITION BY task_id ORDER BY modified_at DESC) AS version
        FROM wanted),
      done AS (SELECT * FROM landed WHERE version = 1 AND completed AND completed_at IS NOT NULL),
      mark AS (SELECT max(modified_at) AS held FROM done WHERE NOT late)
      SELECT d.task_id, d.parent_task_id, d.project_gid, d.completed_at, d.is_subtask
      FROM done d LEFT JOIN parents p ON d.parent_task_id = p.task_id, mark
      WHERE NOT late OR NOT p.completed OR p.completed_at >= held""",
    "synced_entries": f"""WITH {ENTRIES}
      SELECT entry_id AS gid, CAST(entered_on AS VARCHAR) AS entered_on, duration_minutes
      FROM entries WHERE entered_on BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'""",
    "quarantined_lines": """
      SELECT 'tasks' AS source, 'not readable' AS reason, count(*) AS copies
      FROM orders WHERE o_orderkey % 50 = 0
      UNION ALL
      SELECT 'subtasks', 'no key', count(*) FROM lineitem WHERE l_orderkey % 70 = 0""",
    "minutes_backfill": f"""WITH {RAW}, holes AS (
        SELECT task_id, modified_at, estimated_time, actual_time,
               CASE WHEN line <> 3 THEN actual_time_raw END AS actual_time_raw,
               CASE WHEN line % 2 <> 0 THEN estimated_minutes END AS estimated_minutes,
               CASE WHEN line % 3 <> 0 THEN actual_minutes END AS actual_minutes
        FROM (SELECT *, CAST(split_part(task_id, '-', 2) AS INTEGER) AS line FROM raw))
      SELECT * REPLACE (
        coalesce(estimated_minutes, estimated_time) AS estimated_minutes,
        coalesce(actual_minutes, actual_time_raw, actual_time * 60.0) AS actual_minutes)
      FROM holes""",
    "snapshot_append": f"""WITH {SNAPSHOT}
      SELECT {SNAPSHOT_COLUMNS} FROM snap UNION ALL SELECT {SNAPSHOT_COLUMNS} FROM snap
      UNION ALL SELECT {SNAPSHOT_COLUMNS} FROM ({YESTERDAY_SNAPSHOT})""",
    "snapshot_replace": f"""WITH {SNAPSHOT}
      SELECT {SNAPSHOT_COLUMNS} FROM snap
      UNION ALL SELECT {SNAPSHOT_COLUMNS} FROM ({YESTERDAY_SNAPSHOT})""",
    "snapshot_of_landings": f"""WITH {PROJECTS}, {OPEN_ITEMS}, {NEWEST_ITEMS}, listed AS (
        SELECT {OPEN_COLUMNS} FROM newest WHERE NOT completed
          AND project_gid IN (SELECT gid FROM projects WHERE archived IS NOT TRUE))
      SELECT *, {AS_OF} AS snapshot_date, TIMESTAMP '1998-06-17 07:00:00' AS snapshot_at,
             coalesce(due_on < {AS_OF}, FALSE) AS is_overdue
      FROM listed""",
    "stored_rewrite": f"""WITH {RAW}, numbered AS (
        SELECT *, row_number() OVER (
          PARTITION BY task_id
          ORDER BY coalesce(modified_at, inserted_at) DESC, inserted_at DESC, project_gid,
                   coalesce(assignee_gid, ''), task_name) AS rn
        FROM raw)
      SELECT * EXCLUDE (rn) REPLACE (
        coalesce(estimated_minutes, estimated_time) AS estimated_minutes,
        coalesce(actual_time_raw, actual_time * 60.0) AS actual_minutes)
      FROM numbered WHERE rn = 1""",
    "stored_entries": f"WITH {ENTRIES} SELECT {ENTRY_COLUMNS} FROM entries",
    "time_entries_upsert": f"""WITH {ENTRIES}, parts AS (
        SELECT *, TIMESTAMP '2024-02-01' AS inserted_at FROM entries
        WHERE number % 2 = 0 AND number % 3 <> 0
        UNION ALL
        SELECT * REPLACE (modified_at + INTERVAL 1 HOUR AS modified_at,
                          duration_minutes + 5 AS duration_minutes),
               {RUN_TS} AS inserted_at
        FROM entries WHERE number % 3 = 0)
      SELECT {ENTRY_COLUMNS}, coalesce(duration_minutes, 0) / 60.0 AS duration_hours, inserted_at
      FROM parts""",
    "dim_projects": _dim(
        "project_gid",
        "project_name",
        "trim(project_name)",
        """SELECT DISTINCT CASE WHEN CAST(split_part(p_brand, '#', 2) AS INTEGER) % 2 = 0
             THEN p_brand ELSE 'gone-' || p_brand END AS project_gid FROM part""",
        "",
        RUN_TS,
    ),
    "dim_users": _dim(
        "assignee_gid",
        "assignee_name",
        "assignee_name",
        """SELECT CAST(s_suppkey AS VARCHAR) AS assignee_gid FROM supplier
           WHERE s_suppkey % 4 = 0""",
        """CASE WHEN e.assignee_gid IS NOT NULL THEN 'U' || e.assignee_gid END AS slack_user_id,
             CASE WHEN e.assignee_gid IS NOT NULL THEN CAST(7.5 AS DOUBLE) END
               AS work_hours_per_day,""",
        RUN_TS,
    ),
    "schema_evolve": f"""WITH {RAW}
      SELECT * REPLACE (CAST(NULL AS VARCHAR) AS project_gid, CAST(NULL AS VARCHAR) AS assignee_gid,
                        CAST(NULL AS DOUBLE) AS estimated_minutes,
                        CAST(NULL AS DOUBLE) AS actual_minutes) FROM raw""",
    "report_project_sheet": _sheet({"project_name": "プロジェクト名"}),
    "report_assignee_sheet": _sheet({"assignee_name": "担当者名"}, NAMED),
    "report_project_assignee_sheet": _sheet(
        {"project_name": "プロジェクト名", "assignee_name": "担当者名"}, NAMED
    ),
    "run_metrics": f"""WITH {ALL_ITEMS}
      SELECT count(*) AS tasks_processed, count(CASE WHEN task_id IS NULL THEN 1 END) AS errors,
             {RUN_TS} AS started_at, TIMESTAMP '2002-01-01 00:09:00' AS finished_at
      FROM items WHERE completed AND completed_at IS NOT NULL""",
    "unique_tasks": f"WITH {UNIQUE} SELECT * FROM uniq",
    "unique_tasks_daily": f"""WITH {UNIQUE}
      SELECT task_id, project_name, project_gid, assignee_name, assignee_gid,
             {_day('completed_at')} AS completed_date_jst, estimated_minutes, actual_minutes
      FROM uniq""",
    "report_project": f"WITH {UNIQUE} {_report(['project_name'])}",
    "report_assignee": f"WITH {UNIQUE} {_report(['assignee_name'], NAMED)}",
    "report_project_assignee": f"""WITH {UNIQUE}
      {_report(['project_name', 'assignee_name'], NAMED)}""",
    "latest_month": f"WITH {UNIQUE} SELECT {_month('max(completed_at)')} AS month FROM uniq",
    "monthly_kpi": f"""WITH {UNIQUE}
      SELECT '1998-06' AS month, {HOURS} FROM uniq WHERE {_month('completed_at')} = '1998-06'""",
    "monthly_kpi_latest": f"""WITH {UNIQUE}, dated AS (
        SELECT *, {_month('completed_at')} AS month FROM uniq)
      SELECT month, {HOURS} FROM dated
      WHERE month = (SELECT max(month) FROM dated) GROUP BY month""",
    "monthly_top_projects": _top_hours(
        "project_name", f"{_month('completed_at')} = '1998-06'"
    ),
    "monthly_top_assignees": _top_hours(
        "assignee_name", f"{_month('completed_at')} = '1998-06'"
    ),
    "monthly_top_projects_latest": _top_hours(
        "project_name",
        f"{_month('completed_at')} = (SELECT {_month('max(completed_at)')} FROM uniq)",
    ),
    "monthly_top_assignees_latest": _top_hours(
        "assignee_name",
        f"{_month('completed_at')} = (SELECT {_month('max(completed_at)')} FROM uniq)",
    ),
    "daily_kpi": f"""WITH {UNIQUE}
      SELECT count(task_id) AS tasks_count,
             sum(coalesce(actual_minutes, 0)) / 60.0 AS total_hours,
             sum(coalesce(estimated_minutes, 0)) / 60.0 AS estimated_hours
      FROM uniq WHERE {_day('completed_at')} = {AS_OF}""",
    "business7_baseline": f"WITH {DAILY} SELECT avg_tasks, round(avg_hours, 6) AS avg_hours FROM base",
    "daily_deviation": f"""WITH {DAILY}
      SELECT tasks_count, total_hours, avg_tasks, round(avg_hours, 6) AS avg_hours, tasks_vs,
             hours_vs, warn
      FROM figures""",
    "daily_top_projects": _top_hours("project_name", f"{_day('completed_at')} = {AS_OF}"),
    "daily_top_assignees": _top_hours("assignee_name", f"{_day('completed_at')} = {AS_OF}"),
    "mtd": f"WITH {DAILY} SELECT mtd_hours, mtd_tasks FROM so_far",
    "daily_digest": f"""WITH {DAILY}
      SELECT CAST({AS_OF} AS VARCHAR) AS day,
             CASE WHEN tasks_count = 0 AND total_hours = 0 THEN 'mtd_only' ELSE 'normal' END
               AS mode,
             tasks_count, round(total_hours, 2) AS total_hours,
             round(estimated_hours, 2) AS estimated_hours, round(mtd_hours, 2) AS mtd_hours,
             mtd_tasks, tasks_vs, hours_vs,
             tasks_count > 0 AND tasks_vs IS NOT NULL AND hours_vs IS NOT NULL
               AS comparison_shown,
             tasks_count > 0 AND warn AS warn
      FROM figures""",
    "open_kpi": f"""WITH {SNAPSHOT}
      SELECT count(*) AS open_count,
             CAST(sum(CASE WHEN is_overdue THEN 1 ELSE 0 END) AS BIGINT) AS overdue
      FROM snap""",
    "open_top_projects": _top_count("project_name"),
    "open_top_assignees": _top_count("assignee_name"),
    "week_bounds": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
             CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS ws,
             CAST(CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS VARCHAR) AS we
      FROM orders""",
    "weekly_assignee_plan": _plan("trim(assignee_name)", f"trim(assignee_name) IN {ALLOWED}"),
    "weekly_assignee_plan_with_unassigned": _plan(
        "coalesce(nullif(trim(assignee_name), ''), '(未割当)')",
        f"coalesce(trim(assignee_name), '') IN ('', {ALLOWED[1:]}",
    ),
    "project_overdue": _matching(
        "project_name", "project_name", "TRUE", "is_overdue", "overdue_tasks",
        "overdue_remaining_minutes",
    ),
    "assignee_overdue": _matching(
        "assignee_name", "trim(assignee_name)", f"trim(assignee_name) IN {ALLOWED}",
        "is_overdue", "overdue_tasks", "overdue_remaining_minutes",
    ),
    "due_unset": _matching(
        "assignee_name", "trim(assignee_name)", f"trim(assignee_name) IN {ALLOWED}",
        "due_on IS NULL", "due_unset_tasks", "due_unset_remaining_minutes",
    ),
    "verify_overall": _verify(),
    "verify_month_completed": _verify(f"{_month('completed_at')} = '1998-06'"),
    "verify_month_modified": _verify(f"{_month('modified_at')} = '1998-06'"),
    "verify_task_ids": _verify(
        """(task_id IN (SELECT o_orderkey || '-1' FROM orders WHERE o_orderpriority = '1-URGENT')
            OR parent_task_id IN
              (SELECT o_orderkey || '-1' FROM orders WHERE o_orderpriority = '1-URGENT'))"""
    ),
    "verify_details": f"""WITH {UNIQUE}
      SELECT task_id, task_name, estimated_time AS estimated_minutes,
             actual_time_raw AS actual_minutes, {_label('estimated_time')} AS estimated_label,
             {_label('actual_time_raw')} AS actual_label, completed_at,
             {_month('completed_at')} AS completed_month, modified_at,
             {_month('modified_at')} AS modified_month,
             {_month('completed_at')} = '1998-06' AS within_month
      FROM uniq WHERE project_name = 'Brand#11' AND assignee_name = 'Supplier#000000003'""",
    "hm_format": f"""SELECT l_orderkey, l_linenumber,
             {_label('CASE WHEN l_tax <> 0 THEN l_quantity * 2.5 END')} AS estimated_label,
             {_label('CASE WHEN l_discount <> 0 THEN floor(l_extendedprice / 100) END')}
               AS actual_label
      FROM lineitem""",
    "assignee_quality": f"""WITH {RAW}
      SELECT count(*) AS total_rows,
             count(CASE WHEN assignee_name IS NULL THEN 1 END) AS null_assignees,
             count(CASE WHEN assignee_name = '' THEN 1 END) AS empty_string_assignees,
             count(CASE WHEN assignee_name <> '' THEN 1 END) AS valid_assignees
      FROM raw""",
    "assignee_sample": f"""WITH {RAW}
      SELECT DISTINCT assignee_name FROM raw WHERE {NAMED} ORDER BY 1 LIMIT 10""",
}

# The same results through stored tables and published files.
STATEMENTS["stored_daily_digest"] = STATEMENTS["daily_digest"]
STATEMENTS["stored_monthly_latest"] = STATEMENTS["monthly_kpi_latest"]
STATEMENTS["published_report"] = STATEMENTS["report_project_sheet"]
STATEMENTS["published_report_assignee"] = STATEMENTS["report_assignee_sheet"]
STATEMENTS["published_report_project_assignee"] = STATEMENTS["report_project_assignee_sheet"]
STATEMENTS["refreshed_report"] = f"""WITH uniq AS (
        SELECT * REPLACE (trim(project_name) AS project_name)
        FROM ({_merge('completed_at IS NOT NULL')}))
      {_report(['project_name', 'assignee_name'], NAMED)}"""
