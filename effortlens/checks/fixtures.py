"""The shared test tables read as work-log inputs.

Only the joins that the requested columns need are made, so a query that never shows
a task's creation instant does not touch ``orders``.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from effortlens.functions.timeutil import local_day, ntz_literal
from effortlens.plans.warehouse import Landing
from effortlens.session import checkpoint_folder, freed_shuffles

AS_OF = date(1998, 6, 17)
MONTH = "1998-06"
RUN_TS = datetime(2002, 1, 1)
MERGE_SPLIT = datetime(1999, 1, 1)
ALLOWED = ["Supplier#000000002", "Supplier#000000003", "Supplier#000000004"]
PERSON = "Supplier#000000003"
PROJECT = "Brand#11"
CUTOFF = datetime(1998, 1, 1)
ENTRY_DAYS = (date(2024, 1, 3), date(2024, 1, 9))

_FROM_PART = {"task_name", "project_id", "project_gid", "project_name"}
_FROM_SUPPLIER = {"assignee_name"}
_FROM_ORDERS = {"created_at"}


# Declared, so that no query starts with a job that infers a schema from a file.
_SCHEMAS = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder in the cluster's shared checkpoint folder, below the warehouse without it."""
    name = f"checks-{uuid.uuid4().hex}"
    try:
        return checkpoint_folder(spark, name)
    except ValueError:
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}"


def _ntz_plus_minutes(instant: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, instant)


def _task_id() -> Column:
    line = F.col("l_linenumber").cast("string")
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), line)


def _due_on() -> Column:
    day = F.to_date("l_shipdate")
    shift = (F.col("l_partkey") % 21 - 10).cast("int")
    return F.when(F.col("l_partkey") % 17 != 0, F.date_add(day, shift))


def _completed_at() -> Column:
    hours = F.timestamp_add("HOUR", F.col("l_suppkey") % 24, F.col("l_shipdate"))
    return F.when(F.col("l_linestatus") == "F", hours)


def _modified_at() -> Column:
    return _ntz_plus_minutes(F.col("l_shipdate"), F.col("l_partkey"))


def _actual() -> Column:
    whole = F.floor(F.col("l_extendedprice") / 100).cast("double")
    return F.when(F.col("l_discount") != 0, whole)


def _assignee_gid() -> Column:
    return F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey").cast("string"))


def _assignee_name() -> Column:
    turn = F.col("l_suppkey") % 10
    return F.when(turn == 1, "").when(turn != 0, F.col("s_name"))


def _estimate() -> Column:
    return F.when(F.col("l_tax") != 0, F.col("l_quantity") * 10)


def _inserted_at() -> Column:
    return _ntz_plus_minutes(F.col("l_shipdate"), F.col("l_partkey") + F.col("l_suppkey"))


def _parent() -> Column:
    first = F.concat(F.col("l_orderkey").cast("string"), F.lit("-1"))
    return F.when(F.col("l_linenumber") > 1, first)


_TASK_COLUMNS = {
    "task_id": _task_id,
    "task_name": lambda: F.col("p_name"),
    "project_id": lambda: F.col("p_brand"),
    "project_name": lambda: F.concat(F.lit(" "), F.col("p_brand"), F.lit(" ")),
    "assignee_name": _assignee_name,
    "completed_at": _completed_at,
    "created_at": lambda: F.col("o_orderdate"),
    "due_on": _due_on,
    "modified_at": _modified_at,
    "inserted_at": _inserted_at,
    "estimated_time": _estimate,
    "actual_time": lambda: _actual() / 60.0,
    "actual_time_raw": _actual,
    "is_subtask": lambda: F.col("l_linenumber") > 1,
    "parent_task_id": _parent,
    "project_gid": lambda: F.col("p_brand"),
    "assignee_gid": _assignee_gid,
    "estimated_minutes": _estimate,
    "actual_minutes": _actual,
}


def raw_tasks(
    spark: SparkSession, sf_dir: str, columns: list[str] | None = None
) -> DataFrame:
    """Every stored version of every task; all columns unless some are named."""
    wanted = set(columns or _TASK_COLUMNS)
    lines = table(spark, sf_dir, "lineitem")
    if wanted & _FROM_PART:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    # After this join versions of a task lie together, which the ranking's shuffle gains from.
    if wanted & _FROM_ORDERS:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if wanted & _FROM_SUPPLIER:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
        lines = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.select(*[make().alias(n) for n, make in _TASK_COLUMNS.items() if n in wanted])


def completed_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions with every column the latest-version view shows."""
    everything = [c for c in _TASK_COLUMNS if c not in ("created_at", "due_on")]
    return raw_tasks(spark, sf_dir, everything)


def legacy_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions with holes in the minute columns, so that each older column is used."""
    line = F.substring_index("task_id", "-", -1).cast("int")
    tasks = raw_tasks(spark, sf_dir, ["task_id", "modified_at", "estimated_time",
                                      "actual_time", "actual_time_raw",
                                      "estimated_minutes", "actual_minutes"])
    return tasks.withColumns(
        {
            "estimated_minutes": F.when(line % 2 != 0, F.col("estimated_minutes")),
            "actual_minutes": F.when(line % 3 != 0, F.col("actual_minutes")),
            "actual_time_raw": F.when(line != 3, F.col("actual_time_raw")),
        }
    )


def open_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions without completion, as the snapshot taken on ``AS_OF``."""
    tasks = raw_tasks(
        spark,
        sf_dir,
        ["task_id", "task_name", "project_gid", "project_name", "assignee_gid",
         "assignee_name", "completed_at", "due_on", "created_at", "modified_at",
         "estimated_minutes", "actual_minutes"],
    )
    return tasks.filter(F.col("completed_at").isNull()).drop("completed_at")


def iso(instant: Column) -> Column:
    """A UTC instant as landed text."""
    return F.concat(F.replace(instant.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Project payloads from the customers' numbers; one archived in seven."""
    orders = table(spark, sf_dir, "orders")
    dated = orders.groupBy((F.col("o_custkey") % 20).alias("n")).agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    number = F.col("n").cast("string")
    return dated.select(
        F.concat(F.lit("P"), number).alias("gid"),
        F.concat(F.lit(" Project "), number).alias("name"),
        F.when(F.col("n") % 7 == 0, True).when(F.col("n") % 7 != 1, False).alias("archived"),
        iso(F.col("first")).alias("created_at"),
        iso(F.col("last")).alias("modified_at"),
    )


def _custom_fields() -> Column:
    amount = F.floor(F.col("o_totalprice") / 1000)
    digits = amount.cast("string")
    kind = F.substring("o_orderpriority", 1, 1)
    number = F.when(kind == "1", amount.cast("double"))
    text = (
        F.when(kind == "2", F.concat(digits, F.lit("h")))
        .when(kind == "3", F.concat(F.lit("約"), digits, F.lit("分")))
        .when(kind == "4", "")
        .when(kind == "5", "n/a")
    )
    display = F.when(kind == "4", F.concat(digits, F.lit(".5 min")))

    def field(name: str) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            number.alias("number_value"),
            text.alias("text_value"),
            display.alias("display_value"),
        )

    return F.array(field("Estimate"), field("実績"))


def task_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task payloads from ``orders``; subtasks are landed apart, see below."""
    return payloads_of(table(spark, sf_dir, "orders"))


def order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a stream of files; a source path must be a folder or a pattern."""
    return spark.readStream.schema(_SCHEMAS["orders"]).parquet(f"{sf_dir}/orders.parque[t]")


def payloads_of(orders: DataFrame) -> DataFrame:
    """Orders, at rest or streamed, in the shape of task payloads.

    ``num_subtasks`` only says whether there are any, since nothing reads more of it;
    it denies them for one order in eleven.
    """
    is_done = F.col("o_orderstatus") == "F"
    customer = F.col("o_custkey").cast("string")
    number = (F.col("o_custkey") % 20).cast("string")
    person = F.struct(customer.alias("gid"), F.concat(F.lit("User "), customer).alias("name"))
    done_at = F.timestamp_add("HOUR", F.col("o_custkey") % 24, F.col("o_orderdate"))
    due = F.date_add(F.to_date("o_orderdate"), 7).cast("string")
    return orders.select(
        F.concat(F.lit("P"), number).alias("project_gid"),
        F.concat(F.lit(" Project "), number).alias("project_name"),
        F.col("o_orderkey").cast("string").alias("gid"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("name"),
        is_done.alias("completed"),
        F.when(is_done, iso(done_at)).alias("completed_at"),
        iso(F.col("o_orderdate")).alias("created_at"),
        F.when(F.col("o_orderkey") % 23 == 0, "TBD").otherwise(due).alias("due_on"),
        iso(F.timestamp_add("HOUR", F.lit(1), F.col("o_orderdate"))).alias("modified_at"),
        F.when(F.col("o_custkey") % 10 != 0, person).alias("assignee"),
        F.when(
            F.col("o_custkey") % 3 == 0, F.floor(F.col("o_totalprice") / 1000).cast("double")
        ).alias("actual_time_minutes"),
        _custom_fields().alias("custom_fields"),
        F.when(F.col("o_orderkey") % 11 == 0, 0).otherwise(1).alias("num_subtasks"),
    )


def line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a stream of files; see ``order_stream``."""
    return spark.readStream.schema(_SCHEMAS["lineitem"]).parquet(f"{sf_dir}/lineitem.parque[t]")


def subtask_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subtask payloads from ``lineitem``, one row each with the parent's id."""
    return subtasks_of(spark, sf_dir, table(spark, sf_dir, "lineitem"))


def subtasks_of(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines, at rest or streamed, in the shape of detached subtasks."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    fields = "array<struct<name:string,number_value:double,text_value:string,display_value:string>>"
    return lines.select(
        F.col("l_orderkey").cast("string").alias("parent_gid"),
        _task_id().alias("gid"),
        F.col("p_name").alias("name"),
        (F.col("l_linestatus") == "F").alias("completed"),
        iso(_completed_at()).alias("completed_at"),
        iso(F.col("o_orderdate")).alias("created_at"),
        _due_on().cast("string").alias("due_on"),
        iso(_modified_at()).alias("modified_at"),
        F.when(
            _assignee_gid().isNotNull(),
            F.struct(_assignee_gid().alias("gid"), _assignee_name().alias("name")),
        ).alias("assignee"),
        _actual().alias("actual_time_minutes"),
        F.array().cast(fields).alias("custom_fields"),
    )


def _land(rows: DataFrame, folder: str) -> None:
    """Add JSON lines to a landing folder, packed as they are sent."""
    with freed_shuffles(rows.sparkSession):
        rows.write.mode("append").option("compression", "gzip").json(folder)


def landed_twice(spark: SparkSession, sf_dir: str, folder: str) -> Landing:
    """Landing folders with two versions of each project and order.

    In the first one every project is active and every order open.
    """
    long_ago = F.lit("1970-01-01T00:00:00Z")
    listed, tasks = projects(spark, sf_dir), task_payloads(spark, sf_dir)
    first = tasks.withColumns(
        {
            "completed": F.lit(False),
            "completed_at": F.lit(None).cast("string"),
            "modified_at": long_ago,
        }
    )
    older = listed.withColumns({"archived": F.lit(False), "modified_at": long_ago})
    for name, versions in (("projects", (older, listed)), ("tasks", (first, tasks))):
        for rows in versions:
            _land(rows, f"{folder}/{name}")
    _land(subtask_payloads(spark, sf_dir), f"{folder}/subtasks")
    return Landing(f"{folder}/projects", f"{folder}/tasks", subtasks=f"{folder}/subtasks")


def land_lines(
    spark: SparkSession, sf_dir: str, folder: str, late: bool, day: str | None = None
) -> Landing:
    """Landing folders: projects, orders and odd lines at first, even lines late.

    With a day, tasks and subtasks land in its ``landed_on`` folder.
    """
    below = f"/landed_on={day}" if day else ""
    even = F.substring_index("gid", "-", -1).cast("int") % 2 == 0
    subtasks = subtask_payloads(spark, sf_dir).filter(even if late else ~even)
    _land(subtasks, f"{folder}/subtasks{below}")
    if not late:
        _land(projects(spark, sf_dir), f"{folder}/projects")
        _land(task_payloads(spark, sf_dir), f"{folder}/tasks{below}")
    return Landing(f"{folder}/projects", f"{folder}/tasks", subtasks=f"{folder}/subtasks")


def land_broken(spark: SparkSession, sf_dir: str, folder: str) -> Landing:
    """Landing folders with one order in 50 cut short and the id missing from one line in 70."""
    orders = task_payloads(spark, sf_dir)
    line = F.to_json(F.struct(*orders.columns))
    cut = F.when(F.col("gid").cast("bigint") % 50 == 0, F.substring(line, 1, 20)).otherwise(line)
    orders.select(cut.alias("value")).write.option("compression", "gzip").text(f"{folder}/tasks")
    subtasks = subtask_payloads(spark, sf_dir)
    lost = F.col("parent_gid").cast("bigint") % 70 == 0
    kept = subtasks.withColumn("gid", F.when(~lost, F.col("gid")))
    _land(kept, f"{folder}/subtasks")
    _land(projects(spark, sf_dir), f"{folder}/projects")
    return Landing(f"{folder}/projects", f"{folder}/tasks", subtasks=f"{folder}/subtasks")


def land_entries(spark: SparkSession, sf_dir: str, folder: str) -> Landing:
    """Time entries landed below a folder of each day; some say no day that can be read."""
    entries = time_entry_payloads(spark, sf_dir)
    unclear = F.when(F.col("gid").cast("bigint") % 500 == 0, "soon").otherwise(F.col("entered_on"))
    twice = entries.unionByName(
        entries.filter(F.col("gid").cast("bigint") % 500 == 0).withColumn("entered_on", unclear)
        .withColumn("gid", F.concat(F.lit("unclear-"), F.col("gid")))
    )
    twice.repartition("entered_on").write.partitionBy("entered_on").json(f"{folder}/entries")
    return Landing("", "", f"{folder}/entries")


def time_entry_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-entry payloads from ``events``; some lack a nested object."""
    user = F.col("user_id").cast("string")
    number = (F.col("user_id") % 20).cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("gid"),
        local_day(F.col("ts")).cast("string").alias("entered_on"),
        F.when(
            F.col("event_id") % 13 != 0, F.floor("value").cast("double")
        ).alias("duration_minutes"),
        iso(F.col("ts")).alias("created_at"),
        iso(F.col("ts")).alias("modified_at"),
        F.when(
            F.col("event_id") % 5 != 0,
            F.struct(user.alias("gid"), F.concat(F.lit("Task "), user).alias("name")),
        ).alias("task"),
        F.struct(user.alias("gid"), F.concat(F.lit("User "), user).alias("name")).alias("user"),
        F.when(
            F.col("event_id") % 7 != 0,
            F.struct(
                F.concat(F.lit("P"), number).alias("gid"),
                F.concat(F.lit(" Project "), number).alias("name"),
            ),
        ).alias("attributed_project"),
    )


def existing_dim_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored projects: the even brands, plus one that no task mentions."""
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    even = F.substring_index("p_brand", "#", -1).cast("int") % 2 == 0
    gone = F.concat(F.lit("gone-"), F.col("p_brand"))
    gid = F.when(even, F.col("p_brand")).otherwise(gone)
    long_ago = ntz_literal(datetime(1990, 1, 1))
    return brands.select(
        gid.alias("project_gid"),
        F.lit("old").alias("project_name"),
        F.lit(False).alias("active"),
        long_ago.alias("created_at"),
        long_ago.alias("updated_at"),
    )


def existing_dim_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored users: one supplier in four."""
    long_ago = ntz_literal(datetime(1990, 1, 1))
    supplier = table(spark, sf_dir, "supplier").filter(F.col("s_suppkey") % 4 == 0)
    key = F.col("s_suppkey").cast("string")
    return supplier.select(
        key.alias("assignee_gid"),
        F.lit("old").alias("assignee_name"),
        F.concat(F.lit("U"), key).alias("slack_user_id"),
        F.lit(7.5).alias("work_hours_per_day"),
        F.lit(False).alias("active"),
        long_ago.alias("created_at"),
        long_ago.alias("updated_at"),
    )
