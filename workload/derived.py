"""Telemetry samples derived from the given tables.

Each function reads whole tables and returns a relation in the shape the library takes.  The fleet
grows with the data: ten users (or ten suppliers) make one instance.  ``FIXTURES.md`` states every
derivation in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from tidegauge.functions.text import quoted
from tidegauge.schemas import IO_MEASURES
from tidegauge.sources.constants import AVERAGE, BASE, CUSTOM, RATE, RATIO

GAUGE = 65792

# (event type, event_id % 3) -> wait type; the third of each kind is an ignorable one
WAITS = (
    ("click", 0, "ASYNC_NETWORK_IO"),
    ("click", 1, "SOS_SCHEDULER_YIELD"),
    ("click", 2, "BROKER_TO_FLUSH"),
    ("view", 0, "PAGEIOLATCH_SH"),
    ("view", 1, "PAGELATCH_EX"),
    ("view", 2, "LAZYWRITER_SLEEP"),
    ("purchase", 0, "WRITELOG"),
    ("purchase", 1, "LCK_M_X"),
    ("purchase", 2, "CHECKPOINT_QUEUE"),
    ("signup", 0, "CXPACKET"),
    ("signup", 1, "HADR_SYNC_COMMIT"),
    ("signup", 2, "WAITFOR"),
    ("error", 0, "LATCH_EX"),
    ("error", 1, "PREEMPTIVE_OS_WRITEFILE"),
    ("error", 2, "MISCELLANEOUS"),
)

# event type, object, counter, instance, type, measure, listed only when it moved.
# measure: total count / cents since start (cn, cc), or count / cents of the slot (gn, gc).
COUNTERS = (
    ("click", "SQL Statistics", "Batch Requests/sec ", "", RATE, "cn", False),
    ("view", "Buffer Manager", "Page Lookups/sec", " ", RATE, "cc", False),
    ("view", "Buffer Manager", "Page reads/sec", "", RATE, "cn", False),
    ("purchase", "Databases", "Transactions/sec", "_TOTAL", RATE, "cc", False),
    ("purchase", "Databases", "Transactions/sec", "salesdb", RATE, "cc", False),
    ("signup", "General Statistics", "Logins/sec", "", RATE, "cn", False),
    ("error", "SQL Errors", "Errors/sec", "_Total", RATE, "cn", True),
    ("error", "Locks", "Number of Deadlocks/sec", "_Total", RATE, "cc", True),
    ("purchase", "Memory Manager", "Total Server Memory (KB)", "", GAUGE, "gc", False),
    ("signup", "Memory Manager", "Free Memory (KB)", "", GAUGE, "gc", False),
    ("view", "Buffer Manager", "Page life expectancy", "", GAUGE, "gn", False),
    ("click", "Workload Group Stats", "CPU usage %", "default", RATIO, "gn", False),
    ("click", "Workload Group Stats", "CPU usage % base", "default", BASE, "gc", False),
    ("purchase", "Workload Group Stats", "CPU effective %", "default", RATIO, "gn", True),
    ("purchase", "Workload Group Stats", "CPU effective % base", "default", BASE, "gc", False),
    ("view", "Buffer Manager", "Buffer cache hit ratio", "", RATIO, "gn", False),
    ("view", "Buffer Manager", "Buffer cache hit ratio base", "", BASE, "gc", False),
    ("error", "Latches", "Average Latch Wait Time (ms)", "", AVERAGE, "cc", False),
    ("error", "Latches", "Average Latch Wait Time base", "", BASE, "cn", True),
    ("purchase", "Wait Statistics", "Lock waits", "Average wait time (ms)", GAUGE, "gc", False),
    ("signup", "Wait Statistics", "NON-Page latch waits", "Average wait time (ms)", GAUGE, "gn", False),
    ("error", "Databases", "Log Growths", "_Total", GAUGE, "cn", False),
    ("error", "Databases", "Log Growths", "tempdb", GAUGE, "cn", False),
    ("view", "Catalog Metadata", "Cache Entries Count", "tempdb", GAUGE, "gn", False),
    ("view", "Deprecated Features", "Usage", "sp_lock", GAUGE, "cn", False),
    ("signup", "Broker Activation", "Tasks Running", "msdb", GAUGE, "gn", False),
    ("signup", "Availability Replica", "Bytes Sent to Replica/sec", "ag1", RATE, "cc", False),
)
EVENTS = ("click", "error", "purchase", "signup", "view")
CUSTOM_SAMPLE = ("error", "Custom:IO", "Physical Reads", "Total", CUSTOM, "cn", False)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _group_of_ten(c: str) -> Column:
    return F.floor(F.col(c) / 10).cast("int")


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _midnight(c: str) -> Column:
    return F.col(c).cast("date").cast("timestamp_ntz")


def _slots(events: DataFrame) -> DataFrame:
    """Events with their instance and the start of their four-hour slot."""
    hours = (F.hour("ts") - F.hour("ts") % 4).cast("int")
    return events.select(
        _group_of_ten("user_id").alias("instance_id"),
        (_midnight("ts") + F.make_dt_interval(F.lit(0), hours, F.lit(0), F.lit(0))).alias("snapshot_date"),
        "event_type",
        (F.col("event_id") % 3).cast("int").alias("k"),
        _cents("value").alias("cents"),
    )


def _started() -> Column:
    """One restart per instance, on the 10th to 17th at 10:30, off the slot grid."""
    restart = F.lit("2024-01-10 10:30:00").cast("timestamp_ntz") + F.make_dt_interval(F.col("instance_id") % 8)
    return F.when(F.col("snapshot_date") > restart, restart).otherwise(
        F.lit("2023-12-31 18:00:00").cast("timestamp_ntz")
    )




def _since_start(*series: str) -> WindowSpec:
    return Window.partitionBy("instance_id", "instance_started", *series).orderBy("snapshot_date")


def _constant_rows(names: Sequence[str], rows: Sequence[tuple]) -> Column:
    """Each input row once per constant row, whose values become columns."""

    def sql(value) -> str:
        return quoted(value) if isinstance(value, str) else str(value).lower()

    structs = ", ".join(f"struct({', '.join(f'{sql(v)} as {n}' for n, v in zip(names, row))})" for row in rows)
    return F.expr(f"inline(array({structs}))")


def raw_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative waits: every wait type at every slot in which the instance was seen.

    Events are aggregated per slot and kind first; a slot then holds at most fifteen cells.  Totals run over slots, one row
    each, before a slot becomes a row per wait type, so those rows are neither exchanged nor sorted.
    """
    cells = (
        _slots(table(spark, sf_dir, "events"))
        .groupBy("instance_id", "snapshot_date", F.concat_ws("/", "event_type", "k").alias("kind"))
        .agg(F.struct(F.count("*"), F.sum("cents"), F.sum(F.col("cents") % 100)).alias("cell"))
    )
    none = F.lit(0).cast("bigint")
    totals = [
        F.sum(F.coalesce(F.col("cells")[f"{e}/{k}"][f"col{i}"], none)).over(_since_start()).alias(f"_{n}_{i}")
        for n, (e, k, _) in enumerate(WAITS)
        for i in (1, 2, 3)
    ]
    slots = (
        cells.groupBy("instance_id", "snapshot_date")
        .agg(F.map_from_entries(F.collect_list(F.struct("kind", "cell"))).alias("cells"))
        .withColumn("instance_started", _started())
        .select("instance_id", "snapshot_date", "instance_started", *totals)
    )
    measures = ("waiting_tasks_count", "wait_time_ms", "signal_wait_time_ms")
    rows = [
        F.struct(F.lit(w).alias("wait_type"), *[F.col(f"_{n}_{i}").alias(m) for i, m in enumerate(measures, 1)])
        for n, (_, _, w) in enumerate(WAITS)
    ]
    return slots.select("instance_id", "snapshot_date", "instance_started", F.inline(F.array(*rows)))


def raw_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter samples, cumulative and gauges.  Every fourth instance is a cloud database, whose
    object names have another prefix and which has no custom counter."""
    cells = (
        _slots(table(spark, sf_dir, "events"))
        .groupBy("instance_id", "snapshot_date", "event_type")
        .agg(F.struct(F.count("*").alias("n"), F.sum("cents").alias("c")).alias("cell"))
    )
    slots = (
        cells.groupBy("instance_id", "snapshot_date")
        .agg(F.map_from_entries(F.collect_list(F.struct("event_type", "cell"))).alias("cells"))
        .withColumns({f"{m}_{e}": F.coalesce(F.col("cells")[e][m], F.lit(0).cast("bigint")) for m in ("n", "c") for e in EVENTS})
        .withColumn("instance_started", _started())
        .drop("cells")
    )
    # Totals run over slots, one row each; the rows per counter are neither exchanged nor sorted.
    slots = slots.withColumns({f"total_{m}_{e}": F.sum(f"{m}_{e}").over(_since_start()) for m in ("n", "c") for e in EVENTS})
    measures = ("n", "c", "total_n", "total_c")
    by_event = F.create_map(*[x for e in EVENTS for x in (F.lit(e), F.struct(*[F.col(f"{m}_{e}").alias(m) for m in measures]))])
    names = ("event", "object", "counter_name", "instance_name", "cntr_type", "measure", "sparse")
    cloud, custom = F.col("instance_id") % 4 == 0, F.col("cntr_type") == CUSTOM
    return (
        slots.select("instance_id", "snapshot_date", "instance_started", by_event.alias("cells"))
        .select("*", _constant_rows(names, (*COUNTERS, CUSTOM_SAMPLE)))
        .withColumn("cell", F.col("cells")[F.col("event")])
        .select("*", "cell.*")
        .where((~F.col("sparse") | (F.col("n") > 0)) & ~(custom & cloud))
        .select(
            "instance_id",
            "snapshot_date",
            "instance_started",
            F.when(custom, F.col("object"))
            .otherwise(F.concat(F.when(cloud, "MSSQL$A1:").otherwise("SQLServer:"), "object"))
            .alias("object_name"),
            "counter_name",
            "instance_name",
            F.when(F.col("measure") == "cn", F.col("total_n"))
            .when(F.col("measure") == "cc", F.col("total_c"))
            .when(F.col("measure") == "gn", F.col("n"))
            .otherwise(F.col("c"))
            .alias("cntr_value"),
            "cntr_type",
        )
    )


def raw_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative file IO; a file has a row only in months with shipments."""
    lines = table(spark, sf_dir, "lineitem")
    database = F.concat(F.lit("db"), (F.col("l_partkey") % 3).cast("string"))
    month = F.make_date(F.year("l_shipdate"), F.month("l_shipdate"), F.lit(1)).cast("timestamp_ntz")
    quantity = F.col("l_quantity").cast("bigint")
    monthly = (
        lines.select(
            _group_of_ten("l_suppkey").alias("instance_id"),
            month.alias("snapshot_date"),
            database.alias("database_name"),
            F.concat(database, F.lit("_"), "l_returnflag", "l_linestatus").alias("logical_filename"),
            F.when(F.col("l_linestatus") == "F", "ROWS").otherwise("LOG").alias("db_file_type"),
            quantity.alias("qty"),
            _cents("l_extendedprice").alias("price"),
            _cents("l_discount").alias("disc"),
            _cents("l_tax").alias("tax"),
        )
        .groupBy("instance_id", "snapshot_date", "database_name", "logical_filename", "db_file_type")
        .agg(
            F.count("*").alias("num_of_reads"),
            F.sum("qty").alias("num_of_writes"),
            F.sum("price").alias("num_of_bytes_read"),
            F.sum(F.col("qty") * 8192).alias("num_of_bytes_written"),
            F.sum(F.col("disc") + F.col("tax")).alias("io_stall_ms"),
            F.sum("disc").alias("io_stall_reads_ms"),
            F.sum("tax").alias("io_stall_writes_ms"),
        )
    )
    so_far = Window.partitionBy("instance_id", "database_name", "logical_filename").orderBy("snapshot_date")
    return monthly.select(
        "instance_id",
        "snapshot_date",
        F.lit("1994-12-31 00:00:00").cast("timestamp_ntz").alias("instance_started"),
        "database_name",
        "logical_filename",
        F.concat(_drive_of("database_name"), F.col("logical_filename"), F.lit(".dat")).alias("db_file_name"),
        "db_file_type",
        *[F.sum(m).over(so_far).alias(m) for m in IO_MEASURES],
        F.sum("num_of_bytes_written").over(so_far).alias("size_on_disk_bytes"),
    )


def _drive_of(database: str) -> Column:
    return F.when(F.col(database) == "db0", "d:\\").when(F.col(database) == "db1", "E:\\").otherwise("F:\\")


def io_stats(spark: SparkSession, sf_dir: str, io: DataFrame | None = None) -> DataFrame:
    """``raw_io`` (``io``, where it is stored) by database and file number, as servers deliver it.  Cloud instances have their
    user database under number 5 and tempdb under 2; others number theirs 5, 6 and 7."""
    cloud = F.col("instance_id") % 4 == 0
    number = F.substring("database_name", 3, 1).cast("int")
    return (raw_io(spark, sf_dir) if io is None else io).select(
        "instance_id",
        "snapshot_date",
        "instance_started",
        F.when(cloud, 5).otherwise(3).alias("edition_code"),
        F.when(cloud & (number == 0), 2).when(cloud, 4 + number).otherwise(5 + number).alias("database_id"),
        _file_number("logical_filename").alias("file_id"),
        *IO_MEASURES,
        "size_on_disk_bytes",
    )


def database_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of database states: on the 15th of two months out of three a database goes offline or comes back."""
    months = raw_io(spark, sf_dir).select("instance_id", "database_name", "snapshot_date").distinct()
    turn = (F.year("snapshot_date") * 12 + F.month("snapshot_date") + F.col("instance_id")) % 3
    return months.where(turn < 2).select(
        "instance_id",
        F.upper("database_name").alias("database_name"),
        (F.col("snapshot_date") + F.make_dt_interval(F.lit(14))).alias("since"),
        F.when(turn == 0, "OFFLINE").otherwise("ONLINE").alias("state_desc"),
    )


def _file_number(c: str) -> Column:
    """1 for AF, 2 for RF, 3 for NO, ... by the last two letters of the file name."""
    flag, status = F.substring(c, 5, 1), F.substring(c, 6, 1)
    by_flag = F.when(flag == "A", 1).when(flag == "R", 2).otherwise(3)
    return (by_flag + F.when(status == "F", 0).otherwise(3)).cast("int")


def io_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database numbers and names of every instance; number 1 is master everywhere."""
    instances = table(spark, sf_dir, "supplier").select(_group_of_ten("s_suppkey").alias("instance_id")).distinct()
    cloud = F.col("instance_id") % 4 == 0
    numbers = F.when(cloud, F.array(F.lit(1), F.lit(5), F.lit(6))).otherwise(
        F.array(F.lit(1), F.lit(5), F.lit(6), F.lit(7))
    )
    name = F.when(F.col("database_id") == 1, "master").otherwise(
        F.concat(F.lit("db"), (F.col("database_id") - F.when(cloud, 4).otherwise(5)).cast("string"))
    )
    return instances.select("instance_id", F.explode(numbers).alias("database_id")).withColumn("name", name)


def io_files(spark: SparkSession, sf_dir: str, io: DataFrame | None = None) -> DataFrame:
    """File names of every instance and database, from the files seen in ``raw_io``."""
    stats = io_stats(spark, sf_dir, io).select("instance_id", "database_id", "file_id").distinct()
    number = F.col("database_id") - F.when(F.col("instance_id") % 4 == 0, 4).otherwise(5)
    database = F.concat(F.lit("db"), number.cast("string"))
    flag = F.element_at(F.array(F.lit("A"), F.lit("R"), F.lit("N")), ((F.col("file_id") - 1) % 3 + 1).cast("int"))
    status = F.when(F.col("file_id") <= 3, "F").otherwise("O")
    return (
        stats.where("database_id <> 2")
        .withColumn("database", database)
        .select(
            "instance_id",
            "database_id",
            "file_id",
            F.concat("database", F.lit("_"), flag, status).alias("name"),
            F.concat(_drive_of("database"), "database", F.lit("_"), flag, status, F.lit(".dat")).alias("physical_name"),
            F.when(F.col("file_id") <= 3, "ROWS").otherwise("LOG").alias("type_desc"),
        )
    )


# ---- catalog metadata: three databases, objects of all of them in the same relations -------------



def _each_database() -> Column:
    return F.explode(F.array(F.lit("db0"), F.lit("db1"), F.lit("db2"))).alias("database_name")


def _database_of(key: str) -> Column:
    return F.concat(F.lit("db"), (F.col(key) % 3).cast("string")).alias("database_name")


def schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        _each_database(), F.col("n_nationkey").alias("schema_id"), F.col("n_name").alias("name")
    )


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "supplier").select(
        _each_database(),
        F.col("s_suppkey").alias("object_id"),
        F.col("s_nationkey").alias("schema_id"),
        F.col("s_name").alias("name"),
        F.lit("USER_TABLE").alias("type_desc"),
        created.alias("create_date"),
        (created + F.make_dt_interval((F.col("s_suppkey") % 365).cast("int"))).alias("modify_date"),
    )


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _database_of("p_partkey"),
        F.floor(F.col("p_partkey") / 20).alias("object_id"),
        F.col("p_partkey").alias("column_id"),
    )


def partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        _database_of("o_orderkey"),
        order.alias("hobt_id"),
        F.floor(F.col("o_custkey") / 15).alias("object_id"),
        (order % 4).cast("int").alias("index_id"),
        (1 + (order % 5) % 3).cast("int").alias("partition_number"),
        (order % 1000).alias("rows"),
        "o_orderdate",
    )


def allocation_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        _database_of("l_orderkey"),
        F.col("l_orderkey").alias("container_id"),
        (1 + F.col("l_linenumber") % 3).cast("int").alias("data_space_id"),
        quantity.alias("total_pages"),
        F.greatest(quantity - F.col("l_linenumber"), F.lit(0)).alias("used_pages"),
    )


def data_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        _each_database(), F.col("r_regionkey").alias("data_space_id"), F.col("r_name").alias("name")
    )


def stats_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of odd-numbered objects only, so that some tables have none."""
    return (
        partitions(spark, sf_dir)
        .where("object_id % 2 = 1")
        .groupBy("database_name", "object_id", F.col("index_id").alias("stats_id"))
        .agg(F.max("o_orderdate").alias("last_updated"), F.count("*").alias("modification_counter"))
    )


def database_files(spark: SparkSession, sf_dir: str, io: DataFrame | None = None) -> DataFrame:
    """Final size of every file; log files belong to no data space."""
    return (
        (raw_io(spark, sf_dir) if io is None else io)
        .groupBy("instance_id", "database_name", "logical_filename", "db_file_name", "db_file_type")
        .agg(F.max("size_on_disk_bytes").alias("bytes"), F.max("num_of_reads").alias("used"))
        .select(
            "instance_id",
            "database_name",
            F.col("logical_filename").alias("name"),
            F.col("db_file_type").alias("type_desc"),
            F.col("db_file_name").alias("physical_name"),
            F.lit("ONLINE").alias("state_desc"),
            F.when(F.col("db_file_type") != "LOG", 1).alias("data_space_id"),
            F.floor(F.col("bytes") / 8192).alias("size"),
            "used",
        )
    )


def legacy_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        _each_database(),
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 10 == 0, "S").otherwise("U").alias("xtype"),
    )


def legacy_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = F.count("*")
    return (
        partitions(spark, sf_dir)
        .groupBy("database_name", F.col("object_id").alias("id"), F.col("index_id").alias("indid"))
        .agg(
            pages.alias("dpages"),
            (pages * 2).alias("used"),
            (pages * 3).alias("reserved"),
            F.sum("rows").alias("rowcnt"),
            F.sum(F.col("hobt_id") % 7).alias("rowmodctr"),
            F.max("o_orderdate").alias("stats_date"),
        )
        .withColumn("groupid", (1 + F.col("id") % 3).cast("int"))
    )


def legacy_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data_spaces(spark, sf_dir).where("data_space_id > 0").select(
        "database_name", F.col("data_space_id").alias("groupid"), F.col("name").alias("groupname")
    )


def legacy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return database_files(spark, sf_dir).select(
        "instance_id",
        "database_name",
        "name",
        F.col("physical_name").alias("filename"),
        F.coalesce("data_space_id", F.lit(0)).alias("groupid"),
        F.col("size").alias("totalpages"),
        F.col("used").alias("usedpages"),
    )


# ---- gauges, configuration, drives ---------------------------------------------------------------


def resource_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    hundredths = _cents("value") % 10001

    def as_percent(c: Column) -> Column:
        return (c.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(5,2)")

    return (
        table(spark, sf_dir, "events")
        .groupBy(_group_of_ten("user_id").alias("instance_id"), _midnight("ts").alias("end_time"))
        .agg(
            as_percent(F.max(hundredths)).alias("avg_cpu_percent"),
            as_percent(F.min(hundredths)).alias("avg_data_io_percent"),
            F.count("*").cast("int").alias("dtu_limit"),
        )
    )


def raw_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily configuration: the processor count rises and falls back, the memory rises once."""
    days = (
        table(spark, sf_dir, "events")
        .select(_group_of_ten("user_id").alias("instance_id"), _midnight("ts").alias("snapshot_date"))
        .distinct()
    )
    day, spread = F.day("snapshot_date"), F.col("instance_id") % 4
    return days.select(
        "instance_id",
        "snapshot_date",
        F.concat(F.lit("inst"), F.col("instance_id").cast("string")).alias("instance_nm"),
        F.concat(F.lit("host"), spread.cast("string")).alias("server_nm"),
        F.lit(None).cast("int").alias("is_clustered"),
        F.lit(0).alias("is_hadr"),
        F.when(day < 12 + spread, 8).when(day < 22, 16).otherwise(8).alias("logical_proc_count"),
        F.lit(2).alias("hyperthread_ratio"),
        F.lit(1).alias("socket_count"),
        (F.when(day < 15, 64).otherwise(128) * F.lit(1 << 20)).cast("bigint").alias("physical_memory_kb"),
        F.lit(256 << 20).cast("bigint").alias("virtual_memory_kb"),
        # Patches differ beyond the 30th character only.
        F.concat(
            F.lit("Telemetry Server 16.0.4095.4 (X64) on Linux, patch "), F.floor(day / 9).cast("int").cast("string")
        ).alias("file_version"),
        F.lit("16.0.4095.4").alias("instance_version"),
        F.when(spread == 0, 5).otherwise(3).alias("engine_edition_code"),
        F.lit("Developer Edition").alias("edition"),
        F.lit("HYPERVISOR").alias("virtual_machine_type_desc"),
        F.lit(8).alias("scheduler_count"),
        F.lit(512).alias("max_workers_count"),
        F.lit(16).alias("scheduler_total_count"),
        F.lit((48 << 20) + 1000).cast("bigint").alias("committed_target_kb"),
    )


def config_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration delivered as attribute / value rows, one set per instance and day."""
    rows = F.array(
        F.struct(F.lit("FileVersion").alias("srv_attrib"), F.col("file_version").alias("srv_char_val")),
        F.struct(F.lit("ProductVersion").alias("srv_attrib"), F.col("instance_version").alias("srv_char_val")),
        F.struct(F.lit("WindowsVersion").alias("srv_attrib"), F.col("server_nm").alias("srv_char_val")),
        F.struct(F.lit("Language").alias("srv_attrib"), F.col("edition").alias("srv_char_val")),
    )
    return raw_config(spark, sf_dir).select("instance_id", "snapshot_date", F.inline(rows))


def drives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .groupBy(
            _group_of_ten("s_suppkey").alias("instance_id"),
            F.expr("substring('CDEFG', cast(s_nationkey % 5 as int) + 1, 1)").alias("drive"),
        )
        .agg(
            F.sum(F.round(F.abs("s_acctbal")).cast("bigint")).alias("free_space_mb"),
            (F.count("*") * 20000).alias("total_size_mb"),
        )
    )


def file_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_io(spark, sf_dir).select("instance_id", F.col("db_file_name").alias("path"))
