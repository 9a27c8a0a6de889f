"""Fixed values the results depend on: names, codes, lists and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---- fixed values: counter types -----------------------------------------------------------
RATE = 272696576  # cumulative, reported per second
AVERAGE = 1073874176  # cumulative, reported per base unit
RATIO = 537003264  # gauge, reported against its base
BASE = 1073939712  # divisor of an AVERAGE or RATIO counter
CUSTOM = -1  # cumulative, reported as interval difference
DIFFERENCED = (AVERAGE, CUSTOM)

# ---- fixed values: engine editions ---------------------------------------------------------
ENGINE_EDITIONS = {
    1: "Personal or Desktop Engine",
    2: "Standard",
    3: "Enterprise",
    4: "Express",
    5: "SQL Database",
    6: "Azure Synapse Analytics",
    8: "Azure SQL Managed Instance",
    9: "Azure SQL Edge",
    11: "Azure Synapse serverless SQL pool",
}

# ---- fixed values: wait categories, first match wins ---------------------------------------
WAIT_CATEGORY_RULES = (
    ("Network IO", "is", ("ASYNC_NETWORK_IO",)),
    ("Always ON", "contains", ("HADR",)),
    ("Buffer IO", "starts", ("PAGEIO",)),
    ("Memory Buffer", "starts", ("PAGELATCH",)),
    ("Cluster", "is", ("HADR_AG_MUTEX", "HADR_AR_CRITICAL_SECTION_ENTRY")),
    ("Compile", "is", ("WAIT_ON_SYNC_STATISTICS_REFRESH",)),
    ("Connection", "is", ("CONNECTION_MGR",)),
    ("CPU", "is", ("SOS_WORKER_MIGRATION", "THREADPOOL", "SOS_SCHEDULER_YIELD")),
    ("Hash Join", "is", ("HTBUILD", "HTDELETE", "HTMEMO", "HTREPARTITION")),
    ("Latch", "starts", ("LATCH",)),
    ("Lock", "starts", ("LCK",)),
    (
        "Memory",
        "is",
        (
            "SLEEP_BPOOL_STEAL",
            "SLEEP_BUFFERPOOL_HELPLW",
            "SLEEP_MEMORYPOOL_ALLOCATEPAGES",
            "SOS_MEMORY_TOPLEVELBLOCKALLOCATOR",
        ),
    ),
    ("Other Disk IO", "is", ("IO_COMPLETION", "ASYNC_IO_COMPLETION", "WRITE_COMPLETION")),
    ("Parallelism", "is", ("CXCONSUMER",)),
    ("Producer Parallelism", "is", ("CXPACKET",)),
    ("Tran Log IO", "is", ("LOGBUFFER", "WRITELOG")),
    ("Preemptive", "contains", ("PREEMPTIVE",)),
    ("Backup", "is", ("BACKUPTHREAD",)),
)
UNCATEGORISED_WAIT = "HADR_BACKUP_QUEUE"

# ---- fixed values: wait types that say nothing about load ----------------------------------
INNOCUOUS_WAITS = (
    "BROKER_EVENTHANDLER",
    "BROKER_RECEIVE_WAITFOR",
    "BROKER_TASK_STOP",
    "BROKER_TO_FLUSH",
    "BROKER_TRANSMITTER",
    "CHECKPOINT_QUEUE",
    "CHKPT",
    "CLR_AUTO_EVENT",
    "CLR_MANUAL_EVENT",
    "CLR_SEMAPHORE",
    "DBMIRROR_DBM_EVENT",
    "DBMIRROR_EVENTS_QUEUE",
    "DBMIRROR_WORKER_QUEUE",
    "DBMIRRORING_CMD",
    "DIRTY_PAGE_POLL",
    "DISPATCHER_QUEUE_SEMAPHORE",
    "EXECSYNC",
    "FSAGENT",
    "FT_IFTS_SCHEDULER_IDLE_WAIT",
    "FT_IFTSHC_MUTEX",
    "HADR_CLUSAPI_CALL",
    "HADR_FABRIC_CALLBACK",
    "HADR_FILESTREAM_IOMGR_IOCOMPLETION",
    "HADR_LOGCAPTURE_WAIT",
    "HADR_NOTIFICATION_DEQUEUE",
    "HADR_TIMER_TASK",
    "HADR_WORK_QUEUE",
    "KSOURCE_WAKEUP",
    "LAZYWRITER_SLEEP",
    "LOGMGR_QUEUE",
    "MEMORY_ALLOCATION_EXT",
    "MSQL_XP",
    "ONDEMAND_TASK_QUEUE",
    "PARALLEL_BACKUP_QUEUE",
    "PARALLEL_REDO_DRAIN_WORKER",
    "PARALLEL_REDO_LOG_CACHE",
    "PARALLEL_REDO_TRAN_LIST",
    "PARALLEL_REDO_WORKER_SYNC",
    "PARALLEL_REDO_WORKER_WAIT_WORK",
    "PREEMPTIVE_HTTP_REQUEST",
    "PREEMPTIVE_ODBCOPS",
    "PREEMPTIVE_OS_CLOSEHANDLE",
    "PREEMPTIVE_OS_CRYPTACQUIRECONTEXT",
    "PREEMPTIVE_OS_CRYPTOPS",
    "PREEMPTIVE_OS_DELETESECURITYCONTEXT",
    "PREEMPTIVE_OS_DISCONNECTNAMEDPIPE",
    "PREEMPTIVE_OS_FINDFILE",
    "PREEMPTIVE_OS_FLUSHFILEBUFFERS",
    "PREEMPTIVE_OS_GETCOMPRESSEDFILESIZE",
    "PREEMPTIVE_OS_GETPROCADDRESS",
    "PREEMPTIVE_OS_GETQUEUEDCOMPLETIONSTATUS",
    "PREEMPTIVE_OS_QUERYREGISTRY",
    "PREEMPTIVE_OS_REVERTTOSELF",
    "PREEMPTIVE_RG_RESPONSEFROMSERVER",
    "PREEMPTIVE_XE_CALLBACKEXECUTE",
    "PREEMPTIVE_XE_GETTARGETSTATE",
    "PVS_PREALLOCATE",
    "PWAIT_ALL_COMPONENTS_INITIALIZED",
    "PWAIT_DIRECTLOGCONSUMER_GETNEXT",
    "PWAIT_EXTENSIBILITY_CLEANUP_TASK",
    "QDS_ASYNC_QUEUE",
    "QDS_CLEANUP_STALE_QUERIES_TASK_MAIN_LOOP_SLEEP",
    "QDS_PERSIST_TASK_MAIN_LOOP_SLEEP",
    "QDS_SHUTDOWN_QUEUE",
    "RBIO_AWAIT_RESPONSE",
    "RBIO_COMM_RETRY",
    "REDO_THREAD_PENDING_WORK",
    "REQUEST_FOR_DEADLOCK_SEARCH",
    "RESERVED_MEMORY_ALLOCATION_EXT",
    "RESOURCE_GOVERNOR_IDLE",
    "RESOURCE_QUEUE",
    "SERVER_IDLE_CHECK",
    "SLEEP_BPOOL_FLUSH",
    "SLEEP_DBSTARTUP",
    "SLEEP_DCOMSTARTUP",
    "SLEEP_MASTERDBREADY",
    "SLEEP_MASTERMDREADY",
    "SLEEP_MASTERUPGRADED",
    "SLEEP_MSDBSTARTUP",
    "SLEEP_SYSTEMTASK",
    "SLEEP_TASK",
    "SLEEP_TEMPDBSTARTUP",
    "SNI_CONN_DUP",
    "SNI_HTTP_ACCEPT",
    "SOS_WORK_DISPATCHER",
    "SP_SERVER_DIAGNOSTICS_SLEEP",
    "SQLTRACE_BUFFER_FLUSH",
    "SQLTRACE_INCREMENTAL_FLUSH_SLEEP",
    "SQLTRACE_WAIT_ENTRIES",
    "SQP_STATS_REPORTING",
    "VDI_CLIENT_OTHER",
    "WAIT_FOR_RESULTS",
    "WAIT_XTP_CKPT_CLOSE",
    "WAIT_XTP_HOST_WAIT",
    "WAIT_XTP_OFFLINE_CKPT_NEW_LOG",
    "WAIT_XTP_RECOVERY",
    "WAITFOR",
    "WAITFOR_TASKSHUTDOWN",
    "WINFAB_API_CALL",
    "XE_DISPATCHER_JOIN",
    "XE_DISPATCHER_WAIT",
    "XE_FILE_TARGET_TVF",
    "XE_LIVE_TARGET_TVF",
    "XE_TIMER_EVENT",
)
# Spellings of three of the names above that exist only through a text-replacement accident.
MISSPELLED_WAITS = (
    "HADR_FILESTREAM_IOMGR_IOCOMPLETIOSELECT N",
    "WAITFOR_TASKSHUTDOWSELECT N",
    "XE_DISPATCHER_JOISELECT N",
)
RESTORED_WAITS = ("WAITFOR_TASKSHUTDOWN", "XE_DISPATCHER_JOIN")

# ---- fixed values: counters computed by the collector itself (type -1) ----------------------
CUSTOM_COUNTERS = (
    ("Custom:IO", "Physical Reads", "Total"),
    ("Custom:IO", "Physical Writes", "Total"),
    ("Custom:IO", "SQL IO Util", "Total"),
    ("Custom:Memory", "Buffer Cache Quality", "Total"),
    ("Custom:Network", "Total Packet Errors", "Total"),
    ("Custom:Network", "Total Packets Received", "Total"),
    ("Custom:Network", "Total Packets Sent", "Total"),
    ("Custom:Processor", "SQL CPU Idle", "Total"),
    ("Custom:Processor", "SQL CPU Util", "Total"),
    ("Custom:Processor", "Total System CPU", "Total"),
)

# ---- fixed values: object families listed per database, kept only for these instances ------
PER_DATABASE_FAMILIES = (
    "Databases",
    "Catalog Metadata",
    "Deprecated Features",
    "Query Store",
    "Columnstore",
    "Advanced Analytics",
    "Broker Activation",
)
SUMMARY_INSTANCES = ("_Total", "tempdb")

# ---- fixed values: which counters are logged -----------------------------------------------
# (how the object name matches, object, how the counter matches, counters, instance, edition)
TEMPDB_SIZE_COUNTERS = (
    "Log File(s) Used Size (KB)",
    "Log File(s) Size (KB)",
    "Data File(s) Size (KB)",
    "Percent Log Used",
    "Log Growths",
    "Write Transactions/sec",
)
LOG_RULES = (
    (
        "ends",
        "general statistics",
        "is",
        (
            "Logins/sec",
            "Logouts/sec",
            "Connection Reset/sec",
            "Temp Tables Creation Rate",
            "Processes blocked",
            "User Connections",
        ),
        None,
        None,
    ),
    (
        "ends",
        "buffer manager",
        "is",
        (
            "Page reads/sec",
            "Page writes/sec",
            "Lazy writes/sec",
            "Checkpoint pages/sec",
            "Buffer cache hit ratio",
            "Page lookups/sec",
            "Readahead pages/sec",
            "Page life expectancy",
        ),
        None,
        None,
    ),
    ("ends", "Access Methods", "is", ("Forwarded Records/sec", "Page Splits/sec", "Full Scans/sec"), None, None),
    (
        "ends",
        "Locks",
        "is",
        ("Lock Timeouts/sec", "Number of Deadlocks/sec", "Lock Wait Time (ms)"),
        "_Total",
        None,
    ),
    ("ends", "SQL Errors", "is", ("Errors/sec",), "_Total", None),
    (
        "ends",
        "SQL Statistics",
        "is",
        ("Batch Requests/sec", "SQL Compilations/sec", "SQL Re-Compilations/sec", "SQL Attention rate"),
        None,
        None,
    ),
    ("starts", "Custom", "starts", ("",), None, None),
    (
        "ends",
        "Memory Manager",
        "is",
        (
            "Connection Memory (KB)",
            "Database Cache Memory (KB)",
            "Free Memory (KB)",
            "Granted Workspace Memory (KB)",
            "Lock Memory (KB)",
            "Maximum Workspace Memory (KB)",
            "Optimizer Memory (KB)",
            "SQL Cache Memory (KB)",
            "Stolen Server Memory (KB)",
            "Log Pool Memory (KB)",
            "Target Server Memory (KB)",
            "Total Server Memory (KB)",
        ),
        None,
        None,
    ),
    (
        "ends",
        "Wait Statistics",
        "is",
        (
            "Lock waits",
            "Memory grant queue waits",
            "Log write waits",
            "Log buffer waits",
            "Network IO waits",
            "Page IO latch waits",
            "Page latch waits",
            "Non-Page latch waits",
            "Wait for the worker",
            "Workspace synchronization waits",
        ),
        "Average wait time (ms)",
        None,
    ),
    (
        "ends",
        "Databases",
        "is",
        (
            "Transactions/sec",
            "Bulk Copy Rows/sec",
            "Log Flush Waits/sec",
            "Log Flush Write Time (ms)",
            "Backup/Restore Throughput/sec",
            "Bulk Copy Throughput/sec",
            "Log Bytes Flushed/sec",
        ),
        "_Total",
        None,
    ),
    ("ends", "Workload Group Stats", "starts", ("cpu usage", "cpu effective"), "default", None),
    ("ends", "Buffer Manager", "starts", ("Buffer cache hit ratio",), None, None),
    ("ends", ":Database Replica", "is", ("Transaction Delay", "Mirrored Write Transactions/sec"), "_Total", None),
    ("ends", ":Databases", "is", TEMPDB_SIZE_COUNTERS, "tempdb", None),
    ("ends", ":Databases", "is", TEMPDB_SIZE_COUNTERS, "_Total", 5),
)

# ---- fixed values: pivot columns (output column, counter, instance or None for any) --------
THROUGHPUT_COLUMNS = (
    ("Batch_Requests_sec", "Batch Requests/sec", None),
    ("Transactions_sec", "Transactions/sec", "_Total"),
    ("logical_reads_sec", "Page lookups/sec", None),
    ("Page_reads_sec", "Page reads/sec", None),
    ("Page_writes_sec", "Page writes/sec", None),
    ("Readahead_pages_sec", "Readahead pages/sec", None),
    ("Log_Flush_Waits_sec", "Log Flush Waits/sec", "_Total"),
    ("Bulk_Copy_Throughput_sec", "Bulk Copy Throughput/sec", "_Total"),
    ("Errors_sec", "Errors/sec", "_Total"),
    ("Logins_sec", "Logins/sec", None),
    ("Logouts_sec", "Logouts/sec", None),
    ("Connection_Reset_sec", "Connection Reset/sec", None),
    ("SQL_ReCompilations_sec", "SQL Re-Compilations/sec", None),
    ("SQL_Compilations_sec", "SQL Compilations/sec", None),
)
MEMORY_GB_COLUMNS = (
    ("Total_Server_Memory_GB", "Total Server Memory (KB)"),
    ("Target_Server_Memory_GB", "Target Server Memory (KB)"),
    ("Database_Cache_Memory_GB", "Database Cache Memory (KB)"),
    ("StolenServer_Memory_GB", "Stolen Server Memory (KB)"),
    ("Maximum_Workspace_Memory_GB", "Maximum Workspace Memory (KB)"),
    ("Granted_Workspace_Memory_GB", "Granted Workspace Memory (KB)"),
    ("Free_Memory_GB", "Free Memory (KB)"),
    ("Connection_Memory_GB", "Connection Memory (KB)"),
)
PAGE_LIFE_COLUMN = ("Page_life", "Page life expectancy")
MEMORY_OBJECTS = ("Memory Manager", "Buffer Manager")
MEMORY_INSTANCES = ("_Total", "")
WAIT_TIME_OBJECT = "Wait Statistics"
WAIT_TIME_INSTANCE = "Average wait time (ms)"
WAIT_TIME_COLUMNS = (
    ("Lock_waits_ms", "Lock waits"),
    ("Page_IO_latch_waits_ms", "Page IO latch waits"),
    ("Network_IO_waits_ms", "Network IO waits"),
    ("Page_latch_waits_ms", "Page latch waits"),
    ("Memory_grant_queue_waits_ms", "Memory grant queue waits"),
    ("Wait_for_the_worker_ms", "Wait for the worker"),
    ("Log_write_waits_ms", "Log write waits"),
    ("NON_Page_latch_waits_ms", "Non-Page latch waits"),
    ("Log_buffer_waits_ms", "Log buffer waits"),
)
RATIO_COLUMNS = (
    ("sql_cpu_usage", "CPU usage %", "CPU usage % base", "default"),
    ("sql_cpu_effective", "CPU effective %", "CPU effective % base", "default"),
    ("buffer_cache_hit_ratio", "Buffer cache hit ratio", "Buffer cache hit ratio base", ""),
)
REPORT_COLUMNS = (
    "instance_id",
    "snapshot_date",
    "sql_cpu_usage",
    "sql_cpu_effective",
    "Total_Server_Memory_GB",
    "Granted_Workspace_Memory_GB",
    "Page_life",
    "Batch_Requests_sec",
    "Transactions_sec",
    "logical_reads_sec",
    "Page_reads_sec",
    "Page_writes_sec",
    "Readahead_pages_sec",
    "Log_Flush_Waits_sec",
    "Bulk_Copy_Throughput_sec",
    "Lock_waits_ms",
    "Page_IO_latch_waits_ms",
    "Network_IO_waits_ms",
    "Page_latch_waits_ms",
    "Memory_grant_queue_waits_ms",
    "Wait_for_the_worker_ms",
    "Log_write_waits_ms",
    "NON_Page_latch_waits_ms",
    "Log_buffer_waits_ms",
    "buffer_cache_hit_ratio",
    "Target_Server_Memory_GB",
    "Database_Cache_Memory_GB",
    "Free_Memory_GB",
)

# ---- fixed values: configuration attributes delivered as name / value rows ------------------
CONFIG_ATTRIBUTES = {
    "FileVersion": "file_version",
    "ProductVersion": "instance_version",
    "WindowsVersion": "os_version",
}
# Columns whose change makes a new configuration row (the virtual machine type is not one).
CONFIG_CHANGE_COLUMNS = (
    "instance_nm",
    "server_nm",
    "is_clustered",
    "is_hadr",
    "logical_proc_count",
    "hyperthread_ratio",
    "socket_count",
    "physical_memory_gb",
    "virtual_memory_gb",
    "file_version",
    "instance_version",
    "engine_edition",
    "edition",
    "scheduler_count",
    "max_workers_count",
    "scheduler_total_count",
    "committed_target_gb",
)


def innocuous_wait_names(*, parity: bool = False) -> tuple[str, ...]:
    """Ignorable wait types; ``parity`` keeps the misspelled entries instead of the restored ones."""
    if not parity:
        return INNOCUOUS_WAITS
    return tuple(w for w in INNOCUOUS_WAITS if w not in RESTORED_WAITS) + MISSPELLED_WAITS


def innocuous_waits(spark: SparkSession, *, parity: bool = False) -> DataFrame:
    """The ignorable wait types as rows."""
    return spark.createDataFrame([(w,) for w in innocuous_wait_names(parity=parity)], "wait_type string").distinct()


def custom_counters(spark: SparkSession, *, parity: bool = False) -> DataFrame:
    """Collector-computed counters; ``parity`` files one network counter under IO."""
    rows = [
        ("Custom:IO" if parity and c == "Total Packets Sent" else o, c, i) for o, c, i in CUSTOM_COUNTERS
    ]
    return spark.createDataFrame(rows, "object_nm string, counter_nm string, instance_nm string").distinct()
