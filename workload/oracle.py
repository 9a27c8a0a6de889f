"""The same results in plain SQL, written independently of the library.

Inputs are derived again from the given tables; look-backs are self joins or running maxima instead
of chunked windows; ratios are integers rounded half up.
"""

from __future__ import annotations


def _sql(select: str, *names: str) -> str:
    """``select`` over the named common table expressions and all they need."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for inner in _CTES[name][0]:
            need(inner)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][1]})" for n in ordered) + "\n" + select


def _half_up(num: str, den: str, scale: int = 100) -> str:
    return f"CAST((2 * {scale} * CAST({num} AS HUGEINT) + ({den})) // (2 * ({den})) AS BIGINT)"


_IO = (
    "num_of_reads",
    "num_of_writes",
    "num_of_bytes_read",
    "num_of_bytes_written",
    "io_stall_ms",
    "io_stall_reads_ms",
    "io_stall_writes_ms",
)
_INNOCUOUS_SEEN = "('BROKER_TO_FLUSH', 'LAZYWRITER_SLEEP', 'CHECKPOINT_QUEUE', 'WAITFOR')"

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}

# ---- derived inputs ------------------------------------------------------------------------------

_CTES["ev"] = (
    (),
    """
  SELECT CAST(user_id // 10 AS INT) AS instance_id,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_hours(CAST(hour(ts) - hour(ts) % 4 AS INT)) AS snapshot_date,
         event_type, CAST(event_id % 3 AS INT) AS k, CAST(ROUND(value * 100) AS BIGINT) AS cents
  FROM events""",
)
_CTES["spine"] = (
    ("ev",),
    """
  SELECT instance_id, snapshot_date,
         CASE WHEN snapshot_date > TIMESTAMP '2024-01-10 10:30:00' + to_days(instance_id % 8)
              THEN TIMESTAMP '2024-01-10 10:30:00' + to_days(instance_id % 8)
              ELSE TIMESTAMP '2023-12-31 18:00:00' END AS instance_started
  FROM (SELECT DISTINCT instance_id, snapshot_date FROM ev) d""",
)
_CTES["wait_map"] = (
    (),
    """
  SELECT * FROM (VALUES
    ('click',0,'ASYNC_NETWORK_IO'),('click',1,'SOS_SCHEDULER_YIELD'),('click',2,'BROKER_TO_FLUSH'),
    ('view',0,'PAGEIOLATCH_SH'),('view',1,'PAGELATCH_EX'),('view',2,'LAZYWRITER_SLEEP'),
    ('purchase',0,'WRITELOG'),('purchase',1,'LCK_M_X'),('purchase',2,'CHECKPOINT_QUEUE'),
    ('signup',0,'CXPACKET'),('signup',1,'HADR_SYNC_COMMIT'),('signup',2,'WAITFOR'),
    ('error',0,'LATCH_EX'),('error',1,'PREEMPTIVE_OS_WRITEFILE'),('error',2,'MISCELLANEOUS')
  ) m(event_type, k, wait_type)""",
)
_CTES["raw_waits"] = (
    ("spine", "wait_map"),
    """
  SELECT instance_id, snapshot_date, instance_started, wait_type,
         CAST(SUM(n) OVER w AS BIGINT) AS req, CAST(SUM(cents) OVER w AS BIGINT) AS tim,
         CAST(SUM(sig) OVER w AS BIGINT) AS sig
  FROM (
    SELECT s.instance_id, s.snapshot_date, s.instance_started, m.wait_type,
           COUNT(e.cents) AS n, COALESCE(SUM(e.cents), 0) AS cents, COALESCE(SUM(e.cents % 100), 0) AS sig
    FROM spine s CROSS JOIN wait_map m
    LEFT JOIN ev e ON e.instance_id = s.instance_id AND e.snapshot_date = s.snapshot_date
                  AND e.event_type = m.event_type AND e.k = m.k
    GROUP BY ALL) per
  WINDOW w AS (PARTITION BY instance_id, instance_started, wait_type ORDER BY snapshot_date)""",
)
_CTES["counter_map"] = (
    (),
    """
  SELECT * FROM (VALUES
    ('click','SQL Statistics','Batch Requests/sec ','',272696576,'cn',false),
    ('view','Buffer Manager','Page Lookups/sec',' ',272696576,'cc',false),
    ('view','Buffer Manager','Page reads/sec','',272696576,'cn',false),
    ('purchase','Databases','Transactions/sec','_TOTAL',272696576,'cc',false),
    ('purchase','Databases','Transactions/sec','salesdb',272696576,'cc',false),
    ('signup','General Statistics','Logins/sec','',272696576,'cn',false),
    ('error','SQL Errors','Errors/sec','_Total',272696576,'cn',true),
    ('error','Locks','Number of Deadlocks/sec','_Total',272696576,'cc',true),
    ('purchase','Memory Manager','Total Server Memory (KB)','',65792,'gc',false),
    ('signup','Memory Manager','Free Memory (KB)','',65792,'gc',false),
    ('view','Buffer Manager','Page life expectancy','',65792,'gn',false),
    ('click','Workload Group Stats','CPU usage %','default',537003264,'gn',false),
    ('click','Workload Group Stats','CPU usage % base','default',1073939712,'gc',false),
    ('purchase','Workload Group Stats','CPU effective %','default',537003264,'gn',true),
    ('purchase','Workload Group Stats','CPU effective % base','default',1073939712,'gc',false),
    ('view','Buffer Manager','Buffer cache hit ratio','',537003264,'gn',false),
    ('view','Buffer Manager','Buffer cache hit ratio base','',1073939712,'gc',false),
    ('error','Latches','Average Latch Wait Time (ms)','',1073874176,'cc',false),
    ('error','Latches','Average Latch Wait Time base','',1073939712,'cn',true),
    ('purchase','Wait Statistics','Lock waits','Average wait time (ms)',65792,'gc',false),
    ('signup','Wait Statistics','NON-Page latch waits','Average wait time (ms)',65792,'gn',false),
    ('error','Databases','Log Growths','_Total',65792,'cn',false),
    ('error','Databases','Log Growths','tempdb',65792,'cn',false),
    ('view','Catalog Metadata','Cache Entries Count','tempdb',65792,'gn',false),
    ('view','Deprecated Features','Usage','sp_lock',65792,'cn',false),
    ('signup','Broker Activation','Tasks Running','msdb',65792,'gn',false),
    ('signup','Availability Replica','Bytes Sent to Replica/sec','ag1',272696576,'cc',false),
    ('error','Custom:IO','Physical Reads','Total',-1,'cn',false)
  ) m(event_type, object_name, counter_name, instance_name, cntr_type, measure, sparse)""",
)
_CTES["raw_counters"] = (
    ("spine", "counter_map"),
    """
  SELECT instance_id, snapshot_date, instance_started,
         CASE WHEN cntr_type = -1 THEN object_name
              WHEN instance_id % 4 = 0 THEN 'MSSQL$A1:' || object_name
              ELSE 'SQLServer:' || object_name END AS object_name,
         counter_name, instance_name, cntr_type,
         CAST(CASE measure WHEN 'cn' THEN tn WHEN 'cc' THEN tc WHEN 'gn' THEN n ELSE c END AS BIGINT) AS cntr_value
  FROM (
    SELECT p.*, SUM(n) OVER w AS tn, SUM(c) OVER w AS tc
    FROM (
      SELECT s.instance_id, s.snapshot_date, s.instance_started, m.object_name, m.counter_name, m.instance_name,
             m.cntr_type, m.measure, m.sparse, COUNT(e.cents) AS n, COALESCE(SUM(e.cents), 0) AS c
      FROM spine s CROSS JOIN counter_map m
      LEFT JOIN ev e ON e.instance_id = s.instance_id AND e.snapshot_date = s.snapshot_date
                    AND e.event_type = m.event_type
      GROUP BY ALL) p
    WINDOW w AS (PARTITION BY instance_id, instance_started, object_name, counter_name, instance_name
                 ORDER BY snapshot_date)) x
  WHERE (NOT sparse OR n > 0) AND NOT (cntr_type = -1 AND instance_id % 4 = 0)""",
)
_CTES["raw_io"] = (
    (),
    """
  SELECT instance_id, snapshot_date, TIMESTAMP '1994-12-31 00:00:00' AS instance_started,
         database_name, logical_filename,
         CASE database_name WHEN 'db0' THEN 'd:\\' WHEN 'db1' THEN 'E:\\' ELSE 'F:\\' END
           || logical_filename || '.dat' AS db_file_name, db_file_type,
         CAST(SUM(r) OVER f AS BIGINT) AS num_of_reads, CAST(SUM(w) OVER f AS BIGINT) AS num_of_writes,
         CAST(SUM(br) OVER f AS BIGINT) AS num_of_bytes_read, CAST(SUM(bw) OVER f AS BIGINT) AS num_of_bytes_written,
         CAST(SUM(sr + sw) OVER f AS BIGINT) AS io_stall_ms,
         CAST(SUM(sr) OVER f AS BIGINT) AS io_stall_reads_ms, CAST(SUM(sw) OVER f AS BIGINT) AS io_stall_writes_ms,
         CAST(SUM(bw) OVER f AS BIGINT) AS size_on_disk_bytes
  FROM (
    SELECT instance_id, snapshot_date, database_name, logical_filename, db_file_type,
           COUNT(*) AS r, SUM(qty) AS w, SUM(price) AS br, SUM(qty * 8192) AS bw, SUM(disc) AS sr, SUM(tax) AS sw
    FROM (
      SELECT CAST(l_suppkey // 10 AS INT) AS instance_id,
             CAST(make_date(year(l_shipdate), month(l_shipdate), 1) AS TIMESTAMP) AS snapshot_date,
             'db' || CAST(l_partkey % 3 AS VARCHAR) AS database_name,
             'db' || CAST(l_partkey % 3 AS VARCHAR) || '_' || l_returnflag || l_linestatus AS logical_filename,
             CASE WHEN l_linestatus = 'F' THEN 'ROWS' ELSE 'LOG' END AS db_file_type,
             CAST(l_quantity AS BIGINT) AS qty, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS price,
             CAST(ROUND(l_discount * 100) AS BIGINT) AS disc, CAST(ROUND(l_tax * 100) AS BIGINT) AS tax
      FROM lineitem) li
    GROUP BY ALL) per
  WINDOW f AS (PARTITION BY instance_id, database_name, logical_filename ORDER BY snapshot_date)""",
)

_CTES["database_states"] = (
    ("raw_io",),
    """
  SELECT instance_id, upper(database_name) AS database_name, snapshot_date + INTERVAL 14 DAY AS since,
         CASE WHEN turn = 0 THEN 'OFFLINE' ELSE 'ONLINE' END AS state_desc
  FROM (SELECT DISTINCT instance_id, database_name, snapshot_date,
               (year(snapshot_date) * 12 + month(snapshot_date) + instance_id) % 3 AS turn FROM raw_io) m
  WHERE turn < 2""",
)

# ---- sequence, dimension, counters ---------------------------------------------------------------

_SEQUENCE = """
  SELECT instance_id, snapshot_date, instance_started, prev_snapshot, next_snapshot, first_measure,
         CAST(date_diff('second', CASE WHEN first_measure THEN instance_started ELSE prev_snapshot END,
                        snapshot_date) AS INT) AS interval_s
  FROM (
    SELECT d.*, LAG(snapshot_date) OVER w AS prev_snapshot, LEAD(snapshot_date) OVER w AS next_snapshot,
           COALESCE(LAG(instance_started) OVER w <> instance_started, true) AS first_measure
    FROM (SELECT DISTINCT instance_id, snapshot_date, instance_started FROM {source}) d
    WINDOW w AS (PARTITION BY instance_id ORDER BY snapshot_date)) q"""
_CTES["seq"] = (("spine",), _SEQUENCE.format(source="spine"))
_CTES["io_seq"] = (("raw_io",), _SEQUENCE.format(source="raw_io"))

_CTES["selection"] = (
    ("raw_counters",),
    """
  SELECT CAST('0x' || substr(md5(concat_ws('|', length(ok) || ':' || ok, length(ck) || ':' || ck, length(ik) || ':' || ik)), 1, 15) AS BIGINT) AS inst_perf_param_id,
         object_nm, counter_nm, instance_nm, counter_type, CAST(0 AS BIGINT) AS parent_param_id, false AS log_ind,
         ok, ck, ik
  FROM (
    SELECT lower(trim(object_name)) AS ok, lower(trim(counter_name)) AS ck, lower(trim(instance_name)) AS ik,
           MIN(trim(object_name)) AS object_nm, MIN(trim(counter_name)) AS counter_nm,
           MIN(trim(instance_name)) AS instance_nm, MIN(cntr_type) AS counter_type
    FROM raw_counters
    WHERE NOT regexp_matches(lower(trim(object_name)),
            ':(databases|catalog metadata|deprecated features|query store|columnstore|advanced analytics|broker activation)$')
       OR lower(trim(instance_name)) IN ('_total', 'tempdb')
    GROUP BY 1, 2, 3) s""",
)
_CTES["built"] = (
    ("selection",),
    """
  SELECT * FROM selection
  UNION ALL
  SELECT CAST('0x' || substr(md5(concat_ws('|', length(o) || ':' || lower(o), length(c) || ':' || lower(c), length(i) || ':' || lower(i))), 1, 15) AS BIGINT),
         o, c, i, -1, CAST(0 AS BIGINT), false, lower(o), lower(c), lower(i)
  FROM (VALUES
    ('Custom:IO','Physical Reads','Total'),('Custom:IO','Physical Writes','Total'),('Custom:IO','SQL IO Util','Total'),
    ('Custom:Memory','Buffer Cache Quality','Total'),
    ('Custom:Network','Total Packet Errors','Total'),('Custom:Network','Total Packets Received','Total'),
    ('Custom:Network','Total Packets Sent','Total'),
    ('Custom:Processor','SQL CPU Idle','Total'),('Custom:Processor','SQL CPU Util','Total'),
    ('Custom:Processor','Total System CPU','Total')) v(o, c, i)
  WHERE NOT EXISTS (SELECT 1 FROM selection s WHERE s.ok = lower(o) AND s.ck = lower(c) AND s.ik = lower(i))""",
)
_FLAGGED = """
  SELECT inst_perf_param_id, object_nm, counter_nm, instance_nm, counter_type, parent_param_id, ok, ck, ik,
    (ok LIKE '%general statistics' AND ck IN ('logins/sec','logouts/sec','connection reset/sec',
       'temp tables creation rate','processes blocked','user connections'))
    OR (ok LIKE '%buffer manager' AND (ck IN ('page reads/sec','page writes/sec','lazy writes/sec',
       'checkpoint pages/sec','page lookups/sec','readahead pages/sec','page life expectancy')
       OR ck LIKE 'buffer cache hit ratio%'))
    OR (ok LIKE '%access methods' AND ck IN ('forwarded records/sec','page splits/sec','full scans/sec'))
    OR (ok LIKE '%locks' AND ik = '_total' AND ck IN ('lock timeouts/sec','number of deadlocks/sec','lock wait time (ms)'))
    OR (ok LIKE '%sql errors' AND ik = '_total' AND ck = 'errors/sec')
    OR (ok LIKE '%sql statistics' AND ck IN ('batch requests/sec','sql compilations/sec','sql re-compilations/sec',
       'sql attention rate'))
    OR ok LIKE 'custom%'
    OR (ok LIKE '%memory manager' AND ck IN ('connection memory (kb)','database cache memory (kb)','free memory (kb)',
       'granted workspace memory (kb)','lock memory (kb)','maximum workspace memory (kb)','optimizer memory (kb)',
       'sql cache memory (kb)','stolen server memory (kb)','log pool memory (kb)','target server memory (kb)',
       'total server memory (kb)'))
    OR (ok LIKE '%wait statistics' AND ik = 'average wait time (ms)' AND ck IN ('lock waits','memory grant queue waits',
       'log write waits','log buffer waits','network io waits','page io latch waits','page latch waits',
       'non-page latch waits','wait for the worker','workspace synchronization waits'))
    OR (ok LIKE '%databases' AND ik = '_total' AND ck IN ('transactions/sec','bulk copy rows/sec','log flush waits/sec',
       'log flush write time (ms)','backup/restore throughput/sec','bulk copy throughput/sec','log bytes flushed/sec'))
    OR (ok LIKE '%workload group stats' AND ik = 'default' AND (ck LIKE 'cpu usage%' OR ck LIKE 'cpu effective%'))
    OR (ok LIKE '%:database replica' AND ik = '_total' AND ck IN ('transaction delay','mirrored write transactions/sec'))
    OR (ok LIKE '%:databases' AND ik IN ({tempdb_like}) AND ck IN ('log file(s) used size (kb)','log file(s) size (kb)',
       'data file(s) size (kb)','percent log used','log growths','write transactions/sec')) AS log_ind
  FROM {source}"""
_CTES["flagged"] = (("built",), _FLAGGED.format(source="built", tempdb_like="'tempdb'"))
_CTES["flagged_cloud"] = (("selection",), _FLAGGED.format(source="selection", tempdb_like="'tempdb', '_total'"))
_CTES["dim"] = (
    ("flagged",),
    """
  SELECT f.inst_perf_param_id, f.object_nm, f.counter_nm, f.instance_nm, f.counter_type,
         COALESCE(p.inst_perf_param_id, f.parent_param_id) AS parent_param_id, f.log_ind, f.ok, f.ck, f.ik
  FROM flagged f
  LEFT JOIN flagged p ON f.counter_type = 1073939712 AND p.counter_type IN (537003264, 1073874176)
    AND p.ok = f.ok AND p.ik = f.ik AND rtrim(replace(p.ck, ' (ms)', '')) || ' base' = f.ck""",
)
# A fleet: the cloud databases (every fourth instance) log some counters of their own and have no custom ones.
_CTES["flagged_fleet"] = (
    ("flagged", "built"),
    f"""
  SELECT *, CAST(NULL AS INT) AS engine_edition FROM flagged
  UNION ALL
  SELECT CAST('0x' || substr(md5(concat_ws('|', length(ok) || ':' || ok, length(ck) || ':' || ck, length(ik) || ':' || ik, '1:5')), 1, 15) AS BIGINT),
         object_nm, counter_nm, instance_nm, counter_type, parent_param_id, ok, ck, ik, NOT log_ind, 5
  FROM (
    SELECT c.* REPLACE (f.log_ind AS log_ind), c.log_ind AND c.ok NOT LIKE 'custom:%' AS in_cloud
    FROM ({_FLAGGED.format(source="built", tempdb_like="'tempdb', '_total'")}) c JOIN flagged f USING (inst_perf_param_id)) b
  WHERE log_ind <> in_cloud""",
)
_CTES["fleet_dim"] = (
    ("flagged_fleet",),
    """
  SELECT f.* REPLACE (COALESCE(p.inst_perf_param_id, f.parent_param_id) AS parent_param_id)
  FROM flagged_fleet f
  LEFT JOIN flagged_fleet p ON f.counter_type = 1073939712 AND p.counter_type IN (537003264, 1073874176)
    AND p.ok = f.ok AND p.ik = f.ik AND rtrim(replace(p.ck, ' (ms)', '')) || ' base' = f.ck
    AND p.engine_edition IS NOT DISTINCT FROM f.engine_edition""",
)
_DIM = "inst_perf_param_id, object_nm, counter_nm, instance_nm, counter_type, parent_param_id, log_ind"


def _staged(params: str) -> str:
    """Samples of logged counters with their sequence and, by self join, their previous total."""
    return f"""
  SELECT c.*, q.prev_snapshot, q.first_measure, q.interval_s
  FROM (
    SELECT r.instance_id, r.snapshot_date, r.instance_started, d.inst_perf_param_id, d.counter_type, d.parent_param_id,
           abs(r.cntr_value) AS total
    FROM raw_counters r JOIN {params} d
      ON d.ok = lower(rtrim(r.object_name)) AND d.ck = lower(rtrim(r.counter_name)) AND d.ik = lower(rtrim(r.instance_name))
    WHERE d.log_ind) c
  JOIN seq q USING (instance_id, snapshot_date)"""


_CTES["staged"] = (("raw_counters", "dim", "seq"), _staged("dim"))
_CTES["fleet_staged"] = (
    ("raw_counters", "fleet_dim", "seq"),
    _staged("fleet_dim").replace(
        "WHERE d.log_ind",
        """WHERE d.log_ind AND CASE WHEN d.engine_edition = 5 THEN r.instance_id % 4 = 0
            ELSE r.instance_id % 4 <> 0 OR NOT EXISTS (
              SELECT 1 FROM fleet_dim o WHERE o.engine_edition = 5 AND o.ok = d.ok AND o.ck = d.ck AND o.ik = d.ik) END""",
    ),
)
_CTES["fallen_counters"] = (
    ("raw_counters",),
    "SELECT * REPLACE (CASE WHEN cntr_value % 11 = 0 THEN cntr_value // 3 ELSE cntr_value END AS cntr_value) FROM raw_counters",
)
_CTES["fallen_staged"] = (("fallen_counters", "dim", "seq"), _staged("dim").replace("raw_counters", "fallen_counters"))
_CTES["delivered"] = (
    (),
    """
  SELECT d.*, n.newest IS NULL OR window_end > n.newest - INTERVAL 10 MINUTE AS in_time
  FROM (
    SELECT *, CAST(least((day(ts) - 1) // 8 + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END, 3) AS INT) AS delivery,
           time_bucket(INTERVAL 30 MINUTE, ts) AS window_start, time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS window_end
    FROM events) d
  LEFT JOIN (
    SELECT delivery AS before, MAX(ts) AS newest
    FROM (SELECT ts, CAST(least((day(ts) - 1) // 8 + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END, 3) AS INT) AS brought FROM events) e
    JOIN (VALUES (1), (2), (3)) t(delivery) ON brought < delivery
    GROUP BY 1) n ON n.before = d.delivery""",
)
_CTES["gained"] = (
    ("staged",),
    """
  SELECT c.*, CASE WHEN c.first_measure THEN c.total ELSE c.total - COALESCE(p.total, 0) END AS gain
  FROM staged c
  LEFT JOIN staged p ON p.instance_id = c.instance_id AND p.inst_perf_param_id = c.inst_perf_param_id
    AND p.snapshot_date = c.prev_snapshot""",
)
_AVERAGES = """
  SELECT c.instance_id, c.snapshot_date, c.inst_perf_param_id, c.total, c.first_measure, c.interval_s,
         {value} AS v
  FROM gained c
  LEFT JOIN gained b ON b.instance_id = c.instance_id AND b.snapshot_date = c.snapshot_date
    AND b.parent_param_id = c.inst_perf_param_id
  WHERE c.counter_type = 1073874176"""


def _divisor(column: str) -> str:
    return f"COALESCE(NULLIF(b.{column}, 0), 1)"


_CTES["latch_dim"] = (
    ("dim",),
    "SELECT * REPLACE (object_nm LIKE '%Latches' AND counter_type IN (1073874176, 1073939712) AS log_ind) FROM dim",
)
_CTES["latch_staged"] = (("raw_counters", "latch_dim", "seq"), _staged("latch_dim"))
_CTES["fleet_gained"] = (("fleet_staged",), _CTES["gained"][1].replace("staged", "fleet_staged"))
_CTES["latch_gained"] = (("latch_staged",), _CTES["gained"][1].replace("staged", "latch_staged"))
_CTES["perf"] = (
    ("gained",),
    f"""
  SELECT c.instance_id, c.snapshot_date, c.inst_perf_param_id, c.counter_type, c.total, c.first_measure, c.interval_s,
         CASE WHEN c.counter_type = 1073874176
              THEN {_half_up("c.gain", _divisor("gain"))}
              WHEN c.first_measure THEN 100 * c.total
              WHEN c.counter_type = 272696576 THEN {_half_up("c.gain", "c.interval_s")}
              WHEN c.counter_type = -1 THEN 100 * c.gain
              ELSE 100 * c.total END AS v
  FROM gained c
  LEFT JOIN gained b ON b.instance_id = c.instance_id AND b.snapshot_date = c.snapshot_date
    AND b.parent_param_id = c.inst_perf_param_id AND c.counter_type = 1073874176""",
)
_CTES["fleet_perf"] = (("fleet_gained",), _CTES["perf"][1].replace("gained", "fleet_gained"))
_SNAP = """
SELECT instance_id, snapshot_date, inst_perf_param_id, CAST(v AS BIGINT) AS instance_perf_value,
       CAST(total AS BIGINT) AS cumulative_perf_value, first_measure AS startup_measure_ind,
       interval_s AS measurement_interval_s
FROM {source}"""

# ---- waits ---------------------------------------------------------------------------------------

_CTES["kept_waits"] = (
    ("raw_waits",),
    f"""
  SELECT * FROM (
    SELECT w.*, MAX(req) OVER (PARTITION BY instance_id, instance_started, wait_type ORDER BY snapshot_date
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
    FROM raw_waits w
    WHERE wait_type NOT IN {_INNOCUOUS_SEEN}) h
  WHERE req > COALESCE(high, 0)""",
)
_DELTA = """
  SELECT k.instance_id, k.snapshot_date, k.wait_type,
         CAST(k.req - COALESCE(LAG(k.req) OVER w, 0) AS BIGINT) AS wait_requests,
         CAST(k.tim - COALESCE(LAG(k.tim) OVER w, 0) AS BIGINT) AS wait_time,
         CAST(k.sig - COALESCE(LAG(k.sig) OVER w, 0) AS BIGINT) AS signal_wait_time,
         k.req AS cumulative_wait_requests, k.tim AS cumulative_wait_time, k.sig AS cumulative_signal_wait_time,
         CAST(q.interval_s AS BIGINT) AS interval_in_seconds, q.first_measure AS first_measure_from_start
  FROM {source} k JOIN seq q USING (instance_id, snapshot_date)
  WINDOW w AS (PARTITION BY k.instance_id, k.instance_started, k.wait_type ORDER BY k.snapshot_date)"""
_CTES["waits"] = (("kept_waits", "seq"), _DELTA.format(source="kept_waits"))
_CTES["quiet"] = (
    ("raw_waits",),
    """
  SELECT wait_type FROM (
    SELECT wait_type, low * COUNT(*) OVER () > SUM(low) OVER () AS listed
    FROM (SELECT wait_type, SUM(CASE WHEN req < 10 THEN 1 ELSE 0 END) AS low FROM raw_waits GROUP BY wait_type) t) l
  WHERE listed""",
)
_CTES["kept_custom"] = (
    ("raw_waits", "quiet"),
    _CTES["kept_waits"][1].replace(f"wait_type NOT IN {_INNOCUOUS_SEEN}", "wait_type NOT IN (SELECT wait_type FROM quiet)"),
)
# A run told to start over acts like a restart for all rows that have requests by then.
_CTES["reset_waits"] = (
    ("raw_waits",),
    f"""
  SELECT * EXCLUDE (instance_started),
         CASE WHEN snapshot_date >= forced_at AND instance_started < forced_at AND seen THEN forced_at ELSE instance_started END
           AS instance_started
  FROM (
    SELECT w.*, TIMESTAMP '2024-01-20 08:00:00' AS forced_at,
           BOOL_OR(snapshot_date = TIMESTAMP '2024-01-20 08:00:00' AND req > 0)
             OVER (PARTITION BY instance_id, instance_started, wait_type) AS seen
    FROM raw_waits w
    WHERE wait_type NOT IN {_INNOCUOUS_SEEN}) r""",
)
_CTES["kept_reset"] = (("reset_waits",), _CTES["kept_waits"][1].replace("FROM raw_waits w", "FROM reset_waits w"))
_CTES["reset_seq"] = (
    ("seq",),
    """
  SELECT * REPLACE (
    first_measure OR snapshot_date = TIMESTAMP '2024-01-20 08:00:00' AS first_measure,
    CASE WHEN snapshot_date = TIMESTAMP '2024-01-20 08:00:00'
         THEN CAST(date_diff('second', instance_started, snapshot_date) AS INT) ELSE interval_s END AS interval_s)
  FROM seq""",
)
_WAIT = """
SELECT instance_id, snapshot_date, wait_type, wait_requests, wait_time, signal_wait_time,
       cumulative_wait_requests, cumulative_wait_time, cumulative_signal_wait_time,
       interval_in_seconds, first_measure_from_start{more}
FROM {source}"""
_WAIT_AVERAGES = f"""
       {_half_up("wait_time", "wait_requests")} AS wait_time_request_average,
       {_half_up("signal_wait_time", "wait_requests")} AS signal_wait_time_request_average"""

# ---- IO, views -----------------------------------------------------------------------------------

_CTES["files"] = (
    ("raw_io", "io_seq"),
    "SELECT c.instance_id, c.snapshot_date, c.database_name, c.logical_filename, c.db_file_type, "
    + ", ".join(f"CASE WHEN q.first_measure THEN c.{m} ELSE c.{m} - p.{m} END AS {m}" for m in _IO)
    + ", CAST((200 * CAST(c.size_on_disk_bytes AS HUGEINT) + 1073741824) // 2147483648 AS BIGINT) AS size_on_disk_GB"
    + ", CAST(0 AS INT) AS pdw_node_id, q.interval_s AS interval_in_seconds, "
    + ", ".join(f"c.{m} AS cumulative_{m}" for m in _IO)
    + ", q.first_measure AS first_measure_from_start"
    + " FROM raw_io c JOIN io_seq q USING (instance_id, snapshot_date)"
    + " LEFT JOIN raw_io p ON p.instance_id = c.instance_id AND p.database_name = c.database_name"
    + " AND p.logical_filename = c.logical_filename AND p.snapshot_date = q.prev_snapshot",
)
_CTES["facts"] = (
    ("perf", "dim"),
    """
  SELECT p.instance_id, p.snapshot_date, p.inst_perf_param_id, p.first_measure, p.v, d.ok, d.ck, d.ik
  FROM perf p JOIN dim d USING (inst_perf_param_id)""",
)


def _pick(column: str, condition: str, value: str = "v") -> str:
    return f"CAST(MAX(CASE WHEN {condition} THEN {value} END) AS BIGINT) AS {column}"


_GB = "CAST((2 * CAST(v AS HUGEINT) + 1048576) // 2097152 AS BIGINT)"
_THROUGHPUT = ", ".join(
    _pick(column, f"ck = '{counter}'" + (" AND ik = '_total'" if total else ""))
    for column, counter, total in (
        ("Batch_Requests_sec", "batch requests/sec", False),
        ("Transactions_sec", "transactions/sec", True),
        ("logical_reads_sec", "page lookups/sec", False),
        ("Page_reads_sec", "page reads/sec", False),
        ("Page_writes_sec", "page writes/sec", False),
        ("Readahead_pages_sec", "readahead pages/sec", False),
        ("Log_Flush_Waits_sec", "log flush waits/sec", True),
        ("Bulk_Copy_Throughput_sec", "bulk copy throughput/sec", True),
        ("Errors_sec", "errors/sec", True),
        ("Logins_sec", "logins/sec", False),
        ("Logouts_sec", "logouts/sec", False),
        ("Connection_Reset_sec", "connection reset/sec", False),
        ("SQL_ReCompilations_sec", "sql re-compilations/sec", False),
        ("SQL_Compilations_sec", "sql compilations/sec", False),
    )
)
_MEMORY = ", ".join(
    [
        _pick(column, f"ck = '{counter} memory (kb)'", _GB)
        for column, counter in (
            ("Total_Server_Memory_GB", "total server"),
            ("Target_Server_Memory_GB", "target server"),
            ("Database_Cache_Memory_GB", "database cache"),
            ("StolenServer_Memory_GB", "stolen server"),
            ("Maximum_Workspace_Memory_GB", "maximum workspace"),
            ("Granted_Workspace_Memory_GB", "granted workspace"),
            ("Free_Memory_GB", "free"),
            ("Connection_Memory_GB", "connection"),
        )
    ]
    + [_pick("Page_life", "ck = 'page life expectancy'")]
)
_WAITTIME = ", ".join(
    _pick(column, f"ck = '{counter}' AND ik = 'average wait time (ms)'")
    for column, counter in (
        ("Lock_waits_ms", "lock waits"),
        ("Page_IO_latch_waits_ms", "page io latch waits"),
        ("Network_IO_waits_ms", "network io waits"),
        ("Page_latch_waits_ms", "page latch waits"),
        ("Memory_grant_queue_waits_ms", "memory grant queue waits"),
        ("Wait_for_the_worker_ms", "wait for the worker"),
        ("Log_write_waits_ms", "log write waits"),
        ("NON_Page_latch_waits_ms", "non-page latch waits"),
        ("Log_buffer_waits_ms", "log buffer waits"),
    )
)
_BY = "instance_id, snapshot_date"
_CTES["throughput"] = (("facts",), f"SELECT {_BY}, {_THROUGHPUT} FROM facts WHERE NOT first_measure GROUP BY {_BY}")
_CTES["memory"] = (
    ("facts",),
    f"""SELECT {_BY}, {_MEMORY} FROM facts
  WHERE NOT first_measure AND (ok LIKE '%memory manager' OR ok LIKE '%buffer manager') AND ik IN ('_total', '')
  GROUP BY {_BY}""",
)
_CTES["waittime"] = (
    ("facts",),
    f"SELECT {_BY}, {_WAITTIME} FROM facts WHERE NOT first_measure AND ok LIKE '%wait statistics' GROUP BY {_BY}",
)


def _ratio(column: str, parent: str, base: str, instance: str) -> str:
    part = f"MAX(CASE WHEN pd.ck = '{parent}' AND pd.ik = '{instance}' THEN pp.v END)"
    whole = f"NULLIF(MAX(CASE WHEN bd.ck = '{base}' AND bd.ik = '{instance}' THEN bp.v END), 0)"
    return f"{_half_up(part, whole, 10000)} AS {column}"


_CTES["ratios"] = (
    ("perf", "dim"),
    f"""
  SELECT bp.instance_id, bp.snapshot_date,
         {_ratio("sql_cpu_usage", "cpu usage %", "cpu usage % base", "default")},
         {_ratio("sql_cpu_effective", "cpu effective %", "cpu effective % base", "default")},
         {_ratio("buffer_cache_hit_ratio", "buffer cache hit ratio", "buffer cache hit ratio base", "")}
  FROM dim bd JOIN dim pd ON bd.parent_param_id = pd.inst_perf_param_id
  JOIN perf bp ON bp.inst_perf_param_id = bd.inst_perf_param_id
  JOIN perf pp ON pp.inst_perf_param_id = pd.inst_perf_param_id
    AND pp.instance_id = bp.instance_id AND pp.snapshot_date = bp.snapshot_date
  WHERE bd.log_ind AND pd.log_ind
  GROUP BY bp.instance_id, bp.snapshot_date""",
)
_REPORT_COLUMNS = """sql_cpu_usage, sql_cpu_effective, Total_Server_Memory_GB, Granted_Workspace_Memory_GB, Page_life,
  Batch_Requests_sec, Transactions_sec, logical_reads_sec, Page_reads_sec, Page_writes_sec, Readahead_pages_sec,
  Log_Flush_Waits_sec, Bulk_Copy_Throughput_sec, Lock_waits_ms, Page_IO_latch_waits_ms, Network_IO_waits_ms,
  Page_latch_waits_ms, Memory_grant_queue_waits_ms, Wait_for_the_worker_ms, Log_write_waits_ms,
  NON_Page_latch_waits_ms, Log_buffer_waits_ms, buffer_cache_hit_ratio, Target_Server_Memory_GB,
  Database_Cache_Memory_GB, Free_Memory_GB"""
_REPORT = f"""
SELECT instance_id, snapshot_date, {_REPORT_COLUMNS}
FROM ratios JOIN memory USING (instance_id, snapshot_date)
JOIN throughput USING (instance_id, snapshot_date) JOIN waittime USING (instance_id, snapshot_date)"""

# ---- configuration, resources --------------------------------------------------------------------

_CTES["config"] = (
    (),
    """
  SELECT instance_id, snapshot_date, 'inst' || CAST(instance_id AS VARCHAR) AS instance_nm,
         'host' || CAST(instance_id % 4 AS VARCHAR) AS server_nm, CAST(0 AS INT) AS is_clustered,
         CAST(CASE WHEN day(snapshot_date) < 12 + instance_id % 4 THEN 8 WHEN day(snapshot_date) < 22 THEN 16 ELSE 8 END
           AS INT) AS logical_proc_count,
         CAST(CASE WHEN day(snapshot_date) < 15 THEN 6400 ELSE 12800 END AS BIGINT) AS physical_memory_gb,
         'Telemetry Server 16.0.4095.4 (X64) on Linux, patch ' || CAST(day(snapshot_date) // 9 AS INT) AS file_version,
         CASE WHEN instance_id % 4 = 0 THEN 'SQL Database' ELSE 'Enterprise' END AS engine_edition,
         CAST(48 AS INT) AS committed_target_gb
  FROM (SELECT DISTINCT CAST(user_id // 10 AS INT) AS instance_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS snapshot_date
        FROM events) d""",
)


def _changes(source: str) -> str:
    return f"""
  SELECT * EXCLUDE (was) FROM (
    SELECT c.*, LAG(logical_proc_count || '|' || physical_memory_gb || '|' || file_version)
                  OVER (PARTITION BY instance_id ORDER BY snapshot_date) AS was
    FROM {source} c) x
  WHERE was IS DISTINCT FROM (logical_proc_count || '|' || physical_memory_gb || '|' || file_version)"""


_CTES["resource"] = (
    (),
    """
  SELECT CAST(user_id // 10 AS INT) AS instance_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS end_time,
         MAX(CAST(ROUND(value * 100) AS BIGINT) % 10001) AS avg_cpu_percent,
         MIN(CAST(ROUND(value * 100) AS BIGINT) % 10001) AS avg_data_io_percent,
         CAST(COUNT(*) AS INT) AS dtu_limit
  FROM events GROUP BY 1, 2""",
)

# ---- space ---------------------------------------------------------------------------------------

_CTES["dbs"] = ((), "SELECT * FROM (VALUES ('db0'), ('db1'), ('db2')) v(database_name)")
_CTES["parts"] = (
    (),
    """
  SELECT 'db' || CAST(o_orderkey % 3 AS VARCHAR) AS database_name, o_orderkey AS hobt_id, o_custkey // 15 AS object_id,
         CAST(o_orderkey % 4 AS INT) AS index_id, CAST(1 + (o_orderkey % 5) % 3 AS INT) AS partition_number,
         o_orderkey % 1000 AS n, o_orderdate
  FROM orders""",
)
_CTES["units"] = (
    (),
    """
  SELECT 'db' || CAST(l_orderkey % 3 AS VARCHAR) AS database_name, l_orderkey AS container_id,
         CAST(1 + l_linenumber % 3 AS INT) AS data_space_id, CAST(l_quantity AS BIGINT) AS total_pages,
         GREATEST(CAST(l_quantity AS BIGINT) - l_linenumber, 0) AS used_pages
  FROM lineitem""",
)
_CTES["containers"] = (
    ("units",),
    """
  SELECT database_name, container_id, CAST(SUM(used_pages) AS BIGINT) AS used_pages,
         CAST(SUM(total_pages) AS BIGINT) AS total_pages, MIN(data_space_id) AS data_space_id,
         MAX(data_space_id) AS max_data_space_id, COUNT(*) AS unit_count
  FROM units GROUP BY 1, 2""",
)
_CTES["based"] = (
    ("parts", "containers", "units"),
    """
  SELECT p.database_name, p.object_id, MAX(p.index_id) AS index_id, CAST(SUM(p.n) AS BIGINT) AS num_rows,
         MAX(p.partition_number) AS num_partitions,
         CAST(SUM(c.used_pages) AS BIGINT) AS table_used_pages, CAST(SUM(c.total_pages) AS BIGINT) AS table_total_pages,
         MAX(c.used_pages) AS largest_used, MAX(c.total_pages) AS largest_total,
         MAX(c.max_data_space_id) AS largest_space,
         MAX(r.r_name) AS filegroup_name
  FROM parts p JOIN containers c ON c.database_name = p.database_name AND c.container_id = p.hobt_id
  JOIN region r ON r.r_regionkey = c.data_space_id
  WHERE p.index_id <= 1 GROUP BY 1, 2""",
)
_CTES["spaces_used"] = (
    ("parts", "units"),
    """
  SELECT p.database_name, p.object_id, CAST(COUNT(DISTINCT u.data_space_id) AS INT) AS filegroup_count
  FROM parts p JOIN units u ON u.database_name = p.database_name AND u.container_id = p.hobt_id
  WHERE p.index_id <= 1 GROUP BY 1, 2""",
)
_INDEXED = """
  SELECT p.database_name, p.object_id, CAST(SUM(u.used_pages) AS BIGINT) AS index_used_pages,
         CAST(SUM(u.total_pages) AS BIGINT) AS index_total_pages, CAST(COUNT(*) AS INT) AS index_count
  FROM parts p JOIN units u ON u.database_name = p.database_name AND u.container_id = p.hobt_id AND p.index_id >= 2
  GROUP BY p.database_name, p.object_id{more}"""
_CTES["indexed"] = (("parts", "units"), _INDEXED.format(more=""))
_CTES["indexed_parts"] = (("parts", "units"), _INDEXED.format(more=", p.partition_number"))
_CTES["counted"] = (
    (),
    """
  SELECT 'db' || CAST(p_partkey % 3 AS VARCHAR) AS database_name, p_partkey // 20 AS object_id, COUNT(*) AS column_count
  FROM part GROUP BY 1, 2""",
)
_CTES["stats"] = (
    ("parts",),
    """
  SELECT database_name, object_id, index_id, MAX(o_orderdate) AS last_updated, COUNT(*) AS modification_counter
  FROM parts WHERE object_id % 2 = 1 GROUP BY 1, 2, 3""",
)


def _table_usage(indexes: str, used: str, total: str, groups: str, mb: tuple[int, int], gb: tuple[int, int]) -> str:
    """Sizes in thousandths: pages * page size, as an exact fraction per unit."""

    def size(pages: str, fraction: tuple[int, int], name: str) -> str:
        num, den = fraction
        return f"CAST((2 * CAST({pages} AS HUGEINT) * {num} + {den}) // (2 * {den}) AS BIGINT) AS {name}"

    used_pages = f"(b.{used} + COALESCE(i.index_used_pages, 0))"
    total_pages = f"(b.{total} + COALESCE(i.index_total_pages, 0))"
    return f"""
SELECT n.n_name AS schema_name, s.s_name AS table_name,
       {size(used_pages, gb, "total_table_object_size_used_in_Gb")},
       {size(total_pages, gb, "total_table_object_size_allocated_in_Gb")},
       {size(used_pages, mb, "total_table_object_size_used_in_Mb")},
       {size(total_pages, mb, "total_table_object_size_allocated_in_Mb")},
       b.num_rows AS row_count, b.num_partitions AS partition_count, COALESCE(i.index_count, 0) AS index_count,
       c.column_count, {groups} AS filegroup_count, 'USER_TABLE' AS table_type,
       TIMESTAMP '2020-01-01 00:00:00' AS table_create_date,
       TIMESTAMP '2020-01-01 00:00:00' + to_days(CAST(s.s_suppkey % 365 AS INT)) AS table_modification_date,
       CASE WHEN b.num_partitions > 1 THEN 'Partitioned' ELSE b.filegroup_name END AS db_filegroup_name,
       d.database_name, t.last_updated AS last_statistics_date, t.modification_counter AS dml_cnt_since_stats_dt
FROM supplier s CROSS JOIN dbs d
JOIN nation n ON n.n_nationkey = s.s_nationkey
JOIN counted c ON c.database_name = d.database_name AND c.object_id = s.s_suppkey
JOIN based b ON b.database_name = d.database_name AND b.object_id = s.s_suppkey
JOIN spaces_used g ON g.database_name = d.database_name AND g.object_id = s.s_suppkey
LEFT JOIN {indexes} i ON i.database_name = d.database_name AND i.object_id = s.s_suppkey
LEFT JOIN stats t ON t.database_name = d.database_name AND t.object_id = s.s_suppkey AND t.index_id = b.index_id"""


_TABLE_CTES = ("dbs", "counted", "based", "spaces_used", "stats")
_CTES["db_files"] = (
    ("raw_io",),
    """
  SELECT instance_id, database_name, logical_filename, db_file_name, db_file_type,
         MAX(size_on_disk_bytes) // 8192 AS size, MAX(num_of_reads) AS used
  FROM raw_io GROUP BY 1, 2, 3, 4, 5""",
)
_SIZE_USED = f"""{_half_up("size * 8", "1024")} AS db_file_size_in_mb, {_half_up("used * 8", "1024")} AS db_file_used_in_mb"""
_CTES["drives"] = (
    (),
    """
  SELECT instance_id, drive, total AS total_size_mb, free AS free_space_mb, total - free AS used_space_mb,
         CAST((20000 * free + total) // (2 * total) AS BIGINT) AS free_percentage
  FROM (
    SELECT CAST(s_suppkey // 10 AS INT) AS instance_id, substring('CDEFG', CAST(s_nationkey % 5 AS INT) + 1, 1) AS drive,
           CAST(SUM(CAST(ROUND(ABS(s_acctbal)) AS BIGINT)) AS BIGINT) AS free, COUNT(*) * 20000 AS total
    FROM supplier GROUP BY 1, 2) x""",
)
_CTES["breaches"] = (
    ("drives", "raw_io"),
    """
  SELECT * FROM drives d
  WHERE free_percentage < 2000 AND EXISTS (
    SELECT 1 FROM raw_io r WHERE r.instance_id = d.instance_id AND upper(substr(r.db_file_name, 1, 1)) = d.drive)""",
)


# ---- streams -------------------------------------------------------------------------------------

# ---- the queries ---------------------------------------------------------------------------------

_ARCHIVE_CUTOFF = "TIMESTAMP '2024-01-16 12:00:00'"


def _types(*types: int) -> str:
    return _SNAP.format(source="perf") + f" WHERE counter_type IN ({', '.join(map(str, types))})"


def _io_summary(where: str = "") -> str:
    return f"""
SELECT instance_id, database_name, CAST(SUM(num_of_reads) AS BIGINT) AS total_reads,
       CAST(SUM(num_of_writes) AS BIGINT) AS total_writes, CAST(SUM(io_stall_ms) AS BIGINT) AS sum_io_stall_ms
FROM files {where} GROUP BY instance_id, database_name"""


def _latch(divisor: str) -> str:
    averages = _AVERAGES.replace("gained", "latch_gained").format(value=_half_up("c.gain", _divisor(divisor)))
    return _SNAP.format(source=f"({averages}) a")


_SHARE = f"""
SELECT instance_id, snapshot_date, wait_type,
       {_half_up("wait_time", "all_wait", 10000)} AS wait_pct,
       {_half_up("signal_wait_time", "NULLIF(all_signal, 0)", 10000)} AS signal_wait_pct, {_WAIT_AVERAGES}
FROM (
  SELECT w.*, t.all_wait, t.all_signal
  FROM waits w JOIN (
    SELECT instance_id, snapshot_date, SUM(wait_time) AS all_wait, SUM(signal_wait_time) AS all_signal
    FROM waits GROUP BY 1, 2) t USING (instance_id, snapshot_date)) s
WHERE wait_time > 0"""
_WITHIN = "snapshot_date BETWEEN TIMESTAMP '2024-01-12 00:00:00' AND TIMESTAMP '2024-01-22 12:00:00'"
_IO_WITHIN = "snapshot_date BETWEEN TIMESTAMP '1996-06-01 00:00:00' AND TIMESTAMP '1998-02-01 00:00:00'"


def _io_kind(kind: str) -> str:
    where = f"WHERE {_IO_WITHIN}" + ("" if kind == "all" else f" AND lower(db_file_type) = '{kind}'")
    return f"SELECT *, '{kind}' AS files FROM ({_io_summary(where)}) x"


_CONFIG = "instance_id, snapshot_date, instance_nm, server_nm, is_clustered, logical_proc_count, physical_memory_gb, file_version, engine_edition, committed_target_gb"
_RESOURCE = "SELECT instance_id, end_time, avg_cpu_percent, avg_data_io_percent, dtu_limit FROM resource"

ORACLE_SQL: dict[str, str] = {
    "snapshot_sequence": _sql("SELECT * FROM seq", "seq"),
    "snapshot_bounds": _sql(
        """SELECT instance_id, MAX(snapshot_date) AS last_snapshot, COUNT(*) AS row_count,
       MAX(instance_started) AS instance_started FROM raw_waits GROUP BY 1""",
        "raw_waits",
    ),
    "counter_prefixes": _sql(
        """SELECT DISTINCT instance_id, split_part(object_name, ':', 1) AS prefix FROM raw_counters
WHERE upper(object_name) LIKE 'MSSQL$%'""",
        "raw_counters",
    ),
    "perf_snap": _sql(_SNAP.format(source="perf"), "perf"),
    "counter_rate": _sql(_types(272696576), "perf"),
    "counter_interval": _sql(_types(-1), "perf"),
    "counter_gauge": _sql(_types(65792, 537003264, 1073939712), "perf"),
    "counter_average_ratio": _sql(_latch("gain"), "latch_gained"),
    "counter_average_ratio_cumulative": _sql(_latch("total"), "latch_gained"),
    "counter_first_measure": _sql(_SNAP.format(source="perf") + " WHERE first_measure", "perf"),
    "counter_dimension": _sql(f"SELECT {_DIM} FROM built", "built"),
    "counter_flag_rules": _sql(f"SELECT {_DIM} FROM flagged", "flagged"),
    "counter_flag_rules_cloud": _sql(f"SELECT {_DIM} FROM flagged_cloud", "flagged_cloud"),
    "counter_flag_rules_fleet": _sql(f"SELECT {_DIM}, engine_edition FROM fleet_dim", "fleet_dim"),
    "perf_snap_fleet": _sql(_SNAP.format(source="fleet_perf"), "fleet_perf"),
    "counter_base_links": _sql(f"SELECT {_DIM} FROM dim", "dim"),
    "innocuous_wait_totals": _sql(
        f"""SELECT instance_id, wait_type, COUNT(*) AS samples, MAX(tim) AS max_wait_time_ms
FROM raw_waits WHERE wait_type IN {_INNOCUOUS_SEEN} GROUP BY 1, 2""",
        "raw_waits",
    ),
    "wait_interval": _sql(_WAIT.format(source="waits", more=""), "waits"),
    "wait_interval_custom_list": _sql(
        _WAIT.format(source=f"({_DELTA.format(source='kept_custom')}) x", more=""), "kept_custom", "seq"
    ),
    "wait_interval_reinitialized": _sql(
        _WAIT.format(
            source=f"({_DELTA.format(source='kept_reset').replace('JOIN seq', 'JOIN reset_seq')}) x", more=""
        ),
        "kept_reset",
        "reset_seq",
    ),
    "wait_averages": _sql(
        f"""SELECT instance_id, snapshot_date, wait_type, {_WAIT_AVERAGES},
       {_half_up("cumulative_wait_time", "cumulative_wait_requests")} AS cumulative_wait_time_request_average
FROM waits""",
        "waits",
    ),
    "wait_categories": _sql(
        f"""SELECT * FROM (
  SELECT instance_id, snapshot_date, wait_type, wait_requests, wait_time, signal_wait_time, {_WAIT_AVERAGES},
         CASE WHEN wait_type = 'ASYNC_NETWORK_IO' THEN 'Network IO'
              WHEN wait_type LIKE '%HADR%' THEN 'Always ON'
              WHEN wait_type LIKE 'PAGEIO%' THEN 'Buffer IO'
              WHEN wait_type LIKE 'PAGELATCH%' THEN 'Memory Buffer'
              WHEN wait_type IN ('SOS_WORKER_MIGRATION', 'THREADPOOL', 'SOS_SCHEDULER_YIELD') THEN 'CPU'
              WHEN wait_type LIKE 'LATCH%' THEN 'Latch'
              WHEN wait_type LIKE 'LCK%' THEN 'Lock'
              WHEN wait_type = 'CXPACKET' THEN 'Producer Parallelism'
              WHEN wait_type IN ('LOGBUFFER', 'WRITELOG') THEN 'Tran Log IO'
              WHEN wait_type LIKE '%PREEMPTIVE%' THEN 'Preemptive'
              ELSE 'Other' END AS wait_category
  FROM waits WHERE NOT first_measure_from_start) c
WHERE wait_time_request_average > 100""",
        "waits",
    ),
    "wait_share_report": _sql(_SHARE, "waits"),
    "wait_archive_keep": _sql(
        _WAIT.format(source="waits", more="") + f" WHERE snapshot_date > {_ARCHIVE_CUTOFF}", "waits"
    ),
    "wait_archive_move": _sql(
        _WAIT.format(
            source="waits",
            more=", TIMESTAMP '2024-01-30 12:00:00' AS date_added, 'archiver' AS archived_by_user",
        )
        + f" WHERE snapshot_date <= {_ARCHIVE_CUTOFF}",
        "waits",
    ),
    "wait_archive_tables": _sql(
        _WAIT.format(
            source="waits",
            more=f""", CASE WHEN snapshot_date <= {_ARCHIVE_CUTOFF} THEN TIMESTAMP '2024-01-30 12:00:00' END AS date_added,
       CASE WHEN snapshot_date <= TIMESTAMP '2024-01-09 12:00:00' THEN 'older than 21'
            WHEN snapshot_date <= {_ARCHIVE_CUTOFF} THEN 'older than 14' END AS archived_by_user""",
        ),
        "waits",
    ),
    "io_online": _sql(
        """SELECT s.instance_id, s.snapshot_date, s.database_name, s.logical_filename, s.num_of_reads
FROM raw_io s ASOF LEFT JOIN database_states d
  ON d.instance_id = s.instance_id AND d.database_name = upper(s.database_name) AND d.since <= s.snapshot_date
WHERE COALESCE(d.state_desc, 'ONLINE') = 'ONLINE'""",
        "raw_io",
        "database_states",
    ),
    "io_file_samples": _sql(
        f"""SELECT instance_id, snapshot_date, database_name,
       CASE WHEN tempdb THEN label ELSE logical_filename END AS logical_filename,
       CASE WHEN tempdb THEN label ELSE db_file_name END AS db_file_name,
       CASE WHEN tempdb THEN kind ELSE db_file_type END AS db_file_type,
       {", ".join(_IO)}, size_on_disk_bytes
FROM (
  SELECT * REPLACE (CASE WHEN instance_id % 4 = 0 AND database_name = 'db0' THEN 'tempdb' ELSE database_name END
                      AS database_name),
         instance_id % 4 = 0 AND database_name = 'db0' AS tempdb,
         CASE substr(logical_filename, 5, 2) WHEN 'AF' THEN 'tempdb data unknown' WHEN 'RF' THEN 'tempdb log unknown'
              ELSE 'unk' END AS label,
         CASE substr(logical_filename, 5, 2) WHEN 'AF' THEN 'data' WHEN 'RF' THEN 'log' ELSE 'unk' END AS kind
  FROM raw_io) x""",
        "raw_io",
    ),
    "io_interval": _sql("SELECT * FROM files", "files"),
    "io_summary_all": _sql(_io_summary(), "files"),
    "io_summary_rows": _sql(_io_summary("WHERE lower(db_file_type) = 'rows'"), "files"),
    "io_summary_log": _sql(_io_summary("WHERE lower(db_file_type) = 'log'"), "files"),
    "throughput_pivot": _sql("SELECT * FROM throughput", "throughput"),
    "memory_pivot": _sql("SELECT * FROM memory", "memory"),
    "waittime_pivot": _sql("SELECT * FROM waittime", "waittime"),
    "summary_ratio": _sql("SELECT * FROM ratios", "ratios"),
    "performance_report": _sql(
        f"{_REPORT} WHERE {_WITHIN}",
        "ratios",
        "memory",
        "throughput",
        "waittime",
    ),
    "performance_report_waits": _sql(f"{_SHARE} AND {_WITHIN}", "waits"),
    "performance_report_io": _sql(" UNION ALL ".join(_io_kind(k) for k in ("all", "rows", "log")), "files"),
    "performance_report_from_views": _sql(_REPORT, "ratios", "memory", "throughput", "waittime"),
    "config_change_log": _sql(f"SELECT {_CONFIG} FROM ({_changes('config')}) c", "config"),
    "config_latest": _sql(
        f"""SELECT {_CONFIG}, md5(concat_ws('|', length(instance_nm) || ':' || instance_nm,
         length(CAST(logical_proc_count AS VARCHAR)) || ':' || logical_proc_count, length(engine_edition) || ':' || engine_edition))
         AS short_hash
FROM config c WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM config m WHERE m.instance_id = c.instance_id)""",
        "config",
    ),
    "config_changes_since_stored": _sql(
        f"SELECT {_CONFIG} FROM ({_changes('config')}) c WHERE snapshot_date > TIMESTAMP '2024-01-20 00:00:00'", "config"
    ),
    "edition_labels": _sql(
        """SELECT edition_code,
       CASE edition_code WHEN 1 THEN 'Personal or Desktop Engine' WHEN 2 THEN 'Standard' WHEN 3 THEN 'Enterprise'
         WHEN 4 THEN 'Express' WHEN 5 THEN 'SQL Database' WHEN 6 THEN 'Azure Synapse Analytics'
         WHEN 8 THEN 'Azure SQL Managed Instance' WHEN 9 THEN 'Azure SQL Edge'
         WHEN 11 THEN 'Azure Synapse serverless SQL pool' END AS edition, COUNT(*) AS samples
FROM (SELECT CAST((CASE WHEN instance_id % 4 = 0 THEN 5 ELSE 3 END + instance_id + day(snapshot_date)) % 13 AS INT)
        AS edition_code FROM config) c
GROUP BY 1, 2""",
        "config",
    ),
    "config_attributes_pivot": _sql(
        """SELECT instance_id, snapshot_date, file_version, '16.0.4095.4' AS instance_version, server_nm AS os_version
FROM config c""",
        "config",
    ),
    "resource_new_rows": _sql(f"{_RESOURCE} WHERE end_time >= TIMESTAMP '2024-01-16 00:00:00'", "resource"),
    "resource_new_rows_nullaware": _sql(
        f"""{_RESOURCE} WHERE end_time NOT IN (
  SELECT end_time FROM resource WHERE end_time < TIMESTAMP '2024-01-16 00:00:00' AND instance_id % 2 = 0)""",
        "resource",
    ),
    "file_usage": _sql(
        f"""SELECT instance_id, database_name, logical_filename AS logical_file_name, db_file_type, db_file_name,
       'ONLINE' AS db_file_state, CASE WHEN db_file_type = 'LOG' THEN 'LOG' ELSE r_name END AS db_filegroup_name,
       {_SIZE_USED}
FROM db_files LEFT JOIN region ON r_regionkey = 1""",
        "db_files",
    ),
    "legacy_file_usage": _sql(
        f"""SELECT database_name, logical_filename AS logical_file_name, db_file_name,
       CASE WHEN db_file_type = 'LOG' THEN 'LOG' ELSE r_name END AS db_filegroup_name,
       upper(substr(db_file_name, 1, 3)) AS server_drive_partition, {_SIZE_USED}
FROM db_files LEFT JOIN region ON r_regionkey = 1""",
        "db_files",
    ),
    "drive_prefix": _sql(
        """SELECT instance_id, upper(substr(db_file_name, 1, 1)) AS drive,
       upper(substr(db_file_name, 1, 3)) AS server_drive_partition, COUNT(*) AS files
FROM raw_io GROUP BY 1, 2, 3""",
        "raw_io",
    ),
    "table_column_counts": _sql("SELECT * FROM counted", "counted"),
    "container_rollup": _sql("SELECT * FROM containers", "containers"),
    "table_partition_rollup": _sql(
        """SELECT b.database_name, b.object_id, index_id, num_rows, num_partitions, table_used_pages, table_total_pages,
       filegroup_count, filegroup_name
FROM based b JOIN spaces_used USING (database_name, object_id)""",
        "based",
        "spaces_used",
    ),
    "table_index_rollup": _sql("SELECT * FROM indexed", "indexed"),
    "table_usage": _sql(
        _table_usage(
            "indexed", "table_used_pages", "table_total_pages", "g.filegroup_count", (8000, 1024), (8000, 1048576)
        ),
        *_TABLE_CTES,
        "indexed",
    ),
    "table_usage_parity": _sql(
        _table_usage("indexed_parts", "largest_used", "largest_total", "b.largest_space", (8192, 1024), (8192, 1048576)),
        *_TABLE_CTES,
        "indexed_parts",
    ),
    "legacy_table_usage": _sql(
        f"""SELECT d.database_name, r.r_name AS db_filegroup_name, s.s_name AS table_name,
       {_half_up("i.pages * 8", "1024")} AS table_size_used_in_mb, i.pages * 800 AS table_size_used_in_kb,
       {_half_up("i.pages * 16", "1024")} AS total_table_object_size_used_in_mb,
       i.pages * 1600 AS total_table_object_size_used_in_kb,
       {_half_up("i.pages * 24", "1024")} AS total_table_object_size_allocated_in_mb,
       i.pages * 2400 AS total_table_object_size_allocated_in_kb,
       i.row_count, CASE i.index_id WHEN 0 THEN 'Heap Table' ELSE 'Clustered Table' END AS table_type,
       c.column_count, i.stats_date AS last_statistics_date, i.modified AS dml_cnt_since_stats_dt
FROM supplier s CROSS JOIN dbs d
JOIN (SELECT database_name, object_id, index_id, COUNT(*) AS pages, CAST(SUM(n) AS BIGINT) AS row_count,
             CAST(SUM(hobt_id % 7) AS BIGINT) AS modified, MAX(o_orderdate) AS stats_date
      FROM parts WHERE index_id <= 1 GROUP BY 1, 2, 3) i
  ON i.database_name = d.database_name AND i.object_id = s.s_suppkey
JOIN counted c ON c.database_name = d.database_name AND c.object_id = s.s_suppkey
LEFT JOIN region r ON r.r_regionkey = 1 + s.s_suppkey % 3
WHERE s.s_suppkey % 10 <> 0""",
        "dbs",
        "parts",
        "counted",
    ),
    "drive_usage": _sql("SELECT * FROM drives", "drives"),
    "capacity_breaches": _sql("SELECT * FROM breaches", "breaches"),
    "capacity_message": _sql(
        """SELECT d.instance_id, b.breaching,
       string_agg(' Drive: ' || drive || ' Free (%): ' || CAST(free_percentage // 100 AS VARCHAR) || '.'
         || lpad(CAST(free_percentage % 100 AS VARCHAR), 2, '0') || chr(9) || 'Space Free (MB): '
         || CAST(free_space_mb AS VARCHAR) || '.00 Total Space (MB): ' || CAST(total_size_mb AS VARCHAR) || '.00'
         || chr(13), '' ORDER BY drive) AS message
FROM drives d JOIN (SELECT instance_id, COUNT(*) AS breaching FROM breaches GROUP BY 1) b USING (instance_id)
GROUP BY 1, 2""",
        "breaches",
    ),
    "stream_counter_delta": _sql(_SNAP.format(source="perf"), "perf"),
    "stream_report_window": """
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, event_type, COUNT(*) AS events,
       CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) AS window_start FROM events) e
WHERE window_start + INTERVAL 30 MINUTE <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE
GROUP BY 1, 2, 3""",
    "stream_report_accounts": _sql(
        """SELECT delivery, COUNT(*) AS arrived, 0 AS undated, COUNT(*) FILTER (in_time) AS kept, COUNT(*) FILTER (NOT in_time) AS missed
FROM delivered GROUP BY 1""",
        "delivered",
    ),
    "stream_report_closed": _sql(
        """SELECT window_start, window_end, event_type, in_time, COUNT(*) AS events, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM delivered
WHERE NOT in_time OR window_end <= (SELECT MAX(ts) - INTERVAL 10 MINUTE FROM delivered)
GROUP BY 1, 2, 3, 4""",
        "delivered",
    ),
    "counter_unrated": _sql(
        """SELECT c.instance_id, c.snapshot_date, c.inst_perf_param_id, CAST(c.total AS BIGINT) AS cumulative_perf_value,
       c.interval_s AS measurement_interval_s
FROM fallen_staged c
LEFT JOIN fallen_staged p ON p.instance_id = c.instance_id AND p.inst_perf_param_id = c.inst_perf_param_id
  AND p.snapshot_date = c.prev_snapshot
WHERE NOT c.first_measure AND c.total < COALESCE(p.total, 0) AND c.counter_type IN (272696576, -1)""",
        "fallen_staged",
    ),
    "stream_resource_dedup": """
SELECT DISTINCT CAST(user_id // 10 AS INT) AS instance_id,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_hours(CAST(hour(ts) AS INT)) AS end_time
FROM events""",
}
_STORED = {
    "instance": "config_change_log",
    "perf_snap": "perf_snap_fleet",
    "wait_summary": "wait_interval",
    "filestats": "io_file_samples",
    "file_usage": "file_usage",
    "drive_usage": "drive_usage",
    "resource_history": None,
}
ORACLE_SQL["monitors_stored"] = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, COUNT(*) AS stored, COUNT(DISTINCT instance_id) AS instances FROM "
    f"({ORACLE_SQL[name] if name else _sql('SELECT * FROM resource', 'resource')}) t_{kind}"
    for kind, name in _STORED.items()
)
