"""Per-runner state in batch form: deduplication and rolling features with exact late-event and tie semantics.

An event counts what its runner sent within the window up to and including itself, in arrival order. Nothing is dropped
for lateness: a late event is judged as of the newest time seen before it. With `eff` that running maximum, a sliding sum
is the running sum up to the event less the running sum of what is older than the window. A sliding distinct count is the
running count of values whose last occurrence had left the window, less that of values which have left it since. Both use
frames that start at the first row, so each event costs the same however many the window holds, and one exchange on the
runner serves them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.settings import LIVE, Settings

KEY, ORDER = "runner_ip", "offset"
#: Long windows in a slice of a key's timeline, and offsets in a slice of its arrivals.
SLICE_WIDTHS, ARRIVALS = 8, 1_000_000


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else key


def arrival(key: str | list[str] = KEY) -> Window:
    return Window.partitionBy(*_keys(key)).orderBy(ORDER)


def with_effective_time(df: DataFrame, key: str | list[str] = KEY) -> DataFrame:
    """df with eff: the newest event time of the runner up to the row, in arrival order."""
    return df.withColumn("eff", F.max("ts_ms").over(arrival(key).rowsBetween(Window.unboundedPreceding, 0)))


def _is(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("long")


def measures() -> dict[str, tuple[str, Column]]:
    """Feature -> (window, what an event adds to it)."""
    kind = lambda t: _is(F.col("event_type") == t)
    return {
        "events_1m": ("short", F.lit(1).cast("long")),
        "failed_builds_1m": ("short", kind("BUILD_FAILURE")),
        "dependency_404_1m": ("short", _is(F.col("http_status") == 404)),
        "failed_builds_5m": ("long", kind("BUILD_FAILURE")),
        "oom_kills_5m": ("long", _is((F.col("failure_signature") == "oom") | (F.col("exit_code") == 137))),
        "compile_steps_5m": ("long", kind("COMPILE_STEP")),
        "finished_5m": ("long", _is(F.col("event_type").isin("BUILD_SUCCESS", "BUILD_FAILURE"))),
        "rogue_commands_5m": ("long", F.col("is_rogue_command").cast("long")),
        "failure_signatures_5m": ("long", F.col("is_failure_signature").cast("long")),
        "http_errors_5m": ("long", _is(F.col("http_status") >= 400)),
        "published_bytes_5m": ("long", F.when(F.col("event_type") == "ARTIFACT_PUBLISH", F.col("bytes_sent").cast("long")).otherwise(0)),
        "slow_steps_5m": ("long", F.col("is_slow_step").cast("long")),
        "cache_misses_5m": ("long", F.col("is_cache_miss").cast("long")),
    }


def distincts() -> dict[str, Column]:
    """Feature -> the value whose different ones are counted in the long window; null is not counted."""
    return {
        "unique_projects_5m": F.when(F.col("project") != "", F.col("project")),
        "distinct_exit_codes_5m": F.when(F.col("exit_code") > 0, F.col("exit_code")),
        "distinct_artifacts_5m": F.when(F.col("url_path") != "", F.col("url_path")),
    }


def rolling_features(df: DataFrame, settings: Settings = LIVE, key: str | list[str] = KEY) -> DataFrame:
    """Cleaned events with the rolling features of their runner (or of another key).

    The windows carry what they need and one struct of all other columns, so a sort or window copies a few fields a row,
    however wide the event is.
    """
    keys, values, width = _keys(key), measures(), {"short": settings.short_ms, "long": settings.long_ms}
    columns = [*df.columns, *([] if "eff" in df.columns else ["eff"])]
    plain = [*keys, ORDER, "eff" if "eff" in df.columns else "ts_ms"]
    packed = [c for c in df.columns if c not in plain]
    out = df.select(
        *plain, *[v.alias(f"_v_{name}") for name, v in distincts().items()], F.struct(*[v.alias(name) for name, (_, v) in values.items()]).alias("_m"), F.struct(*packed).alias("_row")
    )
    out = out if "eff" in df.columns else with_effective_time(out, key)
    for name in distincts():
        v, mark = f"_v_{name}", Window.partitionBy(*keys, f"_v_{name}").orderBy(ORDER)
        before, after = F.lag("eff").over(mark), F.lead("eff").over(mark)
        known = F.col(v).isNotNull()
        out = out.withColumns(
            {
                f"_new_{name}": _is(known & (before.isNull() | (F.col("eff") - before > width["long"]))),
                f"_last_{name}": _is(known & (after.isNull() | (after - F.col("eff") > width["long"]))),
            }
        ).drop(v)
    # effective time never falls in order of arrival, so one sort serves both frames
    so_far = Window.partitionBy(*keys).orderBy("eff", ORDER).rowsBetween(Window.unboundedPreceding, 0)
    by_time = Window.partitionBy(*keys).orderBy("eff")
    gone = {w: by_time.rangeBetween(Window.unboundedPreceding, -ms - 1) for w, ms in width.items()}
    nothing = F.lit(0).cast("long")
    out = out.withColumns({f"_so_{name}": F.sum(f"_m.{name}").over(so_far) for name in values} | {f"_so_{name}": F.sum(f"_new_{name}").over(so_far) for name in distincts()})
    result = {name: F.col(f"_so_{name}") - F.coalesce(F.sum(f"_m.{name}").over(gone[w]), nothing) for name, (w, _) in values.items()}
    result |= {name: F.col(f"_so_{name}") - F.coalesce(F.sum(f"_last_{name}").over(gone["long"]), nothing) for name in distincts()}
    out = out.withColumns(result).withColumn("build_frequency", F.col("finished_5m") / 5.0)
    told = [c for c in [*result, "build_frequency"] if c != "finished_5m"]
    return out.select(*[F.col(f"_row.{c}") if c in packed else F.col(c) for c in columns], *told)


def sliced_effective_time(df: DataFrame, key: str = KEY, arrivals: int = ARRIVALS) -> DataFrame:
    """with_effective_time(), for keys of any size: the maximum runs within slices of so many offsets, behind that of all slices before."""
    out = df.withColumn("_arrivals", F.floor(F.col(ORDER) / arrivals))
    before = Window.partitionBy(key).orderBy("_arrivals").rowsBetween(Window.unboundedPreceding, -1)
    ahead = out.groupBy(key, "_arrivals").agg(F.max("ts_ms").alias("_newest")).withColumn("_newest", F.max("_newest").over(before))
    ahead = ahead.select(F.col(key).alias("_key"), F.col("_arrivals").alias("_slice"), "_newest")
    out = out.join(ahead, out[key].eqNullSafe(F.col("_key")) & (F.col("_arrivals") == F.col("_slice"))).drop("_key", "_slice")
    within = arrival([key, "_arrivals"]).rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("eff", F.greatest(F.max("ts_ms").over(within), "_newest")).drop("_arrivals", "_newest")


def sliced_features(df: DataFrame, settings: Settings = LIVE, key: str = KEY, widths: int = SLICE_WIDTHS, arrivals: int = ARRIVALS, tasks: int | None = None) -> DataFrame:
    """rolling_features(), for keys of any size: a key's timeline is cut into slices, each a task of its own.

    Effective time never falls in order of arrival, so a slice of it, `widths` long windows wide, is a run of arrivals. What
    a window of its first events can reach lies in the last window width of the slice before; those events go along as
    history, so they are sent twice, one in `widths` of all. tasks: how many share the slices; None: Spark's choice.
    """
    if widths < 1:
        raise ValueError("a slice must hold a long window")
    width = widths * settings.long_ms
    out = df if "eff" in df.columns else sliced_effective_time(df, key, arrivals)
    here = F.floor(F.col("eff") / width)
    place = lambda n, own: F.struct((here + n).alias("_slice"), F.lit(own).alias("_own"))
    reached = F.col("eff") >= (here + 1) * width - max(settings.long_ms, settings.short_ms)
    places = F.when(reached, F.array(place(0, True), place(1, False))).otherwise(F.array(place(0, True)))
    dealt = out.select("*", F.inline(places))
    dealt = dealt if tasks is None else dealt.repartition(tasks, key, "_slice")
    return rolling_features(dealt, settings, [key, "_slice"]).filter("_own").drop("_slice", "_own")


def dedup_keep_first(df: DataFrame, key: str = KEY) -> DataFrame:
    """The first arrival of each id of a runner."""
    order = Window.partitionBy(key, "event_id").orderBy(ORDER)
    return df.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def dedup_horizon(df: DataFrame, settings: Settings = LIVE, key: str = KEY) -> DataFrame:
    """Drop an id that its runner sent before within the horizon of its newest event time.

    An id is remembered from its last accepted arrival; arrivals of an id that are each within the horizon of the one
    before form a chain. Ids that came once stay as they are; the others are walked in order, holding the last accepted one.
    """
    out = df if "eff" in df.columns else with_effective_time(df, key)
    horizon, offset_type = settings.horizon_ms, df.schema[ORDER].dataType.simpleString()
    sent = Window.partitionBy(key, "event_id")
    marked = out.withColumn("_arrivals", F.count(F.lit(1)).over(sent))
    again = marked.filter("_arrivals > 1").select(key, "event_id", ORDER, "eff")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, at = None, 0
        for pdf in batches:
            keep = []
            for own, event, eff in zip(pdf[key], pdf["event_id"], pdf["eff"], strict=True):
                fresh = (own, event) != last or eff - at > horizon
                keep.append(fresh)
                if fresh:
                    last, at = (own, event), eff
            yield pdf.loc[keep, [key, ORDER]]

    kept = again.repartition(key, "event_id").sortWithinPartitions(key, "event_id", ORDER).mapInPandas(walk, f"{key} string, {ORDER} {offset_type}")
    kept = kept.withColumn("_kept", F.lit(True))
    return marked.join(kept, [key, ORDER], "left").filter((F.col("_arrivals") == 1) | F.col("_kept")).drop("_kept", "_arrivals")


def id_prefix(event_id: Column) -> Column:
    """The first 64 bits of a UUID, whatever the case of its digits."""
    return F.lower(F.substring(F.translate(event_id, "-", ""), 1, 16))


def dedup_recent_n(df: DataFrame, settings: Settings = LIVE, key: str = KEY) -> DataFrame:
    """Drop an id that is among the last N ids accepted from its runner: a ring, walked once for each runner.

    Rows come sorted by runner and arrival and are walked batch by batch, so a task holds one ring and one batch.
    """
    n = settings.recent_ids
    offset_type = df.schema[ORDER].dataType.simpleString()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runner, ring, held, at = object(), [], set(), 0
        for pdf in batches:
            keep = []
            for own, prefix in zip(pdf[key], pdf["_id"], strict=True):
                if own != runner:
                    runner, ring, held, at = own, [None] * n, set(), 0
                fresh = prefix not in held
                keep.append(fresh)
                if fresh:
                    held.discard(ring[at])
                    ring[at] = prefix
                    held.add(prefix)
                    at = (at + 1) % n
            yield pdf.loc[keep, [key, ORDER]]

    ids = df.select(key, ORDER, id_prefix(F.col("event_id")).alias("_id"))
    kept = ids.repartition(key).sortWithinPartitions(key, ORDER).mapInPandas(walk, f"{key} string, {ORDER} {offset_type}")
    return df.join(kept, [key, ORDER], "left_semi")


def idle_restarts(df: DataFrame, settings: Settings = LIVE, arrived: str = "arrived_ms", key: str = KEY) -> DataFrame:
    """df with session: it starts over when a runner was silent for the idle time; features per (runner, session) restart there."""
    gap = F.col(arrived) - F.lag(arrived).over(arrival(key))
    return df.withColumn("session", F.sum(_is(gap > settings.idle_ms)).over(arrival(key).rowsBetween(Window.unboundedPreceding, 0)))


def window_state(df: DataFrame, settings: Settings = LIVE, key: str = KEY) -> DataFrame:
    """What a runner's long window holds at its newest event, as parallel arrays in arrival order; rebuild() reads it back."""
    fields = ["offset", "eff", "event_type", "project", "exit_code", "http_status"]
    out = df if "eff" in df.columns else with_effective_time(df, key)
    newest = F.max("eff").over(Window.partitionBy(key))
    live = out.withColumn("_newest", newest).filter(F.col("eff") >= F.col("_newest") - settings.long_ms)
    rows = live.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("rows"))
    return rows.select(key, *[F.col(f"rows.{f}").alias(f) for f in fields])


def rebuild(state: DataFrame, key: str = KEY) -> DataFrame:
    fields = [c for c in state.columns if c != key]
    return state.select(key, F.inline(F.arrays_zip(*fields)))
