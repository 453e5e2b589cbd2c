"""The three batch jobs: raw exports -> base events -> staged events -> session dimension.

I/O lives only here. A job reads the partitions of its window alone, and its input once: days to
merge or set aside are observed while the rows are written. What a job reports is what it wrote:
days as observed, rows counted from the files' footers. Only days (one value each) come to the
driver.

Beside the partitions the base output holds folders that readers of the dataset skip:
``_exports/export_date=D`` for each export that has been processed, whatever it held,
``_quarantine/export_date=D`` with the export's rows that have no valid date,
``_digests/event_date_dt=D`` with the digests of the day's events, made when rows first come late
for it, and ``_schemas`` (``sources.ledger``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickmodel.functions.dates import parse_yyyymmdd
from clickmodel.functions.urls import ALL_PARAMS
from clickmodel.operators.base import base_model
from clickmodel.operators.dedup import DEDUP_KEYS
from clickmodel.operators.sessions import build_sessions, drop_continued, window_bounds
from clickmodel.operators.staging import stage_events
from clickmodel.plans.planner import PROCESS, plan_dates
from clickmodel.sources import ledger
from clickmodel.sources.files import EXPORT_DAY, days_frame, list_raw_dates, partition_days, read_days, read_partitioned, union_days
from clickmodel.sources.fs import delete_folder
from clickmodel.sources.sinks import observed, partition_rows, write_partitioned

EXPORTS, QUARANTINE, DIGESTS, LATE = "_exports", "_quarantine", "_digests", "_late"
DIGEST = ["digest_a", "digest_b"]
SESSION_DAY = "session_start_date"
# A batch of this many exports at most is written by the tasks that deduplicate it; a longer one is
# shuffled once more, by day, as every task would write a small file for each of its days.
DEALT_DAYS = 31
REPORT = "date date, status string, written boolean, n_rows bigint, n_quarantined bigint"


def processed_days(spark: SparkSession, out_prefix: str) -> list[dt.date]:
    """Days whose export is in the base output: those recorded, and partitions of outputs
    written before exports were recorded."""
    recorded = partition_days(spark, f"{out_prefix}/{EXPORTS}", "export_date")
    return recorded or partition_days(spark, out_prefix)


def _digested(base: DataFrame) -> DataFrame:
    """Base events with the digest (128 bits in two numbers) of what identifies an event. A hash
    passes over NULLs, so the second number also takes in which keys are NULL and the payload as
    text, which names its members; members that only some exports have change neither where they
    are NULL."""
    nulls = [F.col(c).isNull() for c in DEDUP_KEYS]
    return base.withColumns({"digest_a": F.xxhash64(*DEDUP_KEYS, "event_params"), "digest_b": F.xxhash64(*nulls, *DEDUP_KEYS, F.to_json("event_params"))})


def _stored_digests(spark: SparkSession, out_prefix: str, days: list[dt.date]) -> DataFrame:
    """(event_date_dt, digest_a, digest_b) of the stored events of ``days``. Digests are kept beside the
    data, by day; those of a day are made from its stored events when they are first needed, and
    anew if they are not as many as the day's rows."""
    folder = f"{out_prefix}/{DIGESTS}"
    held = set(partition_days(spark, folder))
    stored = {r["date"]: r["n_rows"] for r in partition_rows(spark, out_prefix, "event_date_dt", days).collect()}
    made = {r["date"]: r["n_rows"] for r in partition_rows(spark, folder, "event_date_dt", sorted(held & set(days))).collect()}
    if stale := [d for d in days if made.get(d) != stored.get(d)]:
        write_partitioned(_digested(read_partitioned(spark, out_prefix, stale)).select("event_date_dt", *DIGEST), folder, "event_date_dt")
    return read_partitioned(spark, folder, days)


def _merge_late(spark: SparkSession, late: DataFrame, out_prefix: str, days: list[dt.date]) -> list[dt.date]:
    """Adds base events to days that the output holds already. Only events whose digest the day
    does not have are new, and only days with new events are written; their stored events are
    neither compared nor shuffled by event."""
    staging, folder = f"{out_prefix}/{LATE}", f"{out_prefix}/{DIGESTS}"
    known = _stored_digests(spark, out_prefix, days)
    fresh = _digested(late).join(known, ["event_date_dt", *DIGEST], "left_anti")
    delete_folder(spark, staging)
    touched = write_partitioned(fresh, staging, "event_date_dt")
    if touched:
        added = read_partitioned(spark, staging, touched)
        digests = known.where(F.col("event_date_dt").isin(touched)).unionByName(added.select("event_date_dt", *DIGEST))
        write_partitioned(union_days([read_partitioned(spark, out_prefix, touched), added.drop(*DIGEST)]), out_prefix, "event_date_dt")
        write_partitioned(digests, folder, "event_date_dt")
    delete_folder(spark, staging)
    return touched


def _write_batch(spark: SparkSession, raw_prefix: str, out_prefix: str, batch: list[dt.date],
                 raw_name_flags: bool) -> tuple[set[dt.date], dict[dt.date, int]]:
    """Writes the events of some exports; (days written, rows set aside by export day).

    The exports are scanned once: the rows of days that the output does not hold are written, and
    what the other rows need is observed meanwhile. Only if there are any, the exports are
    read again, for the rows of days that the output holds (a day is never overwritten from
    another day's export alone) and for the exports that hold rows without a valid date.
    """
    held = partition_days(spark, out_prefix)
    raw = read_days(spark, raw_prefix, batch, export_day=True)
    day, seen = parse_yyyymmdd("event_date"), Observation()
    known = day.isin(held) if held else F.lit(False)
    watched = raw.observe(seen, F.collect_set(F.when(known, day).cast("string")).alias("late"),
                          F.collect_set(F.when(day.isNull(), F.col(EXPORT_DAY)).cast("string")).alias("bad"))
    new = watched.where(day.isNotNull() & ~known).drop(EXPORT_DAY)
    few = len(batch) <= DEALT_DAYS
    base = base_model(new, raw_name_flags=raw_name_flags, by_day=few)
    written = set(write_partitioned(base, out_prefix, "event_date_dt", dealt=few))
    late, bad = (sorted(map(dt.date.fromisoformat, observed(seen, k))) for k in ("late", "bad"))
    if late:
        rows = raw.where(day.isin(late)).drop(EXPORT_DAY)
        written |= set(_merge_late(spark, base_model(rows, raw_name_flags=raw_name_flags), out_prefix, late))
    quarantined = {}
    if bad:
        aside = read_days(spark, raw_prefix, bad, export_day=True).where(day.isNull())
        folder = f"{out_prefix}/{QUARANTINE}"
        write_partitioned(aside.withColumnRenamed(EXPORT_DAY, "export_date"), folder, "export_date")
        quarantined = {r["date"]: r["n_rows"] for r in partition_rows(spark, folder, "export_date", bad).collect()}
    return written, quarantined


def run_base(spark: SparkSession, raw_prefix: str, out_prefix: str, start=None, days: int | None = None,
             as_of=None, raw_name_flags: bool = False, batch_days: int | None = None) -> DataFrame:
    """Process the raw exports not yet in ``out_prefix``.

    Returns (date, status, written, n_rows, n_quarantined): the planned days and any other day
    that their exports held rows of (status ``other``); n_rows counts the day's rows now stored.
    ``batch_days`` runs the planned days in batches, each recorded when it is done, so an
    interrupted backfill goes on where it stopped.
    """
    out_prefix = out_prefix.rstrip("/")
    plan = plan_dates(list_raw_dates(spark, raw_prefix), days_frame(spark, processed_days(spark, out_prefix)),
                      start=start, days=days, as_of=as_of)
    status = {r["date"]: r["status"] for r in plan.collect()}
    todo = sorted(d for d, s in status.items() if s == PROCESS)
    ledger.settle(spark, out_prefix)
    written: set[dt.date] = set()
    quarantined: dict[dt.date, int] = {}
    step = batch_days or max(len(todo), 1)
    for i in range(0, len(todo), step):
        batch = todo[i:i + step]
        days_written, aside = _write_batch(spark, raw_prefix, out_prefix, batch, raw_name_flags)
        written |= days_written
        quarantined |= aside
        done = days_frame(spark, batch).select(F.col("date").alias("export_date"), F.lit(True).alias("done"))
        write_partitioned(done, f"{out_prefix}/{EXPORTS}", "export_date", record=False)
    stored = {r["date"]: r["n_rows"] for r in partition_rows(spark, out_prefix, "event_date_dt", sorted(written)).collect()}
    rows = [(d, status.get(d, "other"), d in written, stored.get(d, 0), quarantined.get(d, 0)) for d in sorted({*status, *written})]
    return spark.createDataFrame(rows, REPORT)


def _replace_days(spark: SparkSession, df: DataFrame, out_prefix: str, column: str, window: list[dt.date],
                  keep_copy: str | None = None) -> DataFrame:
    """Writes ``df`` and deletes the partitions of window days that have no rows any more;
    returns (date, n_rows) of the days written."""
    ledger.settle(spark, out_prefix)
    written = write_partitioned(df, out_prefix, column, keep_copy=keep_copy)
    gone = (set(window) - set(written)) & set(partition_days(spark, out_prefix, column))
    for day in gone:
        delete_folder(spark, f"{out_prefix}/{column}={day}")
    ledger.forget(spark, out_prefix, gone)
    stored = partition_rows(spark, out_prefix, column, written).collect()
    return spark.createDataFrame([tuple(r) for r in stored], "date date, n_rows bigint")


def window_days(spark: SparkSession, prefix: str, start=None, days: int | None = None, **how) -> list[dt.date]:
    """The days of a dataset's partitions in a window (see ``operators.sessions.date_window``)."""
    lo, hi = window_bounds(start, days, **how)
    return [d for d in partition_days(spark, prefix) if (lo is None or d >= lo) and (hi is None or d <= hi)]


def run_staging(spark: SparkSession, base_prefix: str, out_prefix: str, start=None, days: int | None = None,
                exclusions: Sequence[str] = (ALL_PARAMS,), url_mode: str = "raw") -> DataFrame:
    """Stage the base partitions in the window (``days`` forward from ``start``; start only:
    that day and later). Returns (date, n_rows) of the partitions written."""
    window = window_days(spark, base_prefix, start, days)
    staged = stage_events(read_partitioned(spark, base_prefix, window), exclusions=exclusions, url_mode=url_mode)
    return _replace_days(spark, staged, out_prefix.rstrip("/"), "event_date_dt", window, "_event_date_dt")


def run_sessions(spark: SparkSession, staged_prefix: str, traffic_prefix: str | None, out_prefix: str,
                 start=None, days: int | None = None, derived_prefix: str | None = None,
                 join_derived: bool = False, look_back: int = 0) -> DataFrame:
    """Build the session dimension for the window (start only: that single day). Returns
    (date, n_rows) of the partitions written.

    A session that lasts over midnight has a row in each window that holds events of it. With
    ``look_back`` it has one: sessions that the output holds in the ``look_back`` days before the
    window are not started again, and rows of the ``look_back`` days after the window whose
    sessions begin in it are taken out, whatever the order in which windows are processed.
    """
    out_prefix = out_prefix.rstrip("/")
    window = window_days(spark, staged_prefix, start, days, start_only="exact")
    staged = read_partitioned(spark, staged_prefix, window)
    traffic = read_partitioned(spark, traffic_prefix) if traffic_prefix else None
    derived = read_partitioned(spark, derived_prefix) if (join_derived and derived_prefix) else None
    near = dt.timedelta(days=look_back)
    stored = partition_days(spark, out_prefix, SESSION_DAY) if look_back and window else []
    before = [d for d in stored if min(window) - near <= d < min(window)]
    after = [d for d in stored if max(window) < d <= max(window) + near]
    earlier = read_partitioned(spark, out_prefix, before, SESSION_DAY) if before else None
    sessions = build_sessions(staged, traffic=traffic, derived=derived, join_derived=join_derived, earlier=earlier)
    report = _replace_days(spark, sessions, out_prefix, SESSION_DAY, window)
    if after:
        begun = read_partitioned(spark, out_prefix, window, SESSION_DAY)
        later = read_partitioned(spark, out_prefix, after, SESSION_DAY)
        changed = [r[0] for r in later.join(begun.select("session_key"), "session_key", "left_semi").select(SESSION_DAY).distinct().collect()]
        if changed:
            kept = drop_continued(read_partitioned(spark, out_prefix, changed, SESSION_DAY), begun)
            _replace_days(spark, kept, out_prefix, SESSION_DAY, changed)
    return report
