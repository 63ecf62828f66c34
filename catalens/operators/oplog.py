"""Counters, durations and diagnosis of an operation log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.operators.sequence import running_count

SESSION_START = "app_started"
# Reported counters and the event names each adds up.
COUNTERS = {
    "analysis_requested": ("analysis_requested",),
    "debounced": ("analysis_request_debounced",),
    "same_filters": ("analysis_request_same_filters",),
    "ignored_busy": ("analysis_request_ignored_busy",),
    "ignored_unchanged": ("analysis_request_ignored_unchanged",),
    "parse_errors": ("analysis_request_parse_error",),
    "discarded_results": ("analysis_result_discarded",),
    "reset_noop": ("reset_filters_noop",),
    "reset_cleared_pending": ("reset_filters_cleared_pending",),
    "chart_busy": ("chart_refresh_ignored_busy", "chart_refresh_ignored_analysis_busy"),
    "chart_empty": ("chart_refresh_empty_selection",),
    "page_boundary": ("page_change_boundary",),
}
# Reported mean durations and the event each is taken from.
DURATIONS = {
    "analyze worker": "analysis_worker_completed",
    "apply result": "analysis_applied",
    "refresh view": "view_refreshed",
    "table populate": "results_table_populated",
}
# Fixed values: (counters, cause) rules, in report order, and the line when none applies.
CAUSES = (
    (("debounced",), "Some duplicate trigger paths were collapsed into a single analysis request."),
    (("same_filters",), "Some apply actions reused the same filters, so the app correctly skipped a redundant refresh."),
    (("ignored_busy",), "Some clicks happened while a previous analysis was still running."),
    (("ignored_unchanged",), "Some clicks reused the exact same filters, so there was no data change to apply."),
    (("parse_errors",), "Some requests failed input parsing before analysis started."),
    (("discarded_results",), "Some older results returned after a newer request had already replaced them."),
    (("reset_noop", "reset_cleared_pending"), "Some Reset clicks were valid acknowledgements but did not require a new analysis run."),
    (("chart_busy",), "Some chart refresh clicks happened while another update was already running."),
    (("chart_empty",), "Some chart refresh clicks were blocked because the current selection had no rows."),
    (("page_boundary",), "Some page navigation clicks hit the first/last page boundary and were acknowledged without moving."),
)
NO_CAUSE = "No obvious rejection pattern found. Check recent timings below."


def latest_session(events: DataFrame, start: str = SESSION_START, time: str = "timestamp") -> DataFrame:
    """Events from the last session start on; all of them when there is none. The start is a scalar
    subquery, so the log is only filtered."""
    begun = events.agg(F.max(F.when(F.col("event") == start, F.col(time)))).scalar()
    return events.filter(begun.isNull() | (F.col(time) >= begun))


def session_numbers(events: DataFrame, start: str = SESSION_START, time: str = "timestamp", tie: str | None = None, by: Sequence[str] = (), name: str = "session") -> DataFrame:
    """``events`` with the number of the session each belongs to, in order of ``time`` (nulls first), then ``tie``: how
    many starts there were up to it, 0 before the first. ``by``: columns, such as a user, that count on their own."""
    order = [F.col(time), *([F.col(tie)] if tie else [])]
    return running_count(events, F.col("event") == start, order, name, by)


def session_summary(sessions: DataFrame, time: str = "timestamp", by: Sequence[str] = (), name: str = "session") -> DataFrame:
    """(by, session, events, first, last) of numbered events."""
    return sessions.groupBy(*by, name).agg(F.count("*").alias("events"), F.min(time).alias("first"), F.max(time).alias("last"))


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event").agg(F.count("*").alias("occurrences"))


def counters(events: DataFrame, names: dict[str, tuple[str, ...]] = COUNTERS) -> DataFrame:
    """(counter, occurrences) of every reported counter, zero included: one conditional aggregate."""
    row = events.agg(*[F.count_if(F.col("event").isin(*members)).alias(f"c{i}") for i, members in enumerate(names.values())])
    pairs = [F.struct(F.lit(n).alias("counter"), F.col(f"c{i}").alias("occurrences")) for i, n in enumerate(names)]
    return row.select(F.inline(F.array(*pairs)))


def mean_durations(events: DataFrame, names: dict[str, str] = DURATIONS, digits: int | None = 2) -> DataFrame:
    """(label, event, mean duration in ms), 0 where no numeric duration was logged."""
    means = [
        F.coalesce(F.avg(F.when(F.col("event") == e, F.col("duration"))), F.lit(0.0)).alias(f"m{i}") for i, e in enumerate(names.values())
    ]
    value = (lambda c: c) if digits is None else (lambda c: F.bround(c, digits))
    pairs = [
        F.struct(F.lit(label).alias("label"), F.lit(e).alias("event"), value(F.col(f"m{i}")).alias("mean_ms"))
        for i, (label, e) in enumerate(names.items())
    ]
    return events.agg(*means).select(F.inline(F.array(*pairs)))


def diagnosis(counted: DataFrame, rules=CAUSES, fallback: str = NO_CAUSE) -> DataFrame:
    """(position, cause) of the rules with a non-zero counter, or the fallback line."""
    wide = counted.agg(F.map_from_entries(F.collect_list(F.struct("counter", "occurrences"))).alias("m"))  # one entry per counter
    seen = [
        F.when(
            sum((F.coalesce(F.col("m")[c], F.lit(0)) for c in members), F.lit(0)) > 0,
            F.struct(F.lit(i + 1).alias("position"), F.lit(cause).alias("cause")),
        )
        for i, (members, cause) in enumerate(rules)
    ]
    found = F.filter(F.array(*seen), lambda x: x.isNotNull())
    none = F.array(F.struct(F.lit(0).alias("position"), F.lit(fallback).alias("cause")))
    return wide.select(F.inline(F.when(F.size(found) > 0, found).otherwise(none)))


def recent_events(events: DataFrame, limit: int = 15, time: str = "timestamp", tie: str | None = None) -> DataFrame:
    """The latest events with their request and details, as a bounded top-k."""
    order = [F.desc(time)] + ([F.desc(tie)] if tie else [])
    rows = events.orderBy(*order).limit(limit)
    details = [
        F.when(F.col(k).isNotNull(), F.concat(F.lit(f"{k}="), F.col(k).cast("string")))
        for k in ("source", "duration_ms", "rows", "message") if k in events.columns
    ]
    request = F.coalesce(
        *[F.col(k).cast("string") for k in ("request_id", "analysis_request_id") if k in events.columns], F.lit("-")
    )
    return rows.select(
        F.coalesce(F.col(time).cast("string"), F.lit("-")).alias("timestamp"), F.coalesce("event", F.lit("-")).alias("event"),
        request.alias("request"), (F.concat_ws("; ", *details) if details else F.lit("")).alias("details"),
    )
