"""Change feeds to SCD type 1 and type 2 tables.

The result depends on the set of changes only, never on their arrival order. Changes are
ordered by the parsed sequence (a number stays a number, and so do the bounds of versions); of several changes with the same key and sequence the one
with the largest tie-breaker counts. Validity is half-open, [__START_AT, __END_AT).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import END_AT, LOADED_AT, RESCUED, SOURCE_UPDATED_AT, START_AT
from ..functions.timestamps import column_as_sequence
from ..session import scratch_dir, stored_once
from .columns import comparable, holds_map, named, named_all
from .skew import SLICE, SkewPolicy, fill_forward, find_long_keys, split_long_keys

SEQ = "__seq"
LAST_SEQ = "__last_seq"
DELETED = "__deleted"
TIE = "__tie"


@dataclass(frozen=True)
class ChangeSpec:
    """How to read a feed as changes."""

    keys: Sequence[str]
    sequence_by: str
    scd_type: int = 2
    apply_as_deletes: str | None = None
    ignore_null_updates: bool = False
    track_history_column_list: Sequence[str] | None = None
    except_column_list: Sequence[str] = (RESCUED,)
    tie_breaker: Sequence[str] | None = None
    track_audit: bool = False
    on_refused: str = "drop"

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("a change feed needs at least one key column")
        if not self.sequence_by:
            raise ValueError("a change feed needs a sequence_by column")
        if self.scd_type not in (1, 2):
            raise ValueError(f"scd_type must be 1 or 2, not {self.scd_type!r}")
        if self.on_refused not in ("drop", "fail"):
            raise ValueError(f"on_refused must be 'drop' or 'fail', not {self.on_refused!r}")

    def stored(self, feed: DataFrame) -> list[str]:
        return [c for c in feed.columns if c not in self.except_column_list]

    def values(self, feed: DataFrame) -> list[str]:
        return [c for c in self.stored(feed) if c not in self.keys]

    def tracked(self, feed: DataFrame) -> list[str]:
        if self.track_history_column_list:
            return list(self.track_history_column_list)
        audit = () if self.track_audit else (SOURCE_UPDATED_AT, LOADED_AT)
        return [c for c in self.values(feed) if c not in audit]


def _is_refused(feed: DataFrame, spec: ChangeSpec) -> Column:
    refused = column_as_sequence(feed, spec.sequence_by).isNull()
    for key in spec.keys:
        refused = refused | named(key).isNull()
    return refused


def refused_changes(feed: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Rows that cannot be applied: a key or the sequence is NULL."""
    return feed.where(_is_refused(feed, spec))


def change_events(feed: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Applicable rows: stored columns, parsed sequence, delete flag, and those tie-breakers
    that are not stored or that Spark cannot order as they are."""
    deleted = F.coalesce(F.expr(spec.apply_as_deletes), F.lit(False)) if spec.apply_as_deletes else F.lit(False)
    refused = _is_refused(feed, spec)
    if spec.on_refused == "fail":
        message = F.lit(f"a change has a NULL key ({', '.join(spec.keys)}) or sequence ({spec.sequence_by})")
        feed = feed.where(F.when(refused, F.raise_error(message).cast("boolean")).otherwise(True))
    else:
        feed = feed.where(~refused)
    ties = _tie_columns(feed, spec)
    return feed.select(
        *named_all(spec.stored(feed)),
        column_as_sequence(feed, spec.sequence_by).alias(SEQ),
        deleted.alias(DELETED),
        *(comparable(feed, c).alias(name) for name, c in ties.items() if name != c),
    )


def _tie_columns(feed: DataFrame, spec: ChangeSpec) -> dict[str, str]:
    """Column of the events -> column of the feed, most significant first. Keys and a
    sequence that needs no parsing cannot break a tie."""
    chosen = spec.tie_breaker or [c for c in feed.columns if c not in spec.keys]
    stored = spec.stored(feed)
    ties = {}
    for i, c in enumerate(chosen):
        if c == spec.sequence_by and isinstance(feed.schema[c].dataType, (T.TimestampType, T.TimestampNTZType, T.IntegralType)):
            continue
        ties[c if c in stored and not holds_map(feed.schema[c].dataType) else f"{TIE}{i}"] = c
    return ties


def tie_order(feed: DataFrame, spec: ChangeSpec) -> list[str]:
    """The columns of change_events() that order changes of one key and sequence."""
    return list(_tie_columns(feed, spec))


def _latest(events: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per group, the one with the largest order. Spark keeps one row per group and
    task before it shuffles, so a hot group stays small."""
    newest = Window.partitionBy(*named_all(by)).orderBy(*(named(c).desc() for c in order))
    return events.withColumn("__rank", F.row_number().over(newest)).where("__rank = 1").drop("__rank")


def _scd1(events: DataFrame, spec: ChangeSpec, stored: Sequence[str], ties: Sequence[str]) -> DataFrame:
    if not spec.ignore_null_updates:
        latest = _latest(events, spec.keys, [SEQ, *ties])
        return latest.where(~F.col(DELETED)).select(*named_all(stored))

    # The value of a column is its last non-NULL one after the last delete. All of that
    # is one aggregation per key, so no key needs its history in one place.
    values = [c for c in stored if c not in spec.keys]
    single = _latest(events, [*spec.keys, SEQ], ties or [SEQ])
    present = {c: F.when(named(c).isNotNull() & ~F.col(DELETED), F.col(SEQ)) for c in values}
    state = single.groupBy(*named_all(spec.keys)).agg(
        F.max(SEQ).alias("__last"),
        F.max(F.when(F.col(DELETED), F.col(SEQ))).alias("__gone"),
        *(
            F.max_by(F.struct(F.col(SEQ).alias("at"), named(c).alias("value")), present[c]).alias(f"__v{i}")
            for i, c in enumerate(values)
        ),
    )
    gone = F.col("__gone")
    carried = {
        c: F.when(gone.isNull() | (F.col(f"__v{i}.at") > gone), F.col(f"__v{i}.value"))
        for i, c in enumerate(values)
    }
    alive = state.where(gone.isNull() | (F.col("__last") > gone))
    return alive.select(*(carried[c].alias(c) if c in carried else named(c) for c in stored))


def _one_per_sequence(events: DataFrame, part: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """Drops the losers among changes with equal key and sequence. Sorted like the windows
    that follow, so that all of them share one sort."""
    rows = Window.partitionBy(*named_all(part)).orderBy(SEQ, *named_all(ties))
    following = F.lead(SEQ).over(rows)
    return (
        events.withColumn("__following", following)
        .where(F.col("__following").isNull() | (F.col("__following") != F.col(SEQ)))
        .drop("__following")
    )


def _carry_values(events: DataFrame, spec: ChangeSpec, values: Sequence[str], sliced: bool) -> DataFrame:
    """A NULL takes the previous value of its column; a delete forgets all of them."""
    marks = {}
    for i, name in enumerate(values):
        nothing = F.lit(None).cast(events.schema[name].dataType)
        marks[f"__m{i}"] = F.when(F.col(DELETED), F.struct(nothing.alias("v"))).when(
            named(name).isNotNull(), F.struct(named(name).alias("v"))
        )
    filled = fill_forward(events, spec.keys, [SEQ], marks, sliced)
    return filled.withColumns({name: F.col(f"__m{i}.v") for i, name in enumerate(values)}).drop(*marks)


def _runs_per_lane(events: DataFrame, part: Sequence[str], state: Column) -> DataFrame:
    """One row per run of equal state: its last row, with start, end and last sequence.

    Every window has the same partitioning and order, so there is one shuffle and one sort.
    """
    rows = Window.partitionBy(*named_all(part)).orderBy(SEQ)
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = events.withColumn("__state", state)
    seen = seen.withColumns(
        {
            "__before": F.lag("__state").over(rows),
            "__next": F.lead(SEQ).over(rows),
        }
    ).withColumn("__opens", F.col("__before").isNull() | ~F.col("__before").eqNullSafe(F.col("__state")))
    seen = seen.drop("__before")
    started = seen.withColumns(
        {
            START_AT: F.max(F.when(F.col("__opens"), F.col(SEQ))).over(so_far),
            "__lane_start": F.first(SEQ).over(so_far),
            "__next_opens": F.lead("__opens").over(rows),
        }
    )
    return (
        started.where(F.coalesce("__next_opens", F.lit(True)))
        .withColumns(
            {
                END_AT: F.col("__next"),
                "__edge": (F.col(START_AT) == F.col("__lane_start")) | F.col("__next").isNull(),
            }
        )
        .drop("__next", "__next_opens", "__opens", "__lane_start")
    )


def _join_runs_across_slices(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only the first and the last run of a slice can touch another slice: two rows per
    slice, merged per key. All other runs are final."""
    inner = runs.where(~F.col("__edge"))
    edges = runs.where("__edge")
    rows = Window.partitionBy(*named_all(keys)).orderBy(START_AT)
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before, slice_before = F.lag("__state").over(rows), F.lag(SLICE).over(rows)
    merged = (
        edges.withColumns({"__before": before, "__slice_before": slice_before})
        .withColumn(
            "__opens",
            F.col("__before").isNull()
            | (F.col("__slice_before") == F.col(SLICE))
            | ~F.col("__before").eqNullSafe(F.col("__state")),
        )
        .withColumns(
            {
                "__start": F.max(F.when(F.col("__opens"), F.col(START_AT))).over(so_far),
                "__next_opens": F.lead("__opens").over(rows),
                "__next_start": F.lead(START_AT).over(rows),
            }
        )
        .where(F.col("__next_opens").isNull() | F.col("__next_opens"))
        .withColumns({START_AT: F.col("__start"), END_AT: F.coalesce(F.col(END_AT), F.col("__next_start"))})
    )
    return inner.unionByName(merged.select(*named_all(runs.columns)))


def history_runs(
    events: DataFrame,
    spec: ChangeSpec,
    tracked: Sequence[str],
    ties: Sequence[str],
    skew: SkewPolicy,
    passing: Sequence[str] = (),
    total: int | None = None,
) -> DataFrame:
    """Runs of equal tracked values per key, deletes included.

    Columns: those of `events` without extra tie-breakers and sequence, then LAST_SEQ,
    __START_AT and __END_AT. `events` may bring its own LAST_SEQ for rows that stand for
    several changes. `passing` names columns that are no values of the table. `total`: how many events there are
    at most; without it they are counted.
    """
    if LAST_SEQ not in events.columns:
        events = events.withColumn(LAST_SEQ, F.col(SEQ))
    internal = {SLICE, SEQ, LAST_SEQ, *(c for c in ties if c.startswith(TIE))}
    values = [c for c in events.columns if c not in {*spec.keys, DELETED, *internal, *passing}]

    def runs_of(rows: DataFrame, sliced: bool) -> DataFrame:
        part = [*spec.keys, SLICE] if sliced else list(spec.keys)
        single = _one_per_sequence(rows.repartition(*named_all(part)), part, ties)
        if spec.ignore_null_updates:
            single = _carry_values(single, spec, values, sliced)
        compared = [comparable(single, c).alias(f"c{i}") for i, c in enumerate(tracked)]
        kept = F.when(~F.col(DELETED), F.struct(*compared) if compared else F.lit(0))
        return _runs_per_lane(single, part, F.struct(F.col(DELETED).alias("gone"), kept.alias("kept")))

    out = [*(c for c in events.columns if c not in internal), LAST_SEQ, START_AT, END_AT]
    slicing = find_long_keys(events, spec.keys, SEQ, skew, total)
    if slicing is None:
        return runs_of(events, False).select(*named_all(out))
    short, long = split_long_keys(events, spec.keys, SEQ, slicing)
    if slicing.repeats is not None:
        # Many changes with one key and one sequence cannot be cut apart: settle those first.
        at = [*spec.keys, SEQ]
        repeats = F.broadcast(slicing.repeats)
        settled = _latest(long.join(repeats, at, "left_semi"), at, ties or [SEQ])
        long = long.join(repeats, at, "left_anti").unionByName(settled)
    # Read twice below, and much smaller than the changes it comes from.
    cut = stored_once(runs_of(long, True), scratch_dir(events.sparkSession, "runs"))
    whole = _join_runs_across_slices(cut, spec.keys)
    return runs_of(short, False).select(*named_all(out)).unionByName(whole.select(*named_all(out)))


def apply_changes(feed: DataFrame, spec: ChangeSpec, skew: SkewPolicy = SkewPolicy()) -> DataFrame:
    """The SCD table of a feed. Type 2 adds __START_AT and __END_AT (NULL while current)."""
    stored = spec.stored(feed)
    events = change_events(feed, spec)
    if spec.scd_type == 1:
        return _scd1(events, spec, stored, tie_order(feed, spec))
    runs = history_runs(events, spec, spec.tracked(feed), tie_order(feed, spec), skew)
    return runs.where(~F.col(DELETED)).select(*named_all(stored), START_AT, END_AT)
