"""Runs planned hops as Spark jobs, one table after the other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators import gold
from ..operators.expectations import enforce, expectations_of, observe, watch
from ..operators.processed import ColumnRule, processed, read_rules
from ..operators.raw import raw
from ..operators.skew import SkewPolicy
from ..operators.tables import WRITE_MODES, append_table, create_current_view, load_once, replace_table
from ..sources import read_source
from ..streaming.facts import land_facts, resolve_late
from ..streaming.files import land_files, lands_by_batch
from ..streaming.history import AT, HistoryStore
from ..streaming.ingest import land_stream, read_hop
from ..streaming.views import RowView
from .specs import LAYERS, HopSpec, plan_objects


UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00")


@dataclass
class Medallion:
    """A registry bound to a session and a folder that all executors share.

    `violations` holds, per table, the constraint counts of the last run, `refused` how many
    changes of the last run had no key or no sequence that could be read. keep_versions: how many
    copies of a table that is written anew, and states of a history, stay for readers still
    running; all of them if not given. load_id: names the snapshot loads that runs append to raw tables; a run
    again under the same id, after a failure or not, adds no row twice. Without it each run is a load of its own.
    """

    spark: SparkSession
    registry: Mapping[str, Any]
    root: str
    buckets: int = 256
    keep_versions: int | None = None
    load_id: str | None = None
    skew: SkewPolicy = SkewPolicy()
    violations: dict[str, dict[str, int]] = field(default_factory=dict)
    refused: dict[str, int] = field(default_factory=dict)

    def run(self, layers: Sequence[str] = LAYERS) -> list[HopSpec]:
        """One refresh. Running it again takes in what is new."""
        zone = self.spark.conf.get("spark.sql.session.timeZone")
        if zone not in UTC_NAMES:
            raise ValueError(f"surrogate keys of versions follow the session time zone, which is {zone}: set spark.sql.session.timeZone to UTC")
        specs = plan_objects(self.registry, layers)
        steps = {"l01": self._raw, "l02": self._cdc, "l03": self._processed, "gold": self._gold}
        for spec in specs:
            steps[spec.layer](spec)
        return specs

    def _location(self, spec: HopSpec) -> str:
        return f"{self.root}/{spec.location}"

    def _checkpoint(self, spec: HopSpec) -> str:
        return f"{self.root}/checkpoints/{spec.layer}/{spec.object_key}"

    def _raw(self, spec: HopSpec) -> None:
        streaming = spec.option("ingestion_mode") == "streaming"
        connection = spec.option("connection")
        if streaming and spec.option("source_type") == "cloud_storage" and lands_by_batch(self.spark, connection, self._location(spec)):
            land_files(self.spark, connection, lambda df: raw(df, spec.raw()), self._checkpoint(spec), self._location(spec), spec.table, spec.comment)
            return
        source = read_source(self.spark, spec.option("source_type"), connection, streaming)
        df = raw(source, spec.raw())
        if streaming:
            land_stream(df, self._checkpoint(spec), self._location(spec), spec.table, spec.comment)
        elif spec.option("merge_strategy") == "overwrite":
            replace_table(df, spec.table, self._location(spec), spec.comment, self.keep_versions)
        elif self.load_id is not None:
            load_once(df, spec.table, self._location(spec), self.load_id, spec.comment)
        else:
            append_table(df, spec.table, self._location(spec), spec.comment)

    def _raw_only_grows(self, spec: HopSpec) -> bool:
        above = [s for s in plan_objects(self.registry, ("l01",)) if s.table == spec.source_table]
        return bool(above) and above[0].option("merge_strategy") == "append"

    def _cdc(self, spec: HopSpec) -> None:
        """Only new raw rows are read where raw only grows. An overwritten raw table is taken as
        one more load of changes: versions known from earlier loads stay."""
        if not self._raw_only_grows(spec):
            feed = read_hop(self.spark, spec.source_table)
            store = self._store(spec, feed)
            store.apply_snapshot(feed)
            self.refused[spec.table] = sum(store.refused.values())
            self._publish(store, spec)
            return
        feed = read_hop(self.spark, spec.source_table, "stream", append_only=True)
        store = self._store(spec, feed)
        query = (
            feed.writeStream.foreachBatch(store.apply)
            .option("checkpointLocation", self._checkpoint(spec))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        self.refused[spec.table] = sum(store.refused.values())
        self._publish(store, spec)

    def _store(self, spec: HopSpec, feed: DataFrame) -> HistoryStore:
        buckets = int(spec.option("buckets", self.buckets))
        return HistoryStore(self.spark, self._location(spec), spec.changes(), feed.schema, buckets, skew=self.skew)

    def _publish(self, store: HistoryStore | RowView, spec: HopSpec) -> None:
        store.publish(spec.table, spec.comment)
        if self.keep_versions is not None:
            store.clean(max(1, self.keep_versions))

    def _row_view(self, spec: HopSpec) -> RowView:
        """The table of a hop that is refreshed by what changed."""
        above = next(s for s in plan_objects(self.registry) if s.table == spec.source_table)
        source = self._store(above, read_hop(self.spark, above.source_table)) if above.layer == "l02" else self._row_view(above)
        rules = read_rules(spec.option("columns"))
        if spec.layer == "l03":
            made_by, build = repr(spec.processed()), lambda df: processed(df, spec.processed())
        else:
            made_by = repr((spec.object_key, rules, spec.option("filter")))
            with_place = [*rules, ColumnRule(AT, AT)] if rules else ()
            build = lambda df: self._mapped(spec, df, with_place)
        return RowView(self.spark, f"{self._location(spec)}/incremental", source, build, made_by, expectations_of(rules))

    def _refresh(self, spec: HopSpec) -> None:
        view = self._row_view(spec)
        counts = view.refresh()
        if counts:
            self.violations[spec.table] = counts
        self._publish(view, spec)

    def _processed(self, spec: HopSpec) -> None:
        if spec.incremental:
            self._refresh(spec)
            return
        built = processed(read_hop(self.spark, spec.source_table), spec.processed())
        self._write(spec, built, spec.processed().columns)

    def _gold(self, spec: HopSpec) -> None:
        if spec.incremental:
            self._refresh(spec)
            if spec.option("create_scd2_view"):
                create_current_view(self.spark, spec.table, spec.option("scd2_view_name"))
            return
        rules = read_rules(spec.option("columns"))
        if spec.option("custom_sql"):
            built, rules = gold.custom_sql(self.spark, spec.option("custom_sql")), ()
        else:
            mode = spec.option("read_mode", "snapshot")
            append_only = spec.option("append_only_source", False)
            source = read_hop(self.spark, spec.source_table, mode, append_only)
            if source.isStreaming and spec.option("primary_key_columns"):
                raise ValueError(f"{spec.table}: primary_key_columns need read_mode 'snapshot': which row of a key is the last is never settled on a stream")
            if spec.option("late_dimensions") and not (source.isStreaming and spec.option("lookups")):
                raise ValueError(f"{spec.table}: late_dimensions is for a streaming read with lookups; other tables are computed anew")
            if source.isStreaming and spec.option("lookups"):
                self._stream_facts(spec, source, rules)
                return
            lookups = [self._lookup(self.spark, item) for item in spec.option("lookups", ())]
            if lookups:
                source = gold.fact(source, lookups, self.skew)
            if spec.option("primary_key_columns"):
                source = gold.one_per_key(source, spec.option("primary_key_columns"))
            built = self._mapped(spec, source, rules)
        self._write(spec, built, rules)
        if spec.option("create_scd2_view"):
            create_current_view(self.spark, spec.table, spec.option("scd2_view_name"))

    def _mapped(self, spec: HopSpec, source: DataFrame, rules: Sequence[Any]) -> DataFrame:
        shed = gold.cons if spec.object_key.startswith("cons_") else gold.dimension
        return gold.mapped(shed(source) if not rules else source, rules, spec.option("filter"))

    def _stream_facts(self, spec: HopSpec, source: DataFrame, rules: Sequence[Any]) -> None:
        """New facts only, each micro-batch with the dimensions as they stand when it runs."""
        if spec.option("write_mode", "materialized_view") != "streaming_table":
            raise ValueError(f"{spec.table}: a streaming read needs write_mode 'streaming_table', not {spec.option('write_mode', 'materialized_view')!r}")
        if spec.option("create_scd2_view"):
            raise ValueError(f"{spec.table}: create_scd2_view is for dimensions, not for streamed facts")
        lookups = lambda spark: [self._lookup(spark, item) for item in spec.option("lookups")]
        late = bool(spec.option("late_dimensions", False))
        counts = land_facts(
            source,
            lookups,
            self._checkpoint(spec),
            self._location(spec),
            spec.table,
            spec.comment,
            lambda df: self._mapped(spec, df, rules),
            expectations_of(rules),
            self.skew,
            late=late,
        )
        if late:
            resolve_late(
                self.spark, lookups, self._location(spec), spec.table, lambda df: self._mapped(spec, df, rules), expectations_of(rules), self.skew
            )
        if counts:
            self.violations[spec.table] = counts

    def _lookup(self, spark: SparkSession, item: Mapping[str, Any]) -> gold.Lookup:
        dimension = read_hop(spark, item["dimension"])
        more = {field: item[field] for field in ("into", "event_time", "unknown", "repeated") if field in item}
        return gold.Lookup(dimension, item["on"], item["skey"], **more)

    def _write(self, spec: HopSpec, df: DataFrame, rules: Sequence[Any]) -> None:
        mode = spec.option("write_mode", "materialized_view")
        if mode not in WRITE_MODES:
            raise ValueError(f"{spec.table}: write_mode must be one of {WRITE_MODES}, not {mode!r}")
        if df.isStreaming:
            if mode != "streaming_table":
                raise ValueError(f"{spec.table}: a streaming read needs write_mode 'streaming_table', not {mode!r}")
            rules = expectations_of(rules)
            name = f"expectations of {spec.table}"
            watched = enforce(watch(df, rules, name), rules)
            seen = land_stream(watched, self._checkpoint(spec), self._location(spec), spec.table, spec.comment, name)
            if seen:
                self.violations[spec.table] = seen
            return
        checked, counts = observe(df, expectations_of(rules))
        replace_table(checked, spec.table, self._location(spec), spec.comment, self.keep_versions)
        if isinstance(counts, Observation):
            self.violations[spec.table] = counts.get
