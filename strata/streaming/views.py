"""Tables made row by row from a history, kept up to date at the cost of what changed.

A HistoryStore is a set of parts (bucket, micro-batch). A RowView has the rows of each part after a
projection or filter, such as `processed` or a dimension. A refresh compares the two manifests: parts that the view
lacks are built, parts that the store merged away are left out, all others keep their files. Rows of older
parts that a micro-batch replaced end by its cuts, which the view copies, so it stands on its own.

    rows/__refresh=<n>/__bucket=<b>/__version=<id>   rows of the store's part, built by refresh n
    cuts/__refresh=<n>/__bucket=<b>/__version=<id>   what that micro-batch replaced of older parts
    manifest/__batch=<n>                             what counts, after refresh n

What is written follows the micro-batches since the last refresh: a row is built once, and again when the store
merges its part (about log2 times of its bucket's rows). A view may be made from another view. A refresh takes
effect with its manifest; run again after a failure it gives the same.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import named_all
from ..operators.expectations import Expectation, observe
from ..operators.tables import Folders, ensure_schema, literal, quoted, replaces_kind
from .history import AT, BATCH, BUCKET, CUT, VERSION, HistoryStore, Place, Snapshot, _folders, _read, later_cuts

REFRESH = "__refresh"
_ENTRIES = T.StructType([T.StructField("entry", T.StringType())])
#: Nodes of a plan that make each row from one row.
_ROW_WISE = {"Project", "Filter", "SubqueryAlias", "Generate", "LocalRelation", "LogicalRDD", "LogicalRelation"}


class Written(NamedTuple):
    """Where the view has a part of its source, and how many rows."""

    refresh: int
    rows: int


@dataclass(frozen=True)
class State:
    """What a manifest says. Parts without rows have no files."""

    signature: str = ""
    schema: T.StructType | None = None
    cuts_schema: T.StructType | None = None
    rows: dict[Place, Written] | None = None
    cuts: dict[Place, Written] | None = None


def row_wise(df: DataFrame) -> bool:
    """Whether each row is made from one row of the source alone, and the same one every time."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic() or not plan.subqueriesAll().isEmpty():
        return False
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        if node.nodeName() not in _ROW_WISE:
            return False
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return True


@dataclass(frozen=True)
class RowView:
    """build: from the source's rows to those of the view. It gets a column AT, which it must keep, and may not
    join, aggregate, number rows or draw at random. made_by: text that changes when `build` does; the view is then made anew, as
    it is when the source's columns change.

    expectations: checked on rows when they are built, so `violations` of a refresh are those of what it built.

    Remove the folder of the view with that of its source: parts are known by bucket, micro-batch and number of rows.
    """

    spark: SparkSession
    root: str
    source: HistoryStore | RowView
    build: Callable[[DataFrame], DataFrame]
    made_by: str = ""
    expectations: Sequence[Expectation] = ()

    # -- what is stored ------------------------------------------------------------

    def _refreshes(self) -> list[int]:
        schema = T.StructType([*_ENTRIES.fields, T.StructField(BATCH, T.LongType())])
        return sorted(n for (n,) in _folders(_read(self.spark, f"{self.root}/manifest", schema), BATCH))

    def _state(self, refresh: int) -> State:
        found: dict[str, dict[Place, Written]] = {"rows": {}, "cuts": {}}
        facts = {}
        for row in _read(self.spark, f"{self.root}/manifest/{BATCH}={refresh}", _ENTRIES).collect():
            name, _, rest = row["entry"].partition(" ")
            if name in found:
                bucket, version, size, at, rows = map(int, rest.split("/"))
                found[name][Place(bucket, version, size)] = Written(at, rows)
            else:
                facts[name] = rest
        schemas = [T.StructType.fromJson(json.loads(facts[name])) for name in ("schema", "cuts_schema")]
        return State(facts["signature"], *schemas, found["rows"], found["cuts"])

    def _write_state(self, state: State, refresh: int) -> None:
        lines = [f"signature {state.signature}", f"schema {state.schema.json()}", f"cuts_schema {state.cuts_schema.json()}"]
        for name, parts in (("rows", state.rows), ("cuts", state.cuts)):
            lines += [f"{name} " + "/".join(map(str, (*place, *at))) for place, at in sorted(parts.items())]
        rows = self.spark.range(0, 1, 1, 1).select(F.explode(F.split(F.lit("\n".join(lines)), "\n")).alias("entry"))
        rows.write.mode("overwrite").parquet(f"{self.root}/manifest/{BATCH}={refresh}")

    def _newest(self) -> tuple[int, State]:
        """The newest refresh (0: none) and its state."""
        done = self._refreshes()
        return (done[-1], self._state(done[-1])) if done else (0, State(rows={}, cuts={}))

    def _parts(self, folder: str, parts: dict[Place, Written], schema: T.StructType) -> DataFrame:
        paths = [f"{self.root}/{folder}/{_where(place, at)}" for place, at in sorted(parts.items()) if at.rows]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _live(self, state: State, places: Iterable[Place] | None = None) -> DataFrame:
        """Rows in force of these parts, or of all, with AT."""
        wanted = state.rows if places is None else {p: state.rows[p] for p in places}
        found = self._parts("rows", wanted, state.schema)
        cuts = {p: state.cuts[p] for p in later_cuts(state.cuts, wanted) if state.cuts[p].rows}
        return without_cut(found, self._parts("cuts", cuts, state.cuts_schema)) if cuts else found

    def snapshot(self) -> Snapshot:
        """The newest refresh, for a view of this view."""
        _, state = self._newest()
        if state.schema is None:
            raise ValueError(f"{self.root}: a view of it needs its first refresh")
        return Snapshot(
            state.signature,
            frozenset(state.rows),
            frozenset(state.cuts),
            lambda places: self._live(state, places),
            lambda places: self._parts("cuts", {p: state.cuts[p] for p in places}, state.cuts_schema),
        )

    # -- refresh -------------------------------------------------------------------

    def refresh(self) -> dict[str, int]:
        """Takes in what the source has by now. The counts of violations of the rows built, if any were."""
        upstream = self.source.snapshot()
        empty = self.build(upstream.rows(()))
        if AT not in empty.columns:
            raise ValueError(f"{self.root}: the column {AT} must be kept")
        if not row_wise(empty):
            raise ValueError(f"{self.root}: rows that depend on other rows, or on chance, cannot be refreshed by what changed; write the table in full")
        text = "\n".join([upstream.signature, self.made_by, repr(list(self.expectations)), empty.schema.json()])
        signature = hashlib.sha256(text.encode()).hexdigest()
        last, old = self._newest()
        kept = old if old.signature == signature else State(rows={}, cuts={})
        rows = {p: at for p, at in kept.rows.items() if p in upstream.row_parts}
        cuts = {p: at for p, at in kept.cuts.items() if p in upstream.cut_parts}
        fresh, fresh_cuts = upstream.row_parts - set(rows), upstream.cut_parts - set(cuts)
        if old.signature == signature and not fresh and not fresh_cuts and len(rows) == len(old.rows) and len(cuts) == len(old.cuts):
            return {}
        now, counts = last + 1, None
        # Rows built now are without what was cut so far. Cuts are for the parts that stay.
        staying = {p.bucket for p in rows}
        needed = {p for p in fresh_cuts if p.bucket in staying}
        cuts |= {p: Written(now, 0) for p in fresh_cuts - needed}
        cut_rows = upstream.cuts(needed)
        if needed:
            cuts |= self._written(_placed(cut_rows, False), "cuts", now, needed)
        if fresh:
            # Counted behind the shuffle: below it, counts were not reported.
            spread = bool(later_cuts(upstream.cut_parts, fresh))
            built, counts = observe(_placed(self.build(upstream.rows(fresh)), spread), self.expectations)
            rows |= self._written(built, "rows", now, fresh)
        self._write_state(State(signature, empty.schema, cut_rows.schema, rows, cuts), now)
        return counts.get if isinstance(counts, Observation) else {}

    def _written(self, df: DataFrame, folder: str, refresh: int, places: Iterable[Place]) -> dict[Place, Written]:
        path = f"{self.root}/{folder}/{REFRESH}={refresh}"
        df.write.mode("overwrite").partitionBy(BUCKET, VERSION).parquet(path)
        found = {(b, v): n for b, v, n in _read(self.spark, path, df.schema).groupBy(BUCKET, VERSION).count().collect()}
        return {p: Written(refresh, found.get((p.bucket, p.version), 0)) for p in places}

    # -- reading -------------------------------------------------------------------

    def read(self) -> DataFrame:
        _, state = self._newest()
        if state.schema is None:
            return self.build(self.source.snapshot().rows(())).drop(AT)
        return self._live(state).drop(AT)

    def publish(self, view: str, comment: str | None = None) -> None:
        """Points a catalog view at the newest refresh. A table of that name gives way; its files stay."""
        _, state = self._newest()
        ensure_schema(self.spark, view)
        columns = [f for f in state.schema.fields if f.name != AT]
        if any(at.rows for at in state.rows.values()):
            names = ", ".join(f"r.`{f.name}`" for f in columns)
            text = f"SELECT {names} FROM parquet.`{self.root}/rows` r WHERE {_listed('r', state.rows)}"
            if any(at.rows for at in state.cuts.values()):
                keys = [f.name for f in state.schema[AT].dataType.fields if f.name.startswith("k")]
                same = " AND ".join(f"c.{AT}.{k} = r.{AT}.{k}" for k in keys)
                text += (
                    f" AND NOT EXISTS (SELECT 1 FROM parquet.`{self.root}/cuts` c WHERE {_listed('c', state.cuts)} AND {same}"
                    f" AND r.{AT}.version < c.{AT}.version AND (c.{CUT} IS NULL OR r.{AT}.start >= c.{CUT}))"
                )
        else:
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in columns)
            text = f"SELECT {nothing} WHERE false"
        replaces_kind(self.spark, view, "VIEW")
        self.spark.sql(f"CREATE OR REPLACE VIEW {quoted(view)} {f'COMMENT {literal(comment)} ' if comment else ''}AS {text}")

    def clean(self, keep: int = 2) -> int:
        """Removes what none of the newest `keep` refreshes names; how many folders went."""
        done = self._refreshes()
        if not done:
            return 0
        live = set()
        for state in map(self._state, done[-keep:]):
            for folder, parts in (("rows", state.rows), ("cuts", state.cuts)):
                live |= {f"{folder}/{_where(place, at)}" for place, at in parts.items()}
        files, gone = Folders(self.spark), 0
        for folder in ("rows", "cuts"):
            pattern = f"{self.root}/{folder}/{REFRESH}=*/{BUCKET}=*/{VERSION}=*"
            gone += files.remove(pattern, lambda path: "/".join(path.rstrip("/").rsplit("/", 4)[1:]) not in live)
        oldest = done[-keep:][0]
        return gone + files.remove(f"{self.root}/manifest/{BATCH}=*", lambda path: int(path.rsplit("=", 1)[1]) < oldest)


def _placed(df: DataFrame, spread: bool) -> DataFrame:
    """With the parts that the rows belong to. Read from files of single parts, the rows stand together; where a join has
    scattered them, they are to be spread by part, a large one over several tasks."""
    at = F.col(AT)
    placed = df.withColumns({BUCKET: at["bucket"], VERSION: at["version"]})
    return placed.hint("rebalance", F.col(BUCKET), F.col(VERSION)) if spread else placed


def _where(place: Place, at: Written) -> str:
    return f"{REFRESH}={at.refresh}/{BUCKET}={place.bucket}/{VERSION}={place.version}"


def _listed(alias: str, parts: dict[Place, Written]) -> str:
    live = ", ".join(f"'{at.refresh}/{place.bucket}/{place.version}'" for place, at in sorted(parts.items()) if at.rows)
    return f"concat_ws('/', {alias}.{REFRESH}, {alias}.{BUCKET}, {alias}.{VERSION}) IN ({live})"


def without_cut(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """The rows that no cut of a later micro-batch ends."""
    gone = cuts.select(F.col(AT).alias("__gone"), CUT)
    keys = [f.name for f in cuts.schema[AT].dataType.fields if f.name.startswith("k")]
    dead = [F.col(f"{AT}.{k}") == F.col(f"__gone.{k}") for k in keys]
    dead += [F.col(f"{AT}.version") < F.col("__gone.version"), F.col(CUT).isNull() | (F.col(f"{AT}.start") >= F.col(CUT))]
    return rows.join(gone, dead, "left_anti").select(*named_all(rows.columns))
