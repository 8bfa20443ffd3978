"""An SCD table kept up to date micro-batch by micro-batch.

The table always equals apply_changes() over all changes so far, in any order of arrival.
Nothing is ever too late.

Most changes are newer than all that is known of their key. They need that key's open run
only. A change that is not newer may split or join old runs, so its key is computed again
from its stored changes, back to the run that the late change falls into. Either way a
micro-batch writes the new runs of the keys it touches, and for each of them the start from
which older runs no longer count:

    changes/__batch=<id>/__bucket=<b>              the changes of a micro-batch
    merged/__batch=<id>/__bucket=<b>               changes of earlier micro-batches, put together
    runs/__version=<id>/__open=<0|1>/__bucket=<b>  runs of the keys that the micro-batch touched
    cuts/__version=<id>/__bucket=<b>               their older runs end before this start (NULL: all go)
    manifest/__batch=<id>                          the parts that count, with rows and range of sequences

So what is written follows the micro-batch, not the table. Everything is split into key buckets. Once
a bucket has parts of `merge_after` micro-batches, the newest of them are put together, back to one that
is more than twice as large as all of those: a run is written again about log2 times of the bucket's rows in its
life, and what no merge reaches is never written again. Changes are merged in the same way; a late change opens
only parts whose range of sequences reaches its cut.

A micro-batch takes effect when its manifest is in place. Run again after a failure, it
starts from the manifest before it and gives the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import END_AT, START_AT
from ..operators.cdc import DELETED, LAST_SEQ, SEQ, TIE, ChangeSpec, change_events, history_runs, refused_changes, tie_order
from ..operators.columns import comparable, named_all
from ..operators.skew import SkewPolicy
from ..operators.tables import Folders, ensure_schema, literal, quoted
from ..session import stored_once

BUCKET, OPEN, VERSION, BATCH = "__bucket", "__open", "__version", "__batch"

CUT = "__cut"

FROM = "__from"

#: Where a row of the table stands in the store: struct of the key (k0, k1, ..), start, bucket and version.
AT = "__at"

CLOSED_RUNS, OPEN_RUNS, CUTS, CHANGES, MERGED = 0, 1, 2, 3, 4
#: A late change of up to so many keys has them pushed down into the scan of its stored changes.
PUSHED_KEYS = 200


class Part(NamedTuple):
    """What a micro-batch wrote of one kind in one bucket. low, high: least and greatest sequence of changes, as integers."""

    kind: int
    bucket: int
    version: int
    rows: int = 0
    low: int = 0
    high: int = 0


class Place(NamedTuple):
    """A part for those who read along: the runs, or the cuts, of a micro-batch in one bucket."""

    bucket: int
    version: int
    rows: int


class Snapshot(NamedTuple):
    """What a store holds at one moment, part by part.

    rows(parts): their rows in force, each with AT. cuts(parts): struct AT of a key, and the start from which older
    parts' rows of the key no longer count. signature: text that changes when parts must be read anew.
    """

    signature: str
    row_parts: frozenset[Place]
    cut_parts: frozenset[Place]
    rows: Callable[[Iterable[Place]], DataFrame]
    cuts: Callable[[Iterable[Place]], DataFrame]


def newest_to_merge(sizes: list[int], merge_after: int) -> int:
    """How many of the newest parts, given oldest first by their sizes, are to be put together now.

    Nothing below `merge_after` parts. Then the newest, and on to older ones until one is more than twice as large
    as all those together.
    """
    if len(sizes) < merge_after:
        return 0
    taken, total = 1, sizes[-1]
    while taken < len(sizes) and sizes[-taken - 1] <= 2 * total:
        taken += 1
        total += sizes[-taken]
    return taken


def later_cuts(cuts: Iterable[Part] | Iterable[Place], parts: Iterable[Part] | Iterable[Place]) -> set:
    """Those of `cuts` that can end rows of these parts: cuts of later micro-batches in their buckets."""
    oldest: dict[int, int] = {}
    for p in parts:
        oldest[p.bucket] = min(p.version, oldest.get(p.bucket, p.version))
    return {c for c in cuts if c.bucket in oldest and c.version > oldest[c.bucket]}


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet under the path, or no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _folders(df: DataFrame, *columns: str) -> set[tuple[int, ...]]:
    """Partition values of the files behind a frame, from their paths alone."""
    return {tuple(int(re.search(f"/{c}=([0-9]+)/", file)[1]) for c in columns) for file in df.inputFiles()}


@dataclass(frozen=True)
class HistoryStore:
    """root: a folder all executors share. buckets: fixed for the life of the store; choose
    it so that one bucket of open runs is a few files.

    Newest parts of a bucket are put together once it has parts of `merge_after` micro-batches.
    refused: by micro-batch of this session, how many changes could not be applied.
    """

    spark: SparkSession
    root: str
    spec: ChangeSpec
    schema: T.StructType
    buckets: int = 256
    merge_after: int = 16
    skew: SkewPolicy = field(default=SkewPolicy())
    refused: dict[int, int] = field(default_factory=dict)

    # -- what is stored ------------------------------------------------------------

    def _feed(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _events_like(self) -> DataFrame:
        return change_events(self._feed(), self.spec)

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64(*named_all(self.spec.keys)), F.lit(self.buckets)).cast("int")

    def _runs_schema(self) -> T.StructType:
        events = self._events_like()
        stamp = events.schema[SEQ].dataType
        kept = [f for f in events.schema.fields if f.name != SEQ and not f.name.startswith(TIE)]
        return T.StructType([*kept, *(T.StructField(c, stamp) for c in (LAST_SEQ, START_AT, END_AT))])

    def manifest(self, before: int | None = None) -> set[Part]:
        """Parts in force, of the newest micro-batch (before the given one)."""
        if before is not None:
            # Usually the micro-batch before left one. Only gaps in the ids need a listing.
            parts = self._manifest_of(before - 1)
            if parts:
                return parts
        schema = T.StructType([T.StructField("part", T.StringType()), T.StructField(BATCH, T.LongType())])
        everything = _read(self.spark, f"{self.root}/manifest", schema)
        batches = {batch for (batch,) in _folders(everything, BATCH) if before is None or batch < before}
        return self._manifest_of(max(batches)) if batches else set()

    def _manifest_of(self, batch_id: int) -> set[Part]:
        schema = T.StructType([T.StructField("part", T.StringType())])
        rows = _read(self.spark, f"{self.root}/manifest/{BATCH}={batch_id}", schema).collect()
        parts = {Part(*map(int, row["part"].split("/"))) for row in rows}
        if parts and not any(p.kind in (CHANGES, MERGED) for p in parts):
            raise ValueError(f"{self.root}: its manifest does not list changes; it was written in an older layout and must be loaded anew")
        return parts

    def _write_manifest(self, parts: set[Part], batch_id: int) -> None:
        if not parts:
            return
        text = ",".join("/".join(map(str, part)) for part in sorted(parts))
        rows = self.spark.range(0, 1, 1, 1).select(F.explode(F.split(F.lit(text), ",")).alias("part"))
        rows.write.mode("overwrite").parquet(f"{self.root}/manifest/{BATCH}={batch_id}")

    def _parts(self, parts: Iterable[Part], schema: T.StructType, folder: str, place: str) -> DataFrame:
        """Rows of these parts with their bucket and version."""
        schema = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(VERSION, T.LongType())])
        paths = [f"{self.root}/{folder}/" + place.format(k=p.kind, b=p.bucket, v=p.version) for p in sorted(parts)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{folder}").parquet(*paths).select(*schema.names)

    def _cut_rows(self, parts: Iterable[Part]) -> DataFrame:
        feed = self._feed()
        start = self._runs_schema()[START_AT].dataType
        schema = T.StructType([*(feed.schema[k] for k in self.spec.keys), T.StructField(CUT, start)])
        return self._parts((p for p in parts if p.kind == CUTS), schema, "cuts", f"{VERSION}={{v}}/{BUCKET}={{b}}")

    def _runs(self, parts: Iterable[Part], of: DataFrame | None = None) -> DataFrame:
        """Runs in force in these parts, of all keys or of the keys in `of`."""
        return self._versioned_runs(parts, of).drop(VERSION)

    def _versioned_runs(self, parts: Iterable[Part], of: DataFrame | None = None) -> DataFrame:
        parts, keys = {p for p in parts if p.kind in (CLOSED_RUNS, OPEN_RUNS, CUTS)}, list(self.spec.keys)
        found = self._parts((p for p in parts if p.kind != CUTS), self._runs_schema(), "runs", f"{VERSION}={{v}}/{OPEN}={{k}}/{BUCKET}={{b}}")
        if of is not None:
            found = found.join(of.select(*named_all(keys)).distinct(), keys, "left_semi")
        ending = later_cuts((p for p in parts if p.kind == CUTS), (p for p in parts if p.kind != CUTS))
        if ending:
            cuts = self._cut_rows(ending).drop(BUCKET)
            gone = cuts.select(*(F.col(f"`{k}`").alias(f"__c{i}") for i, k in enumerate(keys)), F.col(VERSION).alias("__since"), CUT)
            dead = [F.col(f"`{k}`") == F.col(f"__c{i}") for i, k in enumerate(keys)]
            dead += [F.col(VERSION) < F.col("__since"), F.col(CUT).isNull() | (F.col(START_AT) >= F.col(CUT))]
            found = found.join(gone, dead, "left_anti")
        return found

    # -- reading -------------------------------------------------------------------

    def read(self) -> DataFrame:
        """The SCD table."""
        return self._visible(self._runs(self.manifest()))

    def _columns(self) -> list[str]:
        return self.spec.stored(self._feed()) + ([START_AT, END_AT] if self.spec.scd_type == 2 else [])

    def _visible(self, runs: DataFrame) -> DataFrame:
        return runs.where(~F.col(DELETED)).select(*named_all(self._columns()))

    def snapshot(self) -> Snapshot:
        """The parts in force, for tables that are kept up to date part by part (see views)."""
        parts = self.manifest()
        sizes: dict[bool, dict[tuple[int, int], int]] = {False: {}, True: {}}
        for p in parts:
            if p.kind in (CLOSED_RUNS, OPEN_RUNS, CUTS):
                held = sizes[p.kind == CUTS]
                held[p.bucket, p.version] = held.get((p.bucket, p.version), 0) + p.rows
        row_parts, cut_parts = (frozenset(Place(*at, n) for at, n in sizes[cuts].items()) for cuts in (False, True))
        key = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(self.spec.keys)]

        def of(places: Iterable[Place], cuts: bool) -> set[Part]:
            wanted = {(p.bucket, p.version) for p in places}
            buckets = {bucket for bucket, _ in wanted}
            return {p for p in parts if (p.bucket, p.version) in wanted or not cuts and p.kind == CUTS and p.bucket in buckets}

        def rows(places: Iterable[Place]) -> DataFrame:
            at = F.struct(*key, F.col(START_AT).alias("start"), F.col(BUCKET).alias("bucket"), F.col(VERSION).alias("version"))
            live = self._versioned_runs(of(places, False)).where(~F.col(DELETED))
            return live.select(*named_all(self._columns()), at.alias(AT))

        def cuts(places: Iterable[Place]) -> DataFrame:
            at = F.struct(*key, F.col(BUCKET).alias("bucket"), F.col(VERSION).alias("version"))
            return self._cut_rows(of(places, True)).select(at.alias(AT), CUT)

        return Snapshot(repr((self.root, self.spec, self.buckets, self.schema.json())), row_parts, cut_parts, rows, cuts)

    def publish(self, view: str, comment: str | None = None) -> None:
        """Points a catalog view at the parts in force now. Before the first run it has no rows."""
        ensure_schema(self.spark, view)
        parts = {p for p in self.manifest() if p.kind in (CLOSED_RUNS, OPEN_RUNS, CUTS)}
        columns = ", ".join(f"r.`{c}`" for c in self._columns())
        if any(p.kind != CUTS for p in parts):
            live = ", ".join(f"'{p.kind}/{p.bucket}/{p.version}'" for p in sorted(parts) if p.kind != CUTS)
            text = (
                f"SELECT {columns} FROM parquet.`{self.root}/runs` r "
                f"WHERE NOT r.{DELETED} AND concat_ws('/', r.{OPEN}, r.{BUCKET}, r.{VERSION}) IN ({live})"
            )
            cuts = ", ".join(f"'{p.bucket}/{p.version}'" for p in sorted(parts) if p.kind == CUTS)
            if cuts:
                same = " AND ".join(f"c.`{k}` = r.`{k}`" for k in self.spec.keys)
                text += (
                    f" AND NOT EXISTS (SELECT 1 FROM parquet.`{self.root}/cuts` c WHERE concat_ws('/', c.{BUCKET}, c.{VERSION}) IN ({cuts})"
                    f" AND {same} AND r.{VERSION} < c.{VERSION} AND (c.{CUT} IS NULL OR r.{START_AT} >= c.{CUT}))"
                )
        else:
            schema = self._visible(self._runs(())).schema
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
            text = f"SELECT {nothing} WHERE false"
        self.spark.sql(f"CREATE OR REPLACE VIEW {quoted(view)} {f'COMMENT {literal(comment)} ' if comment else ''}AS {text}")

    def clean(self, keep: int = 2) -> int:
        """Removes parts and notes that none of the newest `keep` manifests names; how many folders went.

        Readers of a view or frame older than those manifests must be done.
        """
        ids = self._batches()
        if not ids:
            return 0
        kept = ids[-keep:]
        live = set().union(*(self._manifest_of(i) for i in kept))
        places = {CUTS: f"cuts/{VERSION}=", CHANGES: f"changes/{BATCH}=", MERGED: f"merged/{BATCH}="}
        names = {
            f"{places[p.kind]}{p.version}/{BUCKET}={p.bucket}" if p.kind in places else f"runs/{VERSION}={p.version}/{OPEN}={p.kind}/{BUCKET}={p.bucket}"
            for p in live
        }
        files = Folders(self.spark)
        gone = 0
        for pattern in (f"runs/{VERSION}=*/{OPEN}=*/{BUCKET}=*", *(f"{place}*/{BUCKET}=*" for place in places.values())):
            gone += files.remove(f"{self.root}/{pattern}", lambda path: not any(path.endswith("/" + n) for n in names))
        newest = kept[0]
        gone += files.remove(f"{self.root}/manifest/{BATCH}=*", lambda path: int(path.rsplit("=", 1)[1]) < newest)
        gone += files.remove(f"{self.root}/status/batch=*", lambda path: int(path.rsplit("=", 1)[1]) < newest)
        return gone

    def _batches(self) -> list[int]:
        schema = T.StructType([T.StructField("part", T.StringType()), T.StructField(BATCH, T.LongType())])
        return sorted(batch for (batch,) in _folders(_read(self.spark, f"{self.root}/manifest", schema), BATCH))

    # -- one micro-batch -----------------------------------------------------------

    def apply(self, changes: DataFrame, batch_id: int, new_only: bool = False) -> None:
        """Body for foreachBatch. Also fits plain batch loads with rising ids."""
        spark, keys = self.spark, list(self.spec.keys)
        base = self.manifest(before=batch_id)
        events = change_events(changes, self.spec)
        if new_only:
            events = self._unseen(events, base, batch_id)
        path = f"{self.root}/changes/{BATCH}={batch_id}"
        self._write_changes(events.withColumn(BUCKET, self._bucket()), path)
        # Over the key and sequence columns alone.
        self.refused[batch_id] = refused_changes(changes, self.spec).count()
        bucketed = T.StructType([*events.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        arrived = _read(spark, path, bucketed)
        new_parts = self._change_parts(arrived, CHANGES, batch_id)
        touched = {p.bucket for p in new_parts}
        if not touched:
            self._write_manifest(base, batch_id)
            return

        mine = {p for p in base if p.bucket in touched}
        current = self._runs((p for p in mine if p.kind != CLOSED_RUNS), arrived)
        # By the keys alone, as the joins: a key is in one bucket.
        span = arrived.groupBy(*named_all(keys)).agg(F.min(BUCKET).alias(BUCKET), F.min(SEQ).alias("__min"), F.max(SEQ).alias("__max"))
        run = F.struct(*named_all(current.columns)).alias("__run")
        known = current.select(*named_all(keys), LAST_SEQ, F.col(START_AT).alias("__open_start"), run)
        only_latest = self.spec.scd_type == 1 and not self.spec.ignore_null_updates
        late = F.col("__max") == F.col(LAST_SEQ) if only_latest else F.col("__min") <= F.col(LAST_SEQ)
        status = span.join(known, keys, "left").withColumn("__late", F.coalesce(late, F.lit(False)))
        status = stored_once(status, f"{self.root}/status/batch={batch_id}/keys")
        found = status.groupBy(BUCKET).agg(F.max("__late"), F.count("__open_start")).collect()
        late_buckets = {bucket for bucket, late, _ in found if late}
        # What the new runs are made from, at most: with late changes, their keys' part of the stored ones.
        total = sum(p.rows for p in new_parts) + sum(n for _, _, n in found)
        total += sum(p.rows for p in mine | new_parts if p.kind in (CHANGES, MERGED) and p.bucket in late_buckets)
        cuts = old = None
        if late_buckets:
            late_keys = status.where("__late")
            known_runs = self._runs((p for p in mine if p.bucket in late_buckets), late_keys)
            cuts = stored_once(self._cuts(late_keys, known_runs), f"{self.root}/status/batch={batch_id}/cuts")
            # With carried values, the run before the cut stands for all that came before.
            before = cuts.where(F.col(CUT) < F.col(FROM)).select(*named_all(keys), CUT)
            old = known_runs.join(before, keys).where(F.col(START_AT) == F.col(CUT)).drop(CUT)

        new = self._new_runs(arrived, status, cuts, old, mine | new_parts, bucketed, total)
        if self.spec.scd_type == 1:
            new = new.where(F.col(END_AT).isNull())
        replaced = self._replaced(status, cuts)
        merged, whole = self._merging(mine)
        if merged:
            again = self._runs(merged)
            gone = replaced.select(*(F.col(f"`{k}`").alias(f"__c{i}") for i, k in enumerate(keys)), CUT)
            dead = [F.col(f"`{k}`") == F.col(f"__c{i}") for i, k in enumerate(keys)]
            dead.append(F.col(CUT).isNull() | (F.col(START_AT) >= F.col(CUT)))
            new = new.unionByName(again.join(gone, dead, "left_anti").withColumn(OPEN, F.col(END_AT).isNull().cast("int")))
            # What was cut anywhere in the merged parts is cut in the older ones.
            every = replaced.unionByName(self._cut_rows(merged).select(*replaced.columns))
            least = F.when(F.count_if(F.col(CUT).isNull()) == 0, F.min(CUT)).alias(CUT)
            replaced = every.where(~F.col(BUCKET).isin(sorted(whole))).groupBy(*named_all(keys), BUCKET).agg(least).select(*replaced.columns)

        live = (base - merged) | new_parts
        live |= {Part(*place, batch_id, rows) for *place, rows in self._write(new, f"{self.root}/runs/{VERSION}={batch_id}", OPEN, BUCKET)}
        live |= {Part(CUTS, *place, batch_id, rows) for *place, rows in self._write(replaced, f"{self.root}/cuts/{VERSION}={batch_id}", BUCKET)}
        self._write_manifest(self._with_merged_changes(live, touched, bucketed, batch_id), batch_id)

    def _write(self, rows: DataFrame, path: str, *by: str) -> list[tuple[int, ...]]:
        """(partition values, rows) of what was written."""
        rows.hint("rebalance", *(F.col(c) for c in by)).write.mode("overwrite").partitionBy(*by).parquet(path)
        return [tuple(r) for r in _read(self.spark, path, rows.schema).groupBy(*by).count().collect()]

    def _write_changes(self, rows: DataFrame, path: str) -> None:
        """In order of the keys, so that a scan for few keys skips most of a large part."""
        spread = rows.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, *named_all(self.spec.keys))
        spread.write.mode("overwrite").partitionBy(BUCKET).parquet(path)

    def _ordinal(self, seq: F.Column, kind: T.DataType, up: bool) -> F.Column:
        """The sequence as an integer, rounded down or up."""
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.unix_micros(seq.cast("timestamp"))
        return (F.ceil(seq) if up else F.floor(seq)).cast("decimal(38,0)")

    def _change_parts(self, rows: DataFrame, kind: int, version: int) -> set[Part]:
        seq = rows.schema[SEQ].dataType
        found = rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.min(SEQ).alias("low"), F.max(SEQ).alias("high"))
        found = found.select(BUCKET, "n", self._ordinal(F.col("low"), seq, False).alias("low"), self._ordinal(F.col("high"), seq, True).alias("high"))
        return {Part(kind, r[BUCKET], version, r["n"], int(r["low"]), int(r["high"])) for r in found.collect()}

    def _merging(self, mine: set[Part]) -> tuple[set[Part], set[int]]:
        """The parts of runs and cuts that are put together now, and the buckets where those are all there are."""
        sizes: dict[int, dict[int, int]] = {}
        held = [p for p in mine if p.kind in (CLOSED_RUNS, OPEN_RUNS, CUTS)]
        for p in held:
            versions = sizes.setdefault(p.bucket, {})
            versions[p.version] = versions.get(p.version, 0) + p.rows
        since, whole = {}, set()
        for bucket, versions in sizes.items():
            order = sorted(versions)
            n = newest_to_merge([versions[v] for v in order], self.merge_after)
            if n:
                since[bucket] = order[-n]
                if n == len(order):
                    whole.add(bucket)
        return {p for p in held if p.bucket in since and p.version >= since[p.bucket]}, whole

    def _with_merged_changes(self, live: set[Part], touched: set[int], schema: T.StructType, batch_id: int) -> set[Part]:
        """The parts after the newest changes of buckets with many parts were put together, those of this micro-batch aside."""
        merged: set[Part] = set()
        for bucket in touched:
            held = sorted((p for p in live if p.kind in (CHANGES, MERGED) and p.bucket == bucket and p.version < batch_id), key=lambda p: (p.version, p.kind))
            n = newest_to_merge([p.rows for p in held], self.merge_after)
            if n > 1:
                merged |= set(held[-n:])
        if not merged:
            return live
        path = f"{self.root}/merged/{BATCH}={batch_id}"
        self._write_changes(self._change_rows(merged, schema), path)
        return (live - merged) | self._change_parts(_read(self.spark, path, schema), MERGED, batch_id)

    def _change_rows(self, parts: Iterable[Part], schema: T.StructType) -> DataFrame:
        """The changes of these parts, with their bucket."""
        parts = set(parts)
        plain = T.StructType([f for f in schema.fields if f.name != BUCKET])
        kinds = ((CHANGES, "changes"), (MERGED, "merged"))
        one, two = (self._parts((p for p in parts if p.kind == kind), plain, folder, f"{BATCH}={{v}}/{BUCKET}={{b}}") for kind, folder in kinds)
        return one.unionByName(two).drop(VERSION).select(*schema.names)

    def _replaced(self, status: DataFrame, cuts: DataFrame | None) -> DataFrame:
        """(keys, cut, bucket): from where on this micro-batch replaces what was known of a key.

        In order, that is the open run; late, the run that the earliest late change falls into.
        """
        keys = list(self.spec.keys)
        known = status.where(F.col("__open_start").isNotNull())
        if self.spec.scd_type == 1:
            nothing = F.lit(None).cast(status.schema["__open_start"].dataType)
            return known.select(*named_all(keys), nothing.alias(CUT), BUCKET)
        in_order = known.where(~F.col("__late")).select(*named_all(keys), F.col("__open_start").alias(CUT), BUCKET)
        if cuts is None:
            return in_order
        return in_order.unionByName(known.where("__late").select(*named_all(keys)).join(cuts, keys).select(*named_all(keys), CUT, BUCKET))

    def apply_snapshot(self, rows: DataFrame) -> None:
        """A whole feed as it stands now, as the next micro-batch: changes that are stored already are left out."""
        self.apply(rows, max(self._batches(), default=0) + 1, new_only=True)

    def _unseen(self, events: DataFrame, base: set[Part], batch_id: int) -> DataFrame:
        """Events that no earlier micro-batch stored.

        An event newer than its key's open run is new, one equal to the change that run ends with is not. Only the
        others are compared with stored changes, by key, sequence and a hash of all columns.
        """
        if not base:
            return events
        keys = list(self.spec.keys)
        current = self._runs(p for p in base if p.kind != CLOSED_RUNS)
        values = [c for c in events.columns if c not in (*keys, SEQ) and not c.startswith(TIE)]
        known = current.select(*named_all(keys), F.col(LAST_SEQ).alias("__known"), *(F.col(f"`{c}`").alias(f"__v{i}") for i, c in enumerate(values)))
        joined = events.join(known, keys, "left")
        newer = F.col("__known").isNull() | (F.col(SEQ) > F.col("__known"))
        same = F.lit(not self.spec.ignore_null_updates and not any(c.startswith(TIE) for c in events.columns)) & (F.col(SEQ) == F.col("__known"))
        for i, c in enumerate(values):
            same = same & comparable(events, c).eqNullSafe(comparable(joined.select(F.col(f"__v{i}")), f"__v{i}"))
        asked = joined.withColumn("__ask", F.when(newer, 0).when(same, 1).otherwise(2)).where("__ask <> 1")
        asked = stored_once(asked.select(*named_all(events.columns), "__ask"), f"{self.root}/status/batch={batch_id}/asked")
        doubtful = asked.where("__ask = 2").drop("__ask")
        fresh = asked.where("__ask = 0").drop("__ask")
        low = doubtful.agg(self._ordinal(F.min(SEQ), events.schema[SEQ].dataType, False)).first()[0]
        if low is None:
            return fresh
        schema = T.StructType([*events.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        stored = self._change_rows((p for p in base if p.kind in (CHANGES, MERGED) and p.high >= int(low)), schema)

        def marked(df: DataFrame) -> DataFrame:
            return df.withColumn("__mark", F.xxhash64(*[comparable(df, c) for c in events.columns]))

        at = [*keys, SEQ, "__mark"]
        seen = marked(stored).select(*named_all(at)).distinct()
        return fresh.unionByName(marked(doubtful).join(seen, at, "left_anti").select(*named_all(events.columns)))

    def _cuts(self, late: DataFrame, runs: DataFrame) -> DataFrame:
        """Per late key and bucket, the start from which its runs are replaced, and the moment from which its changes
        must be read again.

        Both are the start of the run that the earliest late change falls into: the change
        that opened it stays, so all earlier runs stay too. With carried values, the run before that one has
        what is carried into it, or that it was deleted: it is replaced by itself. NULL means from the beginning.
        """
        keys = list(self.spec.keys)
        stamp = late.schema["__min"].dataType
        if self.spec.scd_type == 1:
            # Type 1 keeps no runs: carried values must be read from the beginning.
            cut = F.lit(None).cast(stamp) if self.spec.ignore_null_updates else F.col("__max")
            return late.select(*named_all(keys), BUCKET, cut.alias(CUT), cut.alias(FROM))
        starts = runs.select(*named_all(keys), START_AT).join(late.select(*named_all(keys), BUCKET, "__min"), keys)
        into = starts.groupBy(*named_all(keys), BUCKET).agg(F.max(F.when(F.col(START_AT) < F.col("__min"), F.col(START_AT))).alias(FROM))
        if not self.spec.ignore_null_updates:
            return into.withColumn(CUT, F.col(FROM))
        before = runs.select(*named_all(keys), START_AT).join(into.select(*named_all(keys), FROM), keys).where(F.col(START_AT) < F.col(FROM))
        before = before.groupBy(*named_all(keys)).agg(F.max(START_AT).alias(CUT))
        return into.join(before, keys, "left").withColumn(CUT, F.coalesce(CUT, FROM))

    def _history(self, cuts: DataFrame, parts: set[Part], schema: T.StructType) -> DataFrame:
        """All changes of the late keys so far, from their cuts on: only parts that reach the oldest cut of their bucket."""
        keys = list(self.spec.keys)
        seq = schema[SEQ].dataType
        oldest = F.when(F.count_if(F.col(FROM).isNull()) == 0, F.min(FROM))
        found = cuts.groupBy(BUCKET).agg(self._ordinal(oldest, seq, False).alias("at"), oldest.cast("string").alias("text")).collect()
        limits = {r[BUCKET]: r["at"] for r in found}
        needed = {p for p in parts if p.kind in (CHANGES, MERGED) and p.bucket in limits and (limits[p.bucket] is None or p.high >= int(limits[p.bucket]))}
        changes = self._change_rows(needed, schema)
        # The oldest cut, and a few keys, as literals let the scan skip what is not needed within a part.
        if all(r["at"] is not None for r in found):
            least = min(found, key=lambda r: r["at"])["text"]
            changes = changes.where(F.col(SEQ) >= F.lit(least).cast(seq))
        few = [r[0] for r in cuts.select(*named_all(keys[:1])).distinct().limit(PUSHED_KEYS + 1).collect()]
        if len(few) <= PUSHED_KEYS:
            changes = changes.where(F.col(f"`{keys[0]}`").isin(few))
        wanted = F.col(FROM).isNull() | (F.col(SEQ) >= F.col(FROM))
        return changes.join(cuts.select(*named_all(keys), FROM), keys).where(wanted).drop(FROM)

    def _new_runs(
        self,
        arrived: DataFrame,
        status: DataFrame,
        cuts: DataFrame | None,
        old: DataFrame | None,
        parts: set[Part],
        schema: T.StructType,
        total: int,
    ) -> DataFrame:
        """Runs of the touched keys, in place of their open run or of all runs since a cut. total: changes and runs read, at most."""
        keys = list(self.spec.keys)
        in_order = status.where(~F.col("__late"))
        # The open run of a key stands for all that came before. Type 1 has one run per
        # key whose values are those at its end.
        seed_at = LAST_SEQ if self.spec.scd_type == 1 else START_AT
        extra = [f for f in schema.fields if f.name.startswith(TIE)]
        columns = [c for c in schema.names if c != SEQ and not c.startswith(TIE)]

        def seeds_of(runs: DataFrame) -> DataFrame:
            return runs.select(
                *named_all(columns),
                F.col(seed_at).alias(SEQ),
                *(F.lit(None).cast(f.dataType).alias(f.name) for f in extra),
                LAST_SEQ,
            )

        seeds, fresh = seeds_of(in_order.where(F.col("__open_start").isNotNull()).select("__run.*")), arrived
        if cuts is not None:
            fresh = arrived.join(in_order.select(*named_all(keys)), keys, "left_semi").unionByName(self._history(cuts, parts, schema))
            seeds = seeds.unionByName(seeds_of(old))
        events = seeds.unionByName(fresh.withColumn(LAST_SEQ, F.col(SEQ)))
        tracked = [] if self.spec.scd_type == 1 else self.spec.tracked(self._feed())
        ties = tie_order(self._feed(), self.spec)
        runs = history_runs(events, self.spec, tracked, ties, self.skew, passing=[BUCKET], total=total)
        return runs.withColumn(OPEN, F.col(END_AT).isNull().cast("int"))
