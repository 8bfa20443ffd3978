"""The gold hops: consolidation, surrogate-key lookup, dimensions and facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    EFFECTIVE_FROM,
    EFFECTIVE_TO,
    IS_CURRENT,
    LOADED_AT,
    PROCESSED_AT,
    SOURCE_UPDATED_AT,
)
from ..session import scratch_dir, stored_once
from .columns import comparable, named, named_all
from .processed import ColumnRule, build_columns
from .skew import SLICE, SkewPolicy, Slicing, fill_forward, find_long_keys, split_long_keys
from .tables import quoted

CONS_SHEDS = (SOURCE_UPDATED_AT, PROCESSED_AT)
DIM_SHEDS = (SOURCE_UPDATED_AT, PROCESSED_AT, LOADED_AT)


def custom_sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The statement as written. `views` name frames the statement may read.

    They are views for the time of analysis only: a view of the caller with that name stays.
    """
    held = {name: spark.table(quoted(name)) for name in views or {} if _is_temp_view(spark, name)}
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(text)
    finally:
        for name in views or {}:
            if name in held:
                held[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def _is_temp_view(spark: SparkSession, name: str) -> bool:
    return any(t.isTemporary and t.name.lower() == name.lower() for t in spark.catalog.listTables(pattern=name))


def mapped(source: DataFrame, rules: Sequence[ColumnRule] = (), filter: str | None = None) -> DataFrame:
    """Filter, then one column per rule; without rules all columns."""
    df = source.where(F.expr(filter)) if filter else source
    if not rules:
        return df
    return df.select(*(column.alias(name) for name, column in build_columns(df, rules).items()))


def current_versions(df: DataFrame) -> DataFrame:
    return df.where(F.col(IS_CURRENT))


def cons(df: DataFrame) -> DataFrame:
    """Sheds the audit columns that end at processed."""
    return df.drop(*CONS_SHEDS)


def dimension(df: DataFrame) -> DataFrame:
    """A dimension keeps its key and validity columns and sheds load audit."""
    return df.drop(*DIM_SHEDS)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of each business key, and of each of its versions in a type 2 table: the one that was
    updated or loaded last, then the largest in all columns. Spark keeps one row per key and task
    before it shuffles."""
    part = [*keys, *(c for c in (EFFECTIVE_FROM,) if c in df.columns and c not in keys)]
    stamps = [c for c in (SOURCE_UPDATED_AT, LOADED_AT) if c in df.columns]
    order = [named(c).desc_nulls_last() for c in stamps]
    order += [comparable(df, c).desc_nulls_last() for c in df.columns if c not in (*part, *stamps, PROCESSED_AT)]
    newest = Window.partitionBy(*named_all(part)).orderBy(*order or [F.lit(0)])
    return df.withColumn("__place", F.row_number().over(newest)).where("__place = 1").drop("__place")


@dataclass(frozen=True)
class Lookup:
    """How a fact finds the surrogate key of one dimension.

    on: fact column -> dimension business key column.
    event_time: fact column for a type 2 dimension; the version valid then is taken.
        Without it, a type 2 dimension gives its current version.
    unknown: key for facts without a match; NULL if not given.
    repeated: what a key gives that several rows of a type 1 dimension, or several current versions, have:
        "fail" is an error once the dimension is read, "largest" takes the largest surrogate key.
    """

    dimension: DataFrame
    on: Mapping[str, str]
    skey: str
    into: str | None = None
    event_time: str | None = None
    unknown: int | None = None
    repeated: str = "fail"

    def __post_init__(self) -> None:
        if self.repeated not in ("fail", "largest"):
            raise ValueError(f"{self.target}: repeated must be 'fail' or 'largest', not {self.repeated!r}")

    @property
    def target(self) -> str:
        return self.into or self.skey

    @property
    def as_of(self) -> bool:
        return bool(self.event_time) and EFFECTIVE_FROM in self.dimension.columns

    @property
    def reads(self) -> list[str]:
        """The fact columns that the lookup needs."""
        return [*self.on, *([self.event_time] if self.as_of else [])]


def _with_unknown(skey: Column, lookup: Lookup) -> Column:
    return skey if lookup.unknown is None else F.coalesce(skey, F.lit(lookup.unknown).cast("bigint"))


def with_skey(facts: DataFrame, lookup: Lookup) -> DataFrame:
    """Adds the key of the only (type 1) or current (type 2) dimension row; every fact stays one row.

    A left equi-join over two or three dimension columns: Spark broadcasts the dimension if its
    measured size allows, and else splits long keys of the fact side in the sort-merge join (adaptive
    skew join). Grouping the dimension by its key shows keys that it has twice; where the join
    shuffles, it is by the same columns and costs no shuffle of its own.
    """
    return _join_row(facts, lookup, small=False)


def _join_row(facts: DataFrame, lookup: Lookup, small: bool) -> DataFrame:
    rows = _rows_of(lookup)
    keys = [c for c in rows.columns if c != "__skey"]
    one = F.max("__skey")
    if lookup.repeated == "fail":
        shown = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
        twice = F.raise_error(F.concat(F.lit(f"{lookup.target}: the dimension has more than one row of the key "), shown))
        one = F.when(F.count(F.lit(1)) > 1, twice).otherwise(one)
    right = rows.groupBy(*keys).agg(one.alias("__skey"))
    matches = [named(ours) == F.col(k) for k, ours in zip(keys, lookup.on)]
    joined = facts.join(F.broadcast(right) if small else right, matches, "left")
    return joined.select(*named_all(facts.columns), _with_unknown(F.col("__skey"), lookup).alias(lookup.target))


def _rows_of(lookup: Lookup) -> DataFrame:
    """Keys and surrogate key of the rows that a lookup without time can find."""
    dim = current_versions(lookup.dimension) if IS_CURRENT in lookup.dimension.columns else lookup.dimension
    keys = [f"__d{i}" for i in range(len(lookup.on))]
    return dim.select(
        *(named(theirs).alias(k) for k, theirs in zip(keys, lookup.on.values())), named(lookup.skey).alias("__skey")
    ).dropna(subset=keys)


# A dimension is sent to every task only below both bounds; they choose the plan, never the answer or whether there is one.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# The second one bounds the versions a single fact is compared with.
BROADCAST_VERSIONS = 200


def with_skey_as_of(
    facts: DataFrame,
    lookup: Lookup,
    skew: SkewPolicy = SkewPolicy(),
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds the key of the version in force at each fact's event time; every fact stays one row.

    In force is the version that started last at or before that time, until it ends. Where
    versions of a key overlap, the later start rules from its start on, also after its own end:
    the facts there match nothing. Of versions with one start, the one with the latest end and
    then the largest key counts.

    A dimension that is measured small, in rows, bytes and versions per key, is broadcast.
    Otherwise facts and versions are ordered together by key and time and the last version
    is filled forward: one shuffle and one sort, never facts x versions. Measuring runs one job
    over the dimension's key columns while the plan is built. Streamed facts are refused whatever the
    dimension's size: strata.streaming.facts.land_facts runs this for each micro-batch.
    """
    _refuse_stream(facts, lookup)
    return _as_of(facts, lookup, _is_small(lookup, broadcast_rows, broadcast_bytes), skew)


def _as_of(facts: DataFrame, lookup: Lookup, small: bool, skew: SkewPolicy) -> DataFrame:
    if not small:
        return _ordered(facts, lookup, _slices(facts, lookup, skew))
    versions, keys = _versions_of(lookup)
    return _answered(facts, lookup, _join_versions(_keyed(facts, lookup, versions), versions, keys))


def _ordered(facts: DataFrame, lookup: Lookup, slicing: Slicing | None) -> DataFrame:
    versions, keys = _versions_of(lookup)
    return _answered(facts, lookup, _fill_versions(_keyed(facts, lookup, versions), versions, keys, slicing, facts.columns))


def _answered(facts: DataFrame, lookup: Lookup, found: DataFrame) -> DataFrame:
    return found.select(*named_all(facts.columns), _with_unknown(F.col("__skey"), lookup).alias(lookup.target))


def _versions_of(lookup: Lookup) -> tuple[DataFrame, list[str]]:
    keys = [f"__k{i}" for i in range(len(lookup.on))]
    versions = lookup.dimension.select(
        *(named(theirs).alias(k) for k, theirs in zip(keys, lookup.on.values())),
        named(EFFECTIVE_FROM).alias("__from"),
        named(EFFECTIVE_TO).alias("__to"),
        named(lookup.skey).alias("__skey"),
    ).dropna(subset=[*keys, "__from"])
    return versions, keys


def _keyed(facts: DataFrame, lookup: Lookup, versions: DataFrame) -> DataFrame:
    """The facts with the lookup's key columns and time beside them."""
    start = versions.schema["__from"].dataType
    if isinstance(start, T.NumericType) != isinstance(facts.schema[lookup.event_time].dataType, T.NumericType):
        raise ValueError(f"{lookup.event_time}: event time and validity must both be times or both be sequence numbers")
    return facts.withColumns({f"__k{i}": named(ours) for i, ours in enumerate(lookup.on)}).withColumn(
        "__t", named(lookup.event_time).cast(start)
    )


def _is_small(lookup: Lookup, broadcast_rows: int, broadcast_bytes: int) -> bool:
    """Whether the dimension may be sent to every task. Runs one job over its key columns."""
    rows = _versions_of(lookup)[0] if lookup.as_of else _rows_of(lookup)
    keys = rows.columns[: len(lookup.on)]
    # Three fixed columns and a row's overhead, and the keys as text.
    width = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(64))
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes"))
    total, size, longest = (x or 0 for x in per_key.agg(F.sum("n"), F.sum("bytes"), F.max("n")).first())
    return total <= broadcast_rows and size <= broadcast_bytes and longest <= BROADCAST_VERSIONS


def _complete(keys: Sequence[str]) -> Column:
    held = F.col("__t").isNotNull()
    for key in keys:
        held = held & F.col(key).isNotNull()
    return held


def _slices(facts: DataFrame, lookup: Lookup, skew: SkewPolicy) -> Slicing | None:
    """Where the keys are cut that have too many facts and versions for one task."""
    versions, keys = _versions_of(lookup)
    rows = _keyed(facts, lookup, versions).where(_complete(keys))
    moments = rows.select(*keys, "__t").unionByName(versions.select(*keys, F.col("__from").alias("__t")))
    return find_long_keys(moments, keys, "__t", skew)


def _refuse_stream(facts: DataFrame, lookup: Lookup) -> None:
    if facts.isStreaming:
        raise ValueError(f"{lookup.target}: streamed facts find versions by micro-batch, with land_facts")


def _join_versions(keyed: DataFrame, versions: DataFrame, keys: list[str]) -> DataFrame:
    """Each version cut off where the next one starts, so that one at most holds a fact's time."""
    # Of versions with one start, all but the last are cut off at that start, and so hold nothing.
    later = F.lead("__from").over(Window.partitionBy(*keys).orderBy("__from", "__to", "__skey"))
    cut = versions.select(*(F.col(k).alias(f"__d{k}") for k in keys), "__from", "__to", "__skey", later.alias("__until"))
    condition = [F.col(k) == F.col(f"__d{k}") for k in keys]
    condition += [F.col("__t") >= F.col("__from"), F.col("__t") < F.col("__to")]
    condition += [F.col("__until").isNull() | (F.col("__t") < F.col("__until"))]
    return keyed.join(F.broadcast(cut), condition, "left")


def _fill_versions(
    keyed: DataFrame, versions: DataFrame, keys: list[str], slicing: Slicing | None, carried: Sequence[str]
) -> DataFrame:
    """The `carried` columns of each fact and its __skey."""
    # Facts without key or time match nothing. They stay out of the shuffle, where they
    # would all meet in one task.
    complete = _complete(keys)
    unmatched = keyed.where(~complete).withColumn("__skey", F.lit(None).cast("bigint"))
    rows = keyed.where(complete)

    crowds = None
    if slicing is not None and slicing.repeats is not None:
        # Many facts with one key and one time cannot be cut apart, but have one answer: that of the moment.
        at = [*keys, "__t"]
        repeats = F.broadcast(slicing.repeats)
        theirs = versions.join(F.broadcast(slicing.repeats.select(*keys).distinct()), keys, "left_semi")
        moments = slicing.repeats.select(*at, F.struct(*at).alias("__fact"))
        answers = _fill_moments(moments, theirs, keys, slicing).select("__fact.*", "__skey")
        crowds = rows.join(repeats, at, "left_semi").join(F.broadcast(answers), at, "left")
        rows = rows.join(repeats, at, "left_anti")

    # A single column needs no struct around it, which would more than double its bytes in the shuffle.
    alone = len(carried) == 1
    asked = rows.select(*keys, "__t", (named(carried[0]) if alone else F.struct(*named_all(carried))).alias("__fact"))
    found = _fill_moments(asked, versions, keys, slicing)
    found = found.select(F.col("__fact").alias(carried[0]) if alone else "__fact.*", "__skey")
    for others in (unmatched, crowds):
        if others is not None:
            found = found.unionByName(others.select(*named_all(found.columns)))
    return found


def _fill_moments(asked: DataFrame, versions: DataFrame, keys: list[str], slicing: Slicing | None) -> DataFrame:
    """The surrogate key in force for each row of `asked` (keys, __t, __fact): rows and versions in one order, the last
    version filled forward."""
    nothing = F.lit(None)
    left = asked.select(
        *keys,
        "__t",
        "__fact",
        nothing.cast(versions.schema["__skey"].dataType).alias("__skey"),
        nothing.cast(versions.schema["__to"].dataType).alias("__to"),
    )
    right = versions.select(
        *keys,
        F.col("__from").alias("__t"),
        nothing.cast(left.schema["__fact"].dataType).alias("__fact"),
        "__skey",
        "__to",
    )
    both = left.unionByName(right)

    def filled(rows: DataFrame, sliced: bool) -> DataFrame:
        # Shuffled before anything is derived, so that the mark does not travel beside its parts.
        rows = rows.repartition(*keys, *([SLICE] if sliced else [])).withColumn("__asks", F.col("__fact").isNotNull())
        mark = F.when(~F.col("__asks"), F.struct("__skey", "__to"))
        # At one instant versions come before facts, and the one that counts comes last.
        return fill_forward(rows, keys, ["__t", "__asks", "__to", "__skey"], {"__version": mark}, sliced)

    if slicing is None:
        found = filled(both, False)
    else:
        short, long = split_long_keys(both, keys, "__t", slicing)
        found = filled(short, False).unionByName(filled(long, True).drop(SLICE))
    valid = F.col("__t") < F.col("__version.__to")
    return found.where("__asks").select("__fact", F.when(valid, F.col("__version.__skey")).alias("__skey"))


def fact(facts: DataFrame, lookups: Sequence[Lookup], skew: SkewPolicy = SkewPolicy(), broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A fact table: one surrogate key per dimension in front, then the fact's columns.

    Where two or more dimensions are too large to broadcast, the facts are numbered and written once. Each
    lookup shuffles numbers, keys and times only, and what it finds comes back to the facts by number: the facts'
    own columns are shuffled once, however many dimensions there are. A lookup may read the key that an
    earlier one gave; such a one runs after that join.
    """
    small: dict[int, bool] = {}
    if len(lookups) > 1 and not facts.isStreaming:
        there = set(facts.columns)
        small = {i: _is_small(x, broadcast_rows, BROADCAST_BYTES) for i, x in enumerate(lookups) if there.issuperset(x.reads)}
    together = [i for i, fits in small.items() if not fits]
    if len(together) > 1:
        facts = _in_one_pass(facts, [lookups[i] for i in together], skew)
    else:
        together = []
    for i, lookup in enumerate(lookups):
        if i in together:
            continue
        if not lookup.as_of:
            facts = _join_row(facts, lookup, small.get(i, False))
        elif i in small:
            facts = _as_of(facts, lookup, small[i], skew)
        else:
            facts = with_skey_as_of(facts, lookup, skew, broadcast_rows)
    skeys = [lookup.target for lookup in lookups]
    rest = [c for c in facts.columns if c not in (*skeys, *DIM_SHEDS)]
    return facts.select(*named_all(skeys), *named_all(rest))


def _in_one_pass(facts: DataFrame, lookups: Sequence[Lookup], skew: SkewPolicy) -> DataFrame:
    """All these keys, with one shuffle of the facts' columns."""
    stored, number = _numbered(facts)
    found = stored
    for i, lookup in enumerate(lookups):
        answers = _answers(stored, number, lookup, skew).select(F.col(number).alias(f"__n{i}"), F.col("__skey").alias(f"__s{i}"))
        # Only the groups are keys of the join, which would else scatter neighbours.
        ours, theirs = F.col(number), F.col(f"__n{i}")
        same = [_group(ours) == _group(theirs), ours >= theirs, ours <= theirs]
        found = found.join(answers, same, "left").drop(f"__n{i}")
    keys = [_with_unknown(F.col(f"__s{i}"), lookup).alias(lookup.target) for i, lookup in enumerate(lookups)]
    return found.select(*named_all(facts.columns), *keys)


# Facts meet their answers by groups of 2 ** _GROUP_BITS that were written one after another: neighbours are
# alike, and much shorter in a shuffle where they stay together.
_GROUP_BITS = 6


def _group(number: Column) -> Column:
    return F.shiftright(number, _GROUP_BITS)


def _numbered(facts: DataFrame) -> tuple[DataFrame, str]:
    """The facts, written once, and the column with their number: read again, each has the number it asked with."""
    number = _unused("__number", facts)
    written = facts.withColumn(number, F.monotonically_increasing_id())
    # Numbers that rise by one, and facts in some order, are half as long in zstd.
    stored = stored_once(written, scratch_dir(facts.sparkSession, "facts"), "zstd")
    # Spark's ids have the task above 33 bits of the place in it. Numbers without that gap are shorter.
    task, place = F.shiftright(number, 33), F.col(number).bitwiseAND(F.lit((1 << 33) - 1))
    tasks = (stored.agg(F.max(task)).first()[0] or 0) + 1
    group, within = _group(place) * F.lit(tasks) + task, place.bitwiseAND(F.lit((1 << _GROUP_BITS) - 1))
    return stored.withColumn(number, F.shiftleft(group, _GROUP_BITS).bitwiseOR(within)), number


def _unused(name: str, df: DataFrame) -> str:
    held = {c.lower() for c in df.columns}
    while name in held:
        name += "_"
    return name


def _answers(numbered: DataFrame, number: str, lookup: Lookup, skew: SkewPolicy) -> DataFrame:
    """Number and surrogate key (__skey) of the facts that the lookup finds. No other column of the facts is shuffled."""
    asked = numbered.select(number, *named_all(dict.fromkeys(lookup.reads)))
    if not lookup.as_of:
        held = asked.dropna(subset=list(lookup.on))
        found = _join_row(held, replace(lookup, into="__skey", unknown=None), small=False)
    else:
        versions, keys = _versions_of(lookup)
        slicing = _slices(asked, lookup, skew)
        found = _fill_versions(_keyed(asked, lookup, versions).select(number, *keys, "__t"), versions, keys, slicing, [number])
    return found.select(number, "__skey").where("__skey IS NOT NULL")
