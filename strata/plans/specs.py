"""A registry of source systems, resolved into one specification per object and hop."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from ..constants import END_OF_TIME, FIELD_SEPARATOR, NULL_MARKER, START_OF_TIME
from ..operators.cdc import ChangeSpec
from ..operators.processed import ProcessedSpec, read_rules
from ..operators.raw import RawSpec, check_raw_modes

LAYERS = ("l01", "l02", "l03")

# Where each hop lives unless the registry's "hops" section says otherwise.
HOPS = {
    "l01": {"location": "bronze", "name": "raw", "schema": "01_bronze"},
    "l02": {"location": "silver", "name": "cdc", "schema": "02_silver"},
    "l03": {"location": "silver", "name": "processed", "schema": "02_silver"},
    "gold": {"location": "gold", "name": "", "schema": "03_gold"},
}

SETTINGS = {
    "start_date": START_OF_TIME,
    "end_date": END_OF_TIME,
    "null_value": NULL_MARKER,
    "field_separator": FIELD_SEPARATOR,
}

SECTIONS = (("dimension", "dimensions"), ("fact", "facts"))

_STREAMED = re.compile(r"\bSTREAM\s*\(\s*([\w.`]+)\s*\)", re.IGNORECASE)

# Type 1 for facts, type 2 for dimensions.
SCD_TYPE = {"dimension": 2, "fact": 1}


# Where an object's name goes in its source system's connection.
PLACEHOLDER = "{object}"

# The fields a section of each hop may have.
_ANY_HOP = "catalog comment enabled metadata_driven object_alias object_category object_name primary_key_columns schema source_object".split()
_SETTINGS = "end_date field_separator null_value start_date".split()
OPTIONS = {
    "l01": frozenset(
        [*_ANY_HOP, *_SETTINGS, *"connection data_items filter ingestion_mode merge_strategy source_connection source_type source_updated_at_col".split()]
    ),
    "l02": frozenset(
        [
            *_ANY_HOP, *_SETTINGS,
            *"apply_as_deletes buckets ignore_null_updates keys on_refused scd_type sequence_by tie_breaker track_audit track_history_column_list".split(),
        ]
    ),
    "l03": frozenset([*_ANY_HOP, *_SETTINGS, *"business_key_columns columns leading_columns read_mode refresh skey_column write_mode".split()]),
    "gold": frozenset(
        [
            *_ANY_HOP, *_SETTINGS,
            *"append_only_source columns create_scd2_view custom_sql filter late_dimensions lookups read_mode refresh scd2_view_name source_catalog source_schema write_mode".split(),
        ]
    ),
}

# The fields of a gold hop's lookup.
LOOKUP_FIELDS = frozenset("dimension event_time into on repeated skey unknown".split())


@dataclass(frozen=True)
class HopSpec:
    """One table: where it comes from, where it goes and the options of its hop."""

    layer: str
    object_key: str
    kind: str
    table: str
    source_table: str | None = None
    location: str = ""
    comment: str | None = None
    options: Mapping[str, Any] = field(default_factory=dict)

    def option(self, name: str, default: Any = None) -> Any:
        value = self.options.get(name)
        return default if value is None else value

    @property
    def incremental(self) -> bool:
        return self.option("refresh") == "incremental"

    def reads(self, table: str) -> bool:
        """Whether this hop needs the table first, by its source, a lookup or the text of its statement."""
        if self.source_table == table or any(x["dimension"] == table for x in self.option("lookups", ())):
            return True
        short = table.rsplit(".", 1)[-1]
        return bool(re.search(rf"(?<![\w]){re.escape(short)}(?![\w])", self.option("custom_sql") or ""))

    # The views of a spec that the operators take.

    def raw(self) -> RawSpec:
        return RawSpec(
            data_items=self.option("data_items"),
            filter=self.option("filter"),
            source_updated_at_col=self.option("source_updated_at_col"),
        )

    def changes(self) -> ChangeSpec:
        return ChangeSpec(
            keys=tuple(self.option("keys", ())),
            sequence_by=self.option("sequence_by", ""),
            scd_type=int(self.option("scd_type", 2)),
            apply_as_deletes=self.option("apply_as_deletes"),
            ignore_null_updates=bool(self.option("ignore_null_updates", False)),
            track_history_column_list=self.option("track_history_column_list"),
            tie_breaker=self.option("tie_breaker"),
            track_audit=bool(self.option("track_audit", False)),
            on_refused=self.option("on_refused", "drop"),
        )

    def processed(self) -> ProcessedSpec:
        return ProcessedSpec(
            columns=read_rules(self.option("columns")),
            business_key_columns=tuple(self.option("business_key_columns", ())),
            skey_column=self.option("skey_column"),
            leading_columns=tuple(self.option("leading_columns", ())),
            end_of_time=self.option("end_date", END_OF_TIME),
            separator=self.option("field_separator", FIELD_SEPARATOR),
        )


def _read_yaml(path: Path) -> dict[str, Any]:
    try:
        import yaml
    except ImportError as error:
        raise ValueError("reading YAML needs the PyYAML package; a registry may as well be a plain dict") from error
    return yaml.safe_load(path.read_text()) or {}


def load_registry(path: str, config_root: str | None = None) -> dict[str, Any]:
    """A registry kept as YAML, with the per-object files under `config_root`, if given.

    A file {location}/{hop}/{hop}_{object}.yml is the object's own section for that hop.
    Files in the folder of the gold location are gold hops, in the order of their paths.
    """
    registry = _read_yaml(Path(path))
    if config_root is None:
        return registry
    hops = _hops(registry)
    for source in (registry.get("source_systems") or {}).values():
        for _, section in SECTIONS:
            for object_key, value in ((source or {}).get(section) or {}).items():
                entry = ObjectEntry.read(section, object_key, value)
                merged: dict[str, Any] = {"primary_key_columns": list(entry.keys), **entry.own}
                for layer in LAYERS:
                    name = hops[layer]["name"]
                    file = Path(config_root, hops[layer]["location"], name, f"{name}_{object_key}.yml")
                    if file.exists():
                        merged[layer] = {**_present(merged.get(layer)), **_present(_read_yaml(file))}
                source[section][object_key] = merged
    gold = [_read_yaml(file) for file in sorted(Path(config_root, hops["gold"]["location"]).rglob("*.yml"))]
    registry["gold"] = [*(registry.get("gold") or []), *gold]
    return registry


@dataclass(frozen=True)
class ObjectEntry:
    """One dimension or fact of a source system: its key columns and what it sets itself.

    An entry may be written as a column name, a list of names, or a mapping.
    """

    kind: str
    name: str
    keys: tuple[str, ...]
    own: Mapping[str, Any]

    @classmethod
    def read(cls, kind: str, name: str, value: Any) -> ObjectEntry:
        own: dict[str, Any] = {}
        if isinstance(value, Mapping):
            own = dict(value)
            value = own.pop("primary_key_columns", None)
        match value:
            case None:
                keys: tuple[Any, ...] = ()
            case str():
                keys = (value,)
            case [*names]:
                keys = tuple(names)
            case _:
                raise ValueError(f"{name}: keys must be a column name or a list of them, not {value!r}")
        if not all(isinstance(k, str) for k in keys):
            raise ValueError(f"{name}: keys must be column names, not {list(keys)!r}")
        _refuse_unknown(name, own, frozenset().union(*OPTIONS.values(), LAYERS))
        for layer in LAYERS:
            _refuse_unknown(f"{name}.{layer}", own.get(layer) or {}, OPTIONS[layer])
        return cls(kind, name, keys, own)

    def section(self, layer: str) -> dict[str, Any]:
        """What the entry sets for this layer: its own values, then those of the layer's section."""
        everywhere = {k: v for k, v in _present(self.own).items() if k not in LAYERS}
        return everywhere | _present(self.own.get(layer))

    def placed(self, value: Any) -> Any:
        """The value with the object's name put in wherever a text, however deep, asks for it."""
        match value:
            case str():
                return value.replace(PLACEHOLDER, self.name)
            case Mapping():
                return {k: self.placed(v) for k, v in value.items()}
            case [*items]:
                return [self.placed(v) for v in items]
        return value


def _refuse_unknown(label: str, section: Mapping[str, Any], known: frozenset[str]) -> None:
    """A field that nothing reads is a typing mistake, and its effect would be missed in silence."""
    unknown = sorted(set(section) - known)
    if unknown:
        raise ValueError(f"{label}: unknown fields {', '.join(map(str, unknown))}")


def _present(options: Mapping[str, Any] | None) -> dict[str, Any]:
    """Blank fields inherit, so they must not hide what they inherit from."""
    return {k: v for k, v in (options or {}).items() if v is not None}


@dataclass(frozen=True)
class _Naming:
    catalog: str
    hops: Mapping[str, Mapping[str, Any]]

    def short(self, layer: str, object_key: str) -> str:
        prefix = self.hops[layer].get("name")
        return f"{prefix}_{object_key}" if prefix else object_key

    def full(self, layer: str, name: str, options: Mapping[str, Any]) -> str:
        hop = self.hops[layer]
        catalog = options.get("catalog") or hop.get("catalog") or self.catalog
        schema = options.get("schema") or hop["schema"]
        return f"{catalog}.{schema}.{name}"


def _hops(registry: Mapping[str, Any]) -> dict[str, dict[str, Any]]:
    return {layer: {**HOPS[layer], **_present((registry.get("hops") or {}).get(layer))} for layer in HOPS}


def _objects(source: Mapping[str, Any]) -> Iterator[ObjectEntry]:
    for kind, section in SECTIONS:
        for key, value in (source.get(section) or {}).items():
            yield ObjectEntry.read(kind, key, value)


def plan_objects(registry: Mapping[str, Any], layers: Sequence[str] = LAYERS) -> list[HopSpec]:
    """Specifications in the order they must run: all raw, then cdc, then processed, then
    the hand-written gold hops.

    A value is looked up in the object's own layer section, the object, the layer defaults of
    the source system, and the settings. A layer that is not enabled is left out.
    """
    settings = {**SETTINGS, **_present(registry.get("settings"))}
    hops = _hops(registry)
    naming = _Naming(registry.get("catalog") or "spark_catalog", hops)
    planned: dict[str, list[HopSpec]] = {layer: [] for layer in (*LAYERS, "gold")}

    for source_name, source in (registry.get("source_systems") or {}).items():
        for layer, section in ((source or {}).get("defaults") or {}).items():
            _refuse_unknown(f"{source_name}.defaults.{layer}", section or {}, OPTIONS.get(layer, frozenset()))
        for entry in _objects(source or {}):
            tables: dict[str, str] = {}
            label = f"{source_name}.{entry.name}"
            for layer in LAYERS:
                defaults = _present((source.get("defaults") or {}).get(layer))
                own = entry.section(layer)
                options = {**settings, **defaults, **own}
                short = (entry.own.get(layer) or {}).get("object_name") or naming.short(layer, entry.name)
                tables[layer] = naming.full(layer, short, options)
                if not defaults.get("enabled", False) or own.get("enabled") is False:
                    continue
                if defaults.get("metadata_driven") is False and not entry.own.get(layer):
                    raise ValueError(f"{label}: {layer} is not metadata-driven, so the object needs its own {layer} section")
                options |= _layer_options(layer, entry, options, source, settings)
                spec = HopSpec(
                    layer=layer,
                    object_key=entry.name,
                    kind=entry.kind,
                    table=tables[layer],
                    source_table=_upstream(layer, options, tables, naming),
                    location=f"{hops[layer]['location']}/{short}",
                    comment=options.get("comment"),
                    options=options,
                )
                _check(spec, label)
                planned[layer].append(spec)

    for entry in registry.get("gold") or ():
        if entry.get("enabled", True):
            planned["gold"].append(_gold(entry, naming, settings))
    planned["gold"] = _by_sources(planned["gold"])
    every = [spec for specs in planned.values() for spec in specs]
    _refuse_streamed_rewrites(every)
    _check_refresh(every)
    wanted = [*layers, *(["gold"] if "gold" not in layers and set(layers) == set(LAYERS) else [])]
    return [spec for layer in wanted for spec in planned[layer]]


def _by_sources(specs: list[HopSpec]) -> list[HopSpec]:
    """The gold hops, each after those it reads; else in the order they are listed."""
    waiting, out = list(specs), []
    while waiting:
        ahead = [s for s in waiting if not any(t.table != s.table and s.reads(t.table) for t in waiting)]
        if not ahead:
            raise ValueError(f"gold hops read each other in a circle: {', '.join(s.object_key for s in waiting)}")
        out.append(ahead[0])
        waiting.remove(ahead[0])
    return out


def _check_refresh(specs: list[HopSpec]) -> None:
    """Tables refreshed by what changed are made row by row, from a cdc table or from one another."""
    feeding = {s.table for s in specs if s.layer == "l02" or s.incremental}
    for spec in specs:
        if spec.layer in ("l03", "gold") and spec.option("refresh", "full") not in ("full", "incremental"):
            raise ValueError(f"{spec.table}: refresh must be 'full' or 'incremental', not {spec.option('refresh')!r}")
        if not spec.incremental:
            continue
        others = [name for name in ("lookups", "custom_sql", "late_dimensions") if spec.option(name)]
        if spec.layer == "gold":
            others += [name for name in ("primary_key_columns",) if spec.option(name)]
        if spec.option("read_mode", "snapshot") != "snapshot" or spec.option("write_mode", "materialized_view") != "materialized_view" or others:
            raise ValueError(f"{spec.table}: an incremental refresh is for materialized views of one table, without {', '.join(others) or 'streams'}")
        if spec.source_table not in feeding:
            raise ValueError(f"{spec.table}: an incremental refresh needs a source that is a cdc table or refreshed so too; {spec.source_table} is not")


def _refuse_streamed_rewrites(specs: list[HopSpec]) -> None:
    """A table that is written anew with each run can't be read as a stream: the second run would fail."""
    rewritten = {s.table for s in specs if s.layer in ("l02", "l03") or s.layer == "gold" and s.option("write_mode") != "streaming_table"}
    rewritten |= {s.table for s in specs if s.layer == "l01" and s.option("merge_strategy") == "overwrite"}
    for spec in specs:
        for name in _STREAMED.findall(spec.option("custom_sql") or ""):
            plain = name.replace("`", "")
            hit = next((t for t in sorted(rewritten) if t == plain or t.endswith(f".{plain}")), None)
            if hit:
                raise ValueError(f"gold hop {spec.object_key}: {hit} is rewritten with each run; read it as a snapshot, without STREAM()")


def _layer_options(
    layer: str, entry: ObjectEntry, options: Mapping[str, Any], source: Mapping[str, Any], settings: Mapping[str, Any]
) -> dict[str, Any]:
    keys = list(entry.keys)
    if layer == "l01":
        connection = {**_present(source.get("connection")), **_present(options.get("connection"))}
        connection.setdefault("null_value", settings["null_value"])
        return {
            "source_type": options.get("source_type") or source.get("source_type") or "cloud_storage",
            "connection": entry.placed(connection),
            "ingestion_mode": options.get("ingestion_mode") or "snapshot",
            "merge_strategy": options.get("merge_strategy") or "append",
        }
    if layer == "l02":
        return {"keys": options.get("keys") or keys, "scd_type": options.get("scd_type") or SCD_TYPE[entry.kind]}
    return {
        "business_key_columns": options.get("business_key_columns") or keys,
        "skey_column": options.get("skey_column") or f"{entry.name}_skey",
        "write_mode": options.get("write_mode") or "materialized_view",
        "read_mode": options.get("read_mode") or "snapshot",
    }


def _upstream(layer: str, options: Mapping[str, Any], tables: Mapping[str, str], naming: _Naming) -> str | None:
    if layer == "l01":
        return None
    before = LAYERS[LAYERS.index(layer) - 1]
    source = options.get("source_object")
    return naming.full(before, source, {}) if source else tables[before]


def _hop_table(source: str, naming: _Naming, place: Mapping[str, Any] | None = None) -> str:
    """Gold reads gold (cons) or processed tables; the name prefix tells which."""
    if "." in source:
        return source
    layer = "l03" if source.startswith(f"{naming.hops['l03']['name']}_") else "gold"
    return naming.full(layer, source, place or {})


def _lookup(name: str, item: Mapping[str, Any], naming: _Naming) -> dict[str, Any]:
    """A surrogate key that a fact takes from a dimension: `on` maps the fact's columns to the dimension's."""
    _refuse_unknown(f"gold hop {name}, lookup", item, LOOKUP_FIELDS)
    for needed in ("dimension", "on", "skey"):
        if not item.get(needed):
            raise ValueError(f"gold hop {name}: a lookup needs {needed}")
    on = item["on"]
    on = {on: on} if isinstance(on, str) else dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    return {**item, "on": on, "dimension": _hop_table(item["dimension"], naming)}


def _gold(entry: Mapping[str, Any], naming: _Naming, settings: Mapping[str, Any]) -> HopSpec:
    name = entry.get("object_name")
    if not name:
        raise ValueError("a gold hop needs an object_name")
    source = entry.get("source_object")
    if not source and not entry.get("custom_sql"):
        raise ValueError(f"gold hop {name} needs a source_object or custom_sql")
    if source:
        source = _hop_table(source, naming, {"catalog": entry.get("source_catalog"), "schema": entry.get("source_schema")})
    _refuse_unknown(f"gold hop {name}", entry, OPTIONS["gold"])
    lookups = [_lookup(name, item, naming) for item in entry.get("lookups") or ()]
    if lookups and entry.get("custom_sql"):
        raise ValueError(f"gold hop {name}: lookups go with a source_object, not with custom_sql")
    return HopSpec(
        layer="gold",
        object_key=name,
        kind="gold",
        table=naming.full("gold", name, entry),
        source_table=source,
        location=f"{naming.hops['gold']['location']}/{name}",
        comment=entry.get("comment"),
        options={**settings, **_present(entry), "lookups": lookups},
    )


def _check(spec: HopSpec, label: str) -> None:
    """Every refusal that needs no data, before any job runs."""
    if spec.layer == "l01":
        check_raw_modes(spec.option("ingestion_mode"), spec.option("merge_strategy"), label)
        if spec.option("source_type") != "cloud_storage" and not spec.option("source_updated_at_col"):
            raise ValueError(f"{label}: a {spec.option('source_type')} source has no file time; set source_updated_at_col")
    if spec.layer == "l02":
        try:
            spec.changes()
        except ValueError as error:
            raise ValueError(f"{label}: {error}") from error
    if spec.layer == "l03":
        spec.processed()
        if spec.option("read_mode") == "stream":
            raise ValueError(f"{label}: the cdc table is rewritten, so processed must read it as a snapshot")
