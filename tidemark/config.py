"""Job configuration, parsed from JSON."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from .sinks.files import NO_MARK_COLUMN, WriteMode



class ConfigError(ValueError):
    """A job configuration lacks a field or holds a wrong one."""


def render_path(template: str, **parts: str) -> str:
    """Fill a path template such as ``{source_type}/{data_source}/{schema}/{table}`` or
    ``{origin}/{schema}/{table}``."""
    try:
        return template.format(**parts)
    except KeyError as missing:
        raise ConfigError(f"path template needs {missing}") from None


SESSION_CATALOG = "spark_catalog"  # its tables need no catalog in their names


def short_name(table: str) -> str:
    """Last dotted part of a table's name."""
    return table.rsplit(".", 1)[-1]


def bronze_schema(data_source: str, schema: str) -> str:
    """The schema name with the data source in front, unless it is already in there."""
    return schema if data_source in schema else f"{data_source}_{schema}"


@dataclass(frozen=True)
class TableSpec:
    """How one table is taken in; ``options`` holds what only its reader knows."""

    schema: str
    table: str
    reader: str = "database"
    mark_column: str = NO_MARK_COLUMN
    incremental_where: str | None = None
    full_where: str | None = None
    mode: WriteMode | None = None
    file_format: str = "json"
    options: Mapping[str, object] = field(default_factory=dict)

    @property
    def write_mode(self) -> WriteMode:
        return self.mode or WriteMode.for_mark_column(self.mark_column)

    @property
    def has_mark(self) -> bool:
        return self.mark_column not in ("", NO_MARK_COLUMN)


_SPEC_FIELDS = {"reader", "mark_column", "incremental_where", "full_where", "file_format"}
# Other names under which configurations hold these fields.
_SPEC_ALIASES = {"incremental_col": "mark_column"}


def _table_specs(schemas: Mapping[str, object]) -> tuple[TableSpec, ...]:
    specs = []
    for schema, tables in schemas.items():
        if isinstance(tables, list):  # the older shape, [{table: mode}, ...]
            tables = {name: {"mode": mode} for entry in tables for name, mode in entry.items()}
        for table, about in tables.items():
            about = {_SPEC_ALIASES.get(k, k): v for k, v in (about or {}).items()}
            known = {k: v for k, v in about.items() if k in _SPEC_FIELDS}
            rest = {k: v for k, v in about.items() if k not in _SPEC_FIELDS and k != "mode"}
            mode = WriteMode.of(about["mode"]) if about.get("mode") else None
            specs.append(TableSpec(schema, table, mode=mode, options=rest, **known))
    return tuple(specs)


def _load(text: str | Mapping[str, object], required: tuple[str, ...]) -> dict:
    raw = dict(json.loads(text) if isinstance(text, str) else text)
    missing = [name for name in required if name not in raw]
    if missing:
        raise ConfigError(f"configuration lacks {', '.join(missing)}")
    return raw


class _Named:
    """Path parts and table names shared by both kinds of job."""

    prefix_schema = True

    def parts(self, spec: TableSpec) -> dict[str, str]:
        return {
            "source_type": self.source_type,
            "data_source": self.data_source,
            "origin": self.data_source or self.db_name,
            "schema": spec.schema,
            "table": short_name(spec.table),
        }

    def bronze_name(self, spec: TableSpec) -> str:
        prefixed = self.prefix_schema and self.data_source
        schema = bronze_schema(self.data_source, spec.schema) if prefixed else spec.schema
        name = f"{schema}.{short_name(spec.table)}"
        return name if self.catalog in ("", SESSION_CATALOG) else f"{self.catalog}.{name}"


@dataclass(frozen=True)
class LandingJob(_Named):
    """Source to landing files. ``input`` is a template of the source files, where a
    reader has any; ``outputs`` one of the landing folder."""

    catalog: str
    metadata: Mapping[str, object]
    tables: tuple[TableSpec, ...]
    outputs: str
    incremental: bool = True
    input: str = ""
    source_type: str = ""
    data_source: str = ""
    frequency: str = "daily"
    db_name: str = ""
    engine: str | None = None
    prefix_schema: bool = True

    @classmethod
    def from_json(cls, text: str | Mapping[str, object]) -> LandingJob:
        raw = _load(text, ("catalog", "metadata", "schemas", "outputs"))
        optional = {
            k: raw[k]
            for k in ("incremental", "input", "source_type", "data_source", "frequency", "db_name", "engine", "prefix_schema")
            if k in raw
        }
        return cls(raw["catalog"], raw["metadata"], _table_specs(raw["schemas"]), raw["outputs"], **optional)


@dataclass(frozen=True)
class BronzeJob(_Named):
    """Landing files to bronze tables; ``location`` and ``checkpoints`` are templates."""

    input_path: str
    tables: tuple[TableSpec, ...]
    location: str
    checkpoints: str
    catalog: str = SESSION_CATALOG
    source_type: str = ""
    data_source: str = ""
    db_name: str = ""
    prefix_schema: bool = True

    @classmethod
    def from_json(cls, text: str | Mapping[str, object]) -> BronzeJob:
        raw = _load(text, ("input_path", "schemas", "location", "checkpoints"))
        optional = {
            k: raw[k] for k in ("catalog", "source_type", "data_source", "db_name", "prefix_schema") if k in raw
        }
        return cls(
            raw["input_path"], _table_specs(raw["schemas"]), raw["location"], raw["checkpoints"], **optional
        )


@dataclass(frozen=True)
class MaintenanceJob:
    retention_hours: int
    catalogs: tuple[str, ...]

    @classmethod
    def from_json(cls, text: str | Mapping[str, object]) -> MaintenanceJob:
        raw = _load(text, ("retention_hours", "catalogs"))
        return cls(int(raw["retention_hours"]), tuple(raw["catalogs"]))
