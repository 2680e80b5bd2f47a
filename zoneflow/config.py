"""Configuration of a domain table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from zoneflow.operators.cdc import ZONES
from zoneflow.operators.ingest import DEFAULT_MODE, resolve_mode
from zoneflow.operators.quality import NOT_NULL, DQRule, rules_from_config

DEFAULT_PREFIX = "path/to/{domain}/{zone}/"  # fixed value: snapshot prefix of a zone without one


@dataclass(frozen=True)
class ZoneConfig:
    """Settings of one (domain, table). A section the file lacks turns its stage off."""

    domain: str
    table: str
    id_column: str = "record_id"
    ingestion_type: str = DEFAULT_MODE
    datasets: Mapping[str, str] = field(default_factory=dict)
    mapping_schemas: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    prefixes: Mapping[str, str] = field(default_factory=dict)
    reconcile_enabled: bool = False
    compare_columns: tuple[str, ...] = ()
    rules: tuple[DQRule, ...] = ()
    structure: Mapping[str, str] = field(default_factory=dict)
    structure_mode: str = "quarantine"
    dependencies: Mapping[str, list] = field(default_factory=dict)

    def dataset(self, zone: str) -> str:
        return self.datasets.get(zone, f"{self.domain}_{zone}")

    def table_path(self, root: str, zone: str) -> str:
        name = f"{self.table}_raw" if zone == ZONES[0] else self.table
        return f"{root}/{self.dataset(zone)}/{name}"

    def log_path(self, root: str, log: str) -> str:
        return f"{root}/{self.dataset('framework')}/{log}"


def parse_config(raw: Mapping[str, Any], domain: str | None = None, table: str | None = None) -> ZoneConfig:
    """Settings from a configuration mapping, as loaded from YAML."""
    domain = domain or raw["domain"]
    table = table or raw["table"]
    reconciler = raw.get("reconciler") or {}
    dq = raw.get("dq") or {}
    rules = []
    if dq.get("not_null"):
        rules.append(DQRule(NOT_NULL, tuple(dq["not_null"])))
    rules.extend(rules_from_config(raw.get("rules") or dq.get("rules") or ()))
    return ZoneConfig(
        domain=domain,
        table=table,
        id_column=raw.get("id_column", "record_id"),
        ingestion_type=resolve_mode(raw.get("ingestion_type")),
        datasets={z: raw[f"{z}_dataset"] for z in (*ZONES, "framework") if f"{z}_dataset" in raw},
        mapping_schemas=reconciler.get("mapping_schemas") or raw.get("mapping_schemas") or {},
        prefixes={z: reconciler.get(f"aws_prefix_{z}", DEFAULT_PREFIX.format(domain=domain, zone=z)) for z in ZONES},
        reconcile_enabled=bool(raw.get("reconcile_enabled", bool(reconciler))),
        compare_columns=tuple(reconciler.get("compare_columns") or ()),
        rules=tuple(rules),
        structure=raw.get("structure") or {},
        structure_mode=raw.get("structure_mode", "quarantine"),
        dependencies=raw.get("dependencies") or {},
    )


def load_config(path: str, domain: str | None = None, table: str | None = None) -> ZoneConfig:
    """Settings from a YAML file; a missing file is an error."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return parse_config(yaml.safe_load(handle) or {}, domain, table)
