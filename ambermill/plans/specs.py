"""Typed feature-group specs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from ambermill.config import load_feature_groups
from ambermill.operators.windows import FeatureAgg, TrailingFrame

KNOWN = {"entity_key", "event_ts_col", "event_date_col", "grain", "windows", "aggregations", "joins", "output", "quality"}


@dataclass(frozen=True)
class FeatureJoin:
    feature_group: str
    keys: tuple[str, ...]
    tolerance_seconds: int
    prefix: str


@dataclass(frozen=True)
class FeatureSpec:
    name: str
    entity_key: tuple[str, ...]
    event_ts_col: str
    event_date_col: str
    output: str
    grain: str = "event"
    frames: tuple[TrailingFrame, ...] = ()
    aggs: tuple[FeatureAgg, ...] = ()
    joins: tuple[FeatureJoin, ...] = ()
    quality: Mapping = field(default_factory=dict)


def parse_spec(name: str, raw: Mapping) -> FeatureSpec:
    if unknown := raw.keys() - KNOWN:
        raise ValueError(f"{name}: unknown keys {sorted(unknown)}")
    if raw.get("grain", "event") not in ("event", "day"):
        raise ValueError(f"{name}: grain must be event or day")
    return FeatureSpec(
        name=name,
        entity_key=tuple(raw["entity_key"]),
        event_ts_col=raw["event_ts_col"],
        event_date_col=raw["event_date_col"],
        output=raw["output"],
        grain=raw.get("grain", "event"),
        frames=tuple(TrailingFrame(w["name"], w["start"], w["end"]) for w in raw.get("windows", ())),
        aggs=tuple(FeatureAgg(a["prefix"], a["fn"], a["col"]) for a in raw.get("aggregations", ())),
        joins=tuple(FeatureJoin(j["feature_group"], tuple(j["keys"]), j["tolerance_seconds"], j["prefix"]) for j in raw.get("joins", ())),
        quality=raw.get("quality", {}),
    )


def load_specs(path: str | None = None) -> dict[str, FeatureSpec]:
    groups = load_feature_groups(path) if path else load_feature_groups()
    return {name: parse_spec(name, raw) for name, raw in groups.items()}
