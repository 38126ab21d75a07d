"""Best exposure per channel and the model-ready panel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.grain import Grain
from mediamix.modelling.search import ModelSpec
from mediamix.operators import conform
from mediamix.session import cut_lineage


@dataclass(frozen=True)
class ModelReady:
    panel: DataFrame
    registry: DataFrame
    correlations: DataFrame


def target_of(registry: DataFrame) -> str:
    found = registry.filter(F.col("role") == "global_response").orderBy("rank").limit(1).collect()
    if not found:
        raise ValueError("the registry names no global response")
    return found[0]["field_name"]


def exposures_of(registry: DataFrame) -> list[tuple[str, str]]:
    """(channel, field) in preference order, at most two per channel."""
    rows = registry.filter(F.col("role") == "exposure").orderBy("channel", "rank").collect()
    return [(r["channel"], r["field_name"]) for r in rows]


def premodel(panel: DataFrame, registry: DataFrame, grain: Grain, absolute: bool = False) -> ModelReady:
    """Registry with the best exposure of each channel, and the panel a model reads.

    Entries whose column the panel lacks are left out first, channels that lose their
    spend or exposure with them.
    """
    registry = registry.filter(F.col("field_name").isin(panel.columns))
    correlations = conform.exposure_correlations(panel, exposures_of(registry), target_of(registry), absolute)
    correlations = cut_lineage(correlations)
    chosen = cut_lineage(conform.with_best_exposures(registry, conform.best_exposures(correlations)))
    ready = conform.model_ready_panel(panel, grain.keys, grain.date, conform.model_columns(chosen))
    return ModelReady(ready, chosen, correlations)


def model_spec(registry: DataFrame, signs: Sequence[str] | None = None) -> tuple[ModelSpec, list[tuple[str, str, str]]]:
    """Model specification and (channel, spend, exposure) of its media.

    ``signs`` has one entry per control; without it controls are unconstrained.
    """
    media = [tuple(r) for r in conform.model_spec(registry).orderBy("channel").select("channel", "spend", "exposure").collect()]
    controls = [
        r["field_name"] for r in registry.filter(F.col("role") == "global_control").orderBy("rank").collect()
    ]
    constraint = conform.check_signs(controls, signs if signs is not None else ["default"] * len(controls))
    spec = ModelSpec(target_of(registry), tuple((c, s) for c, s, _ in media), tuple(constraint.items()))
    return spec, media
