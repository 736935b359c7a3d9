"""Whole flows composed of the operators, sources and sinks."""

from layerflow.plans.incremental import run_increment
from layerflow.plans.layers import LayerRun, TableSpec, run_layers
from layerflow.plans.orders import orders_spec
from layerflow.plans.replay import Replay, replay_quarantine, replayable

__all__ = [
    "LayerRun",
    "Replay",
    "TableSpec",
    "orders_spec",
    "replay_quarantine",
    "replayable",
    "run_increment",
    "run_layers",
]
