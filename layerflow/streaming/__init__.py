"""The layered flow over files that arrive."""

from layerflow.streaming.arrivals import run_arrivals

__all__ = ["run_arrivals"]
