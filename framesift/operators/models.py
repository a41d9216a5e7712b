"""Caption models and their per-worker cache.

A model is called with a batch, a dict of equally long arrays (``video_id``,
``frames``, ``num_frames``, ``duration_sec``), and returns one text per row. Its
answers must not depend on how rows are batched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import cloudpickle

# Models of this worker process, one version of each name. Tasks of one worker share it.
_loaded: dict[str, tuple[str | None, Callable]] = {}


@dataclass(frozen=True)
class Model:
    name: str
    """A worker keeps one model of a name."""

    load: Callable[[], Callable]
    """Builds the model; runs once per Python worker and version."""

    version: str | None = None
    """Tells models of one name apart; ``get_model`` takes it from ``load`` itself."""


def loaded(model: Model) -> Callable:
    """The model of this worker. Another version of the name replaces the one held."""
    held = _loaded.get(model.name)
    if held is None or held[0] != model.version:
        _loaded.pop(model.name, None)
        _loaded[model.name] = held = (model.version, model.load())
    return held[1]


class FirstLastModel:
    """Deterministic stand-in: unit count, first and last sampled unit."""

    def __call__(self, batch: dict) -> list[str]:
        rows = zip(batch["num_frames"], batch["frames"])
        return [f"{total} {units[0]} {units[-1]}" for total, units in rows]


class FrameMeanModel:
    """Deterministic stand-in for frames: unit count and mean brightness."""

    def __call__(self, batch: dict) -> list[str]:
        return [
            f"{total} {sum(map(sum, units)) / max(sum(map(len, units)), 1):.1f}"
            for total, units in zip(batch["num_frames"], batch["frames"])
        ]


MODELS: dict[str, Model] = {
    "first-last": Model("first-last", FirstLastModel),
    "frame-mean": Model("frame-mean", FrameMeanModel),
}


def register_model(model: Model) -> None:
    MODELS[model.name] = model


def get_model(model: str | Model) -> Model:
    """The model as it is sent to the workers: with a digest of its ``load``, so that
    workers that outlive a job don't answer with an older model of the same name."""
    if not isinstance(model, Model):
        if model not in MODELS:
            raise ValueError(f"unknown model: {model!r}")
        model = MODELS[model]
    if model.version is None:
        model = replace(model, version=hashlib.sha256(cloudpickle.dumps(model.load)).hexdigest())
    return model
