"""Places for models: a registry of batch functions and stand-ins that need no weights."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..functions.signal import frame_levels

_MODELS: dict[tuple[str, str], Callable] = {}
KINDS = ("vad", "asr", "ctc", "denoise", "loudness", "refine", "tts")


def register(kind: str, name: str):
    """A decorator: the function builds a model once a task and returns what maps a batch (a pandas frame) to rows."""
    if kind not in KINDS:
        raise ValueError(f"no kind of model {kind}: {', '.join(KINDS)}")

    def add(build: Callable) -> Callable:
        _MODELS[kind, name] = build
        return build

    return add


def device(name: str = "auto", available: Callable[[], bool] = lambda: False) -> str:
    """auto: the accelerator if there is one, else the processor."""
    return ("gpu" if available() else "cpu") if name == "auto" else name


def run(df: DataFrame, kind: str, name: str, schema: str, batch: int = 4, **options) -> DataFrame:
    """The model over df, `batch` rows at a time, one model a task; a name that is not registered raises."""
    if (kind, name) not in _MODELS:
        raise ValueError(f"no {kind} model {name}")
    build = _MODELS[kind, name]

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = build(**options)
        for f in frames:
            for at in range(0, len(f), batch):
                yield model(f.iloc[at : at + batch])

    return df.mapInPandas(each, schema)


@register("vad", "level")
def level_vad(threshold_db: float = -40.0, hop_ms: float = 10.0):
    """Regions of hops over a level."""

    def model(f: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for key, x, rate in zip(f["source_id"], f["samples"], f["rate"], strict=True):
            loud = np.r_[0, frame_levels(np.asarray(x, np.float32), int(rate), hop_ms) > threshold_db, 0].astype(int)
            edge, step = np.flatnonzero(np.diff(loud)), hop_ms / 1000
            rows += [(key, k, a * step, b * step) for k, (a, b) in enumerate(zip(edge[::2], edge[1::2], strict=True))]
        return pd.DataFrame(rows, columns=["source_id", "ord", "s", "e"])

    return model


@register("denoise", "copy")
def copy_denoiser():
    return lambda f: f


@register("denoise", "gate")
def gate_denoiser(threshold_db: float = -60.0):
    """Samples under a level become silence."""
    limit = 10 ** (threshold_db / 20)

    def model(f: pd.DataFrame) -> pd.DataFrame:
        return f.assign(samples=[np.where(np.abs(np.asarray(x, np.float32)) < limit, 0, x).astype(np.float32) for x in f["samples"]])

    return model


@register("asr", "echo")
def echo_recogniser(text: str = "ref_text"):
    """The text that is there already, as what was heard."""
    return lambda f: pd.DataFrame({"clip": f["clip"], "heard": f[text].fillna("")})


@register("tts", "tone")
def tone_speaker(rate: int = 8000, hertz: float = 220.0):
    """A tone of a twentieth of a second a character."""

    def model(f: pd.DataFrame) -> pd.DataFrame:
        waves = [np.sin(np.arange(int(len(t) * 0.05 * rate / s)) * hertz * 2 * np.pi / rate).astype(np.float32) for t, s in zip(f["text"], f["speed"], strict=True)]
        return pd.DataFrame({"chunk": f["chunk"], "samples": waves, "rate": rate})

    return model
