"""Filters over tables of blocks (see frames.py): another rate, a high-pass, the head of a recording, and less noise.

Each kernel has as much of the neighbours as its filter remembers, and frames and phases count from the start of the recording, so
results do not depend on where blocks are cut.
"""

from __future__ import annotations

from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import BLOCK, _each, with_halo

#: Zero crossings of the low-pass on either side, its window's shape, and its edge as a share of the lower rate's half.
CROSSINGS, BETA, EDGE = 48, 10.0, 0.93
#: Periods of a high-pass's edge after which what came before is forgotten (to 1e-15).
FORGET = 8.0
#: Samples of a frame of the noise reducer and between frames.
FRAME, HOP = 1024, 256


def _block(samples: np.ndarray, first, rate: int, total: int, block: int) -> dict:
    """One row of BLOCK, as columns."""
    lists = pa.ListArray.from_arrays(pa.array([0, len(samples)], pa.int32()), pa.array(samples.astype(np.float32)))
    return {"rate": pa.array([rate], pa.int32()), "total": pa.array([total], pa.int64()), "block": pa.array([block], pa.int64()), "first": pa.array([first], pa.int64()), "samples": lists}


def head(blocks: DataFrame, seconds: float) -> DataFrame:
    """The first seconds of each recording: a preview. Blocks behind are not read where the source can leave them out."""
    most = F.least(F.col("total"), F.ceil(F.col("rate") * seconds))
    x = blocks.where(F.col("first") < F.col("rate") * seconds)
    return x.withColumns({"samples": F.slice("samples", F.lit(1), F.least(F.size("samples").cast("long"), most - F.col("first")).cast("int")), "total": most})


def _phases(up: int, down: int) -> tuple[np.ndarray, int]:
    """The taps of each of `up` phases, and their reach on either side in samples of the source."""
    edge = EDGE * min(1.0, up / down)
    reach = int(np.ceil(CROSSINGS / edge))
    at = np.arange(-reach + 1, reach + 1)[None, :] - np.arange(up)[:, None] / up
    window = np.i0(BETA * np.sqrt(np.maximum(0, 1 - (at / reach) ** 2))) / np.i0(BETA)
    taps = edge * np.sinc(edge * at) * window
    return taps / taps.sum(1, keepdims=True), reach


def resampled(blocks: DataFrame, to: int) -> DataFrame:
    """blocks at another rate, by a windowed sinc of `to / gcd` phases; ceil(total * to / rate) samples in all. The blocks keep their numbers."""

    def ratio(rate: int) -> tuple[int, int]:
        return to // gcd(to, rate), rate // gcd(to, rate)

    def kernel(samples, before, after, first, rate, total, block):
        up, down = ratio(rate)
        m = np.arange(-(-first * up // down), -(-(first + len(samples)) * up // down))
        if up == down:
            return _block(samples, first, rate, total, block)
        taps, reach = _phases(up, down)
        x = np.concatenate([np.zeros(reach - len(before)), before, samples, after, np.zeros(reach + 1 - len(after))])
        place, phase = m * down // up - first, m * down % up
        out = np.empty(len(m))
        view = np.lib.stride_tricks.sliding_window_view(x, 2 * reach)
        for a in range(0, len(m), 1 << 14):
            out[a : a + (1 << 14)] = np.einsum("ij,ij->i", view[place[a : a + (1 << 14)] + 1], taps[phase[a : a + (1 << 14)]])
        return _block(out, int(m[0]) if len(m) else -(-first * up // down), to, -(-total * up // down), block)

    reach = F.ceil(CROSSINGS / (EDGE * F.least(F.lit(1.0), F.lit(float(to)) / F.col("rate")))).cast("int")
    return _each(with_halo(blocks, reach, reach + 1), kernel, BLOCK, block=True)


def high_passed(blocks: DataFrame, hertz: float = 60.0, quality: float = 2**-0.5) -> DataFrame:
    """blocks under a second-order high-pass."""

    def kernel(samples, before, after, first, rate, total, block):
        x = np.concatenate([before, samples]).astype(np.float64)
        n = 1 << int(len(x) + FORGET / hertz * rate).bit_length()
        z = np.exp(-2j * np.pi * np.arange(n // 2 + 1) / n)
        turn = 2 * np.pi * hertz / rate
        side, c = np.sin(turn) / (2 * quality), np.cos(turn)
        response = (1 + c) / 2 * (1 - z) ** 2 / ((1 + side) - 2 * c * z + (1 - side) * z**2)
        return _block(np.fft.irfft(np.fft.rfft(x, n) * response, n)[len(before) : len(x)], first, rate, total, block)

    return _each(with_halo(blocks, F.ceil(F.col("rate") * FORGET / hertz).cast("int"), 0), kernel, BLOCK, block=True)


def _spectra(before: np.ndarray, samples: np.ndarray, after: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first samples of frames that touch the block, their spectra, window); frames begin at whole hops of the recording, also before its start."""
    begin = first - len(before)
    low, high = (first - FRAME) // HOP + 1, -(-(first + len(samples)) // HOP)
    at = np.arange(low, high) * HOP
    x = np.concatenate([np.zeros(FRAME * 2), before, samples, after, np.zeros(FRAME * 2)])
    window = np.sqrt(np.hanning(FRAME + 1)[:-1])
    return at, np.fft.rfft(np.lib.stride_tricks.sliding_window_view(x, FRAME)[at - begin + 2 * FRAME] * window, axis=1), window


def noise_profile(noise: DataFrame, strength: float = 1.5) -> DataFrame:
    """(source_id, threshold): for each band the mean level in dB of blocks of noise, and so many standard deviations more. Blocks under a frame say nothing."""

    def kernel(samples, before, after, first, rate, total):
        if len(samples) < FRAME:
            return {"band": np.zeros(0, np.int64), "n": np.zeros(0, np.int64), "s": np.zeros(0), "q": np.zeros(0)}
        frames = np.lib.stride_tricks.sliding_window_view(samples.astype(np.float64), FRAME)[::HOP] * np.sqrt(np.hanning(FRAME + 1)[:-1])
        level = 20 * np.log10(np.abs(np.fft.rfft(frames, axis=1)) + 1e-10)
        return {"band": np.arange(level.shape[1]), "n": np.full(level.shape[1], len(level)), "s": level.sum(0), "q": np.square(level).sum(0)}

    none = F.array().cast("array<float>")
    x = _each(noise.withColumns({"before": none, "after": none}), kernel, "source_id string, band long, n long, s double, q double")
    n, s, q = (F.sum(c) for c in "nsq")
    bands = x.groupBy("source_id", "band").agg((s / n + strength * F.sqrt(F.greatest(F.lit(0.0), q / n - (s / n) * (s / n)))).alias("t"))
    return bands.groupBy("source_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("band", "t"))), lambda b: b["t"]).alias("threshold"))


def denoised(blocks: DataFrame, profile: DataFrame, reduce_db: float = 20.0, steps: int = 3) -> DataFrame:
    """blocks with every band of a frame that is below the source's threshold lowered by reduce_db; the mask is smoothed over `steps` frames to either side.

    A source without a profile stays as it is. Frames overlap by three quarters under a square-root window and are added up.
    """
    floor = 10 ** (-reduce_db / 20)

    def kernel(samples, before, after, first, rate, total, block, threshold):
        if not len(threshold):
            return _block(samples, first, rate, total, block)
        wide = steps * HOP  # frames that only the smoothing needs lie in the halo too
        left, right = before[: max(0, len(before) - wide)], after[wide:]
        at, spectrum, window = _spectra(left, np.concatenate([before[len(left) :], samples, after[: len(after) - len(right)]]), right, first - (len(before) - len(left)))
        heard = (20 * np.log10(np.abs(spectrum) + 1e-10) > threshold).astype(np.float64)
        near = np.cumsum(np.vstack([np.zeros((1, heard.shape[1])), heard]), axis=0)
        k = np.arange(len(at))
        lo, hi = np.maximum(k - steps, 0), np.minimum(k + steps + 1, len(at))
        mask = floor + (1 - floor) * (near[hi] - near[lo]) / (2 * steps + 1)
        out = np.fft.irfft(spectrum * mask, FRAME, axis=1) * window
        mine = np.zeros(len(samples) + 2 * FRAME)
        for a, piece in zip((at - first + FRAME).tolist(), out, strict=True):
            if 0 <= a <= len(mine) - FRAME:
                mine[a : a + FRAME] += piece
        return _block(mine[FRAME : FRAME + len(samples)] * HOP * 2 / FRAME, first, rate, total, block)

    halo = F.lit(FRAME + (steps + 1) * HOP)
    x = with_halo(blocks, halo, halo).join(profile, "source_id", "left")
    return _each(x, kernel, BLOCK, block=True, threshold=True)


def decoded(blocks: DataFrame, rate: int | None = None, high_pass: float | None = 60.0, seconds: float | None = None) -> DataFrame:
    """What decoding gives: the head, under the high-pass, at the wanted rate."""
    x = head(blocks, seconds) if seconds else blocks
    x = high_passed(x, high_pass) if high_pass else x
    return resampled(x, rate) if rate else x
