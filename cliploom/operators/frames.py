"""Signals as tables of blocks: levels, loudness and filters that are the same at the edges of blocks as inside them.

A block is (source_id, rate, total, block, first, samples); blocks of a source are of one length, but the last, and numbered from 0. Before a kernel
runs, each block is given the edge samples of its neighbours (`with_halo`), a join on (source, block) in which only edges are copied. So no
recording is ever one value or one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from .selection import percentiles

BLOCK = "source_id string, rate int, total long, block long, first long, samples array<float>"


def with_halo(blocks: DataFrame, left: int | Column = 0, right: int | Column = 0) -> DataFrame:
    """blocks with before and after: as many samples of the neighbours on either side, fewer at the ends of a source. A block must not be shorter than that, the last but two excepted."""
    x = blocks
    at = lambda c: c if isinstance(c, Column) else F.lit(c)
    left, right = at(left), at(right)
    for name, step, edge in (("before", 1, F.slice("samples", F.greatest(F.lit(1), F.size("samples") - left + 1), left)), ("after", -1, F.slice("samples", F.lit(1), right))):
        near = blocks.select(F.col("source_id").alias("_s"), (F.col("block") + step).alias("_b"), edge.alias(name))
        x = x.join(near, (F.col("source_id") == F.col("_s")) & (F.col("block") == F.col("_b")), "left").drop("_s", "_b")
        x = x.withColumn(name, F.coalesce(name, F.array().cast("array<float>")))
    # What a short last block lacks on the right of its neighbour is not there in the recording either.
    return x


def _each(blocks: DataFrame, kernel, schema: str, block: bool = False, threshold: bool = False) -> DataFrame:
    """kernel(row) gives columns, as arrays, for a block's row, besides source_id. block, threshold: whether it is given these columns too."""
    arrays = ["samples", "before", "after", *["threshold"] * threshold]
    values = ["first", "rate", "total", *["block"] * block]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i] for c in b.schema.names}
                given = {k: np.asarray(r[k].values) if r[k].is_valid else np.zeros(0, np.float32) for k in arrays} | {k: r[k].as_py() for k in values}
                out = {k: pa.array(v) if isinstance(v, np.ndarray) else v for k, v in kernel(**given).items()}
                n = len(next(iter(out.values())))
                yield pa.RecordBatch.from_arrays([pa.array([r["source_id"].as_py()] * n, pa.string()), *out.values()], ["source_id", *out])

    return blocks.select("source_id", *values, *arrays).mapInArrow(run, schema)


def _windows(samples: np.ndarray, after: np.ndarray, first: int, total: int, size: int, hop: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """(number, mean square) of the windows of a source that begin in this block; whole: only those that end inside the source."""
    x = np.concatenate([samples, after]).astype(np.float64)
    k = np.arange(-(-first // hop), -(-(first + len(samples)) // hop))
    k = k[k * hop + size <= total] if whole else k
    if not len(k):
        return k, np.zeros(0)
    at = k * hop - first
    if int(at[-1]) + size > len(x):
        raise ValueError("blocks are shorter than a window")
    return k, np.square(np.lib.stride_tricks.sliding_window_view(x, size)[at]).mean(1)


def frame_levels(blocks: DataFrame, size: float = V.FRAME, hop: float = V.HOP) -> DataFrame:
    """(source_id, frame, level): power in dB of each whole window of `size` seconds, every `hop` seconds; for less than a window one frame of NO_LEVEL."""
    one = F.floor(F.col("rate") * size).cast("int")

    def kernel(samples, before, after, first, rate, total):
        n, h = max(1, int(rate * size)), max(1, int(rate * hop))
        if total < n and first == 0:
            return {"frame": np.zeros(1, np.int64), "level": np.full(1, V.NO_LEVEL)}
        k, power = _windows(samples, after, first, total, n, h, True)
        return {"frame": k, "level": 10 * np.log10(power + 1e-12)}

    return _each(with_halo(blocks, 0, F.greatest(F.lit(0), one - 1)), kernel, "source_id string, frame long, level double")


def signal_to_noise(levels: DataFrame) -> DataFrame:
    """(source_id, snr_db): how far the level of voice lies above that of noise, two exact percentiles of the frames; 0 for few frames."""
    at = percentiles(levels, ["source_id"], "level", (V.NOISE_POINT / 100, V.VOICE_POINT / 100))
    two = at.groupBy("source_id").agg(F.max("value").alias("_high"), F.min("value").alias("_low"), F.max("n").alias("_n"))
    return two.select("source_id", F.when(F.col("_n") >= V.LEAST_FRAMES, F.col("_high") - F.col("_low")).otherwise(0.0).alias("snr_db"))


def voiced_span(levels: DataFrame, totals: DataFrame, top_db: float = V.TRIM_BELOW, pad: float = V.TRIM_PAD_MS / 1000) -> DataFrame:
    """(source_id, begin, end) in samples of totals (source_id, rate, total): from the first to the last frame within top_db of the loudest, with a pad; all of it for few frames."""
    loudest = levels.groupBy("source_id").agg(F.max("level").alias("_top"), F.count("*").alias("_n"))
    loud = levels.join(loudest, "source_id").where(F.col("level") > F.col("_top") - top_db).groupBy("source_id").agg(F.min("frame").alias("_lo"), F.max("frame").alias("_hi"), F.max("_n").alias("_n"))
    x = totals.select("source_id", "rate", "total").join(loud, "source_id", "left")
    hop, size, wide = (F.floor(F.col("rate") * s).cast("long") for s in (V.HOP, V.FRAME, pad))
    few = F.coalesce(F.col("_n") < V.TRIM_LEAST_FRAMES, F.lit(True))
    begin, end = F.greatest(F.lit(0), F.col("_lo") * hop - wide), F.least(F.col("total"), F.col("_hi") * hop + size + wide)
    return x.select("source_id", F.when(few, 0).otherwise(begin).cast("long").alias("begin"), F.when(few, F.col("total")).otherwise(end).alias("end"))


def cut(blocks: DataFrame, spans: DataFrame) -> DataFrame:
    """(source_id, span, block, at, samples): the samples of spans (source_id, span, begin, end), a row for each block that a span touches; at: place in the span."""
    x = blocks.join(spans, "source_id").where((F.col("first") < F.col("end")) & (F.col("first") + F.size("samples") > F.col("begin")))
    lo, hi = F.greatest(F.col("begin") - F.col("first"), F.lit(0)), F.least(F.col("end") - F.col("first"), F.size("samples").cast("long"))
    return x.select("source_id", "span", "block", F.greatest(F.col("first") - F.col("begin"), F.lit(0)).alias("at"), F.slice("samples", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("samples"))


# The two stages of K-weighting (centre in Hz, gain in dB, quality), the gate in seconds, its step, and the thresholds in LUFS and LU.
SHELF, HIGH_PASS = (1681.974450955533, 3.999843853973347, 0.7071752369554196), (38.13547087602444, 0.5003270373238773)
GATE_STEP, GATE_STEPS, OFFSET, ABSOLUTE, RELATIVE = 0.1, 4, -0.691, -70.0, -10.0
#: Seconds that the filter needs to forget what came before; its slowest part falls to 1e-20 in that time.
MEMORY = 0.2


def k_weights(rate: int, n: int) -> np.ndarray:
    """Response of both stages at the frequencies of a real transform of n samples."""
    z = np.exp(-2j * np.pi * np.arange(n // 2 + 1) / n)
    centre, gain, q = SHELF
    k, high = np.tan(np.pi * centre / rate), 10 ** (gain / 20)
    band = high**0.4996667741545416
    shelf = ((high + band * k / q + k * k) + 2 * (k * k - high) * z + (high - band * k / q + k * k) * z**2) / ((1 + k / q + k * k) + 2 * (k * k - 1) * z + (1 - k / q + k * k) * z**2)
    centre, q = HIGH_PASS
    k = np.tan(np.pi * centre / rate)
    return shelf * (1 - z) ** 2 / (1 + 2 * (k * k - 1) / (1 + k / q + k * k) * z + (1 - k / q + k * k) / (1 + k / q + k * k) * z**2)


def loudness(blocks: DataFrame) -> DataFrame:
    """(source_id, lufs): integrated loudness. Power of steps of 100 ms after K-weighting, gates of four steps, those over -70 LUFS, then those over 10 LU below
    what these have together. Null where no gate is left, as for less than a gate."""

    def kernel(samples, before, after, first, rate, total):
        x = np.concatenate([before, samples, after]).astype(np.float64)
        n = 1 << int(len(x) + MEMORY * rate).bit_length()
        y = np.fft.irfft(np.fft.rfft(x, n) * k_weights(rate, n), n)[: len(x)]
        step = round(GATE_STEP * rate)
        k, power = _windows(y[len(before) : len(before) + len(samples)], y[len(before) + len(samples) :], first, total, step, step, True)
        return {"step": k, "power": power}

    memory, step = F.ceil(F.col("rate") * MEMORY).cast("int"), F.floor(F.col("rate") * GATE_STEP + 0.5).cast("int")
    steps = _each(with_halo(blocks, memory, step), kernel, "source_id string, step long, power double")
    # A gate is a step and the three that follow: each step is sent to the gates that it is in.
    gates = steps.select("source_id", F.explode(F.sequence(F.col("step") - (GATE_STEPS - 1), F.col("step"))).alias("gate"), "power").groupBy("source_id", "gate").agg(F.count("*").alias("_n"), F.avg("power").alias("power")).where(F.col("_n") == GATE_STEPS)
    lufs = lambda c: OFFSET + 10 * F.log10(c)
    heard = gates.where(lufs(F.col("power")) > ABSOLUTE)
    floor = heard.groupBy("source_id").agg((lufs(F.avg("power")) + RELATIVE).alias("_floor"))
    kept = heard.join(floor, "source_id").where(lufs(F.col("power")) > F.col("_floor")).groupBy("source_id").agg(lufs(F.avg("power")).alias("lufs"))
    return blocks.select("source_id").distinct().join(kept, "source_id", "left")


def gains(blocks: DataFrame, lufs: float = -23.0, peak_db: float = -1.5, least: float = 0.5) -> DataFrame:
    """(source_id, gain) to a loudness, held below a peak; under half a second, or where there is no loudness, only the peak holds."""
    top = blocks.groupBy("source_id").agg(F.max(F.coalesce(F.array_max(F.transform("samples", lambda v: F.abs(v))), F.lit(0.0))).cast("double").alias("_top"), F.max(F.col("total") / F.col("rate")).alias("_s"))
    x = top.join(loudness(blocks), "source_id")
    wanted = F.when((F.col("_s") >= least) & F.col("lufs").isNotNull(), F.pow(F.lit(10.0), (lufs - F.col("lufs")) / 20)).otherwise(1.0)
    return x.select("source_id", F.when(F.col("_top") * wanted > 10 ** (peak_db / 20), 10 ** (peak_db / 20) / F.col("_top")).otherwise(wanted).alias("gain"))


def amplified(blocks: DataFrame, by: DataFrame) -> DataFrame:
    """blocks times the gain of their source; the gains, a row a source, are joined as the planner sees fit."""
    x = blocks.join(by, "source_id")
    return x.withColumn("samples", F.transform("samples", lambda v: (v * F.col("gain")).cast("float"))).select(*blocks.columns)


