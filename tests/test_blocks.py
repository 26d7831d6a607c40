"""Recordings by byte range, files under a commit, and signals as tables of blocks."""

import wave

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import GreaterThan, LessThan

from cliploom.functions import signal
from cliploom.operators import alignment, filters, frames
from cliploom.sources import wav_blocks


def sine(seconds, rate, hertz=997.0, level=0.0):
    return (10 ** (level / 20) * np.sin(2 * np.pi * hertz * np.arange(int(seconds * rate)) / rate)).astype(np.float32)


def table(spark, waves, rate, length):
    rows = [(k, rate, len(x), b, b * length, [float(v) for v in x[b * length : (b + 1) * length]]) for k, x in waves.items() for b in range(-(-len(x) // length))]
    return spark.createDataFrame(rows, frames.BLOCK)


def test_slices_equal_the_whole_file(spark, tmp_path):
    r, whole = np.random.default_rng(1), {}
    for width, channels, n in ((1, 1, 1000), (2, 2, 2505), (3, 1, 999), (4, 3, 2000), (2, 1, 0)):
        name = str(tmp_path / f"w{width}c{channels}n{n}.wav")
        with wave.open(name, "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(width)
            w.setframerate(100)
            w.writeframes(r.integers(0, 256, n * channels * width, np.uint8).tobytes())
        whole[name] = signal.read_wav(open(name, "rb").read())[0]
    (tmp_path / "cut.wav").write_bytes((tmp_path / "w2c2n2505.wav").read_bytes()[: 44 + 4 * 1234 + 3])
    whole[str(tmp_path / "cut.wav")] = whole[str(tmp_path / "w2c2n2505.wav")][:1234]
    got = wav_blocks.blocks(spark, str(tmp_path), seconds=3.0, split_bytes=2000).orderBy("path", "block").collect()
    for name, x in whole.items():
        mine = [b for b in got if b["path"] == name]
        assert [(b["first"], b["total"]) for b in mine] == [(f, len(x)) for f in range(0, len(x), 300)]
        assert np.array_equal(np.concatenate([*[np.array(b["samples"], np.float32) for b in mine], np.zeros(0, np.float32)]), x)
    some = wav_blocks.blocks(spark, str(tmp_path), seconds=3.0).where((F.col("start") < 7) & (F.col("end") > 4) & F.col("path").isin(list(whole)[:2])).collect()
    assert sorted((b["path"], b["block"]) for b in some) == sorted((p, b) for p in list(whole)[:2] for b in (1, 2))
    with pytest.raises(Exception, match="not a WAV"):
        (tmp_path / "bad.wav").write_bytes(b"no recording")
        wav_blocks.blocks(spark, str(tmp_path)).count()


def test_ten_hours_are_many_tasks_and_a_slice_reads_its_bytes(tmp_path):
    path, rate, seconds = tmp_path / "long.wav", 16_000, 36_000
    head = signal.write_wav(np.zeros(0), rate)
    with open(path, "wb") as f:  # a file with holes
        f.write(head[:40] + (2 * rate * seconds).to_bytes(4, "little"))
        f.truncate(44 + 2 * rate * seconds)
    options = {"path": str(path), "blockSeconds": "10"}
    whole = wav_blocks.WavReader(options).partitions()
    assert len(whole) >= 17 and sum(p.n_bytes for p in whole) == 2 * rate * seconds and max(p.n_bytes for p in whole) <= 64 << 20
    reader = wav_blocks.WavReader(options)
    assert len(list(reader.pushFilters([GreaterThan(("end",), 20_000.0), LessThan(("start",), 20_025.0)]))) == 2
    some = reader.partitions()
    assert sum(p.n_bytes for p in some) <= 2 * rate * 50
    assert sum(len(b.column(7)[0]) for p in some for b in reader.read(p)) * 2 == sum(p.n_bytes for p in some)


def test_files_are_there_once(spark, tmp_path):
    files = spark.createDataFrame([(f"f{k}.bin", bytes([k])) for k in range(20)], "name string, content binary").repartition(4)
    wav_blocks.save_files(files, str(tmp_path / "out"))
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()} == {f"f{k}.bin": bytes([k]) for k in range(20)}
    with pytest.raises(Exception, match="there twice"):
        wav_blocks.save_files(files.limit(1), str(tmp_path / "out"))
    wav_blocks.save_files(files.limit(1), str(tmp_path / "out"), mode="overwrite")
    with pytest.raises(Exception, match="there twice"):
        wav_blocks.save_files(files.unionByName(files), str(tmp_path / "twice"))
    assert list((tmp_path / "twice").iterdir()) == []
    # A task that runs twice: the folder of the try that is not committed goes, its files do not count.
    writer = wav_blocks.FileWriter({"path": str(tmp_path / "again")}, False)
    rows = [{"name": "a", "content": b"1"}]
    writer.write(iter(rows))
    done = writer.write(iter(rows))
    writer.commit([done, None])
    assert [p.name for p in (tmp_path / "again").iterdir()] == ["a"]


def test_levels_at_edges_of_blocks(spark):
    r = np.random.default_rng(2)
    waves = {"a": r.normal(0, 0.1, 5003).astype(np.float32), "b": sine(1.0, 1000), "short": np.ones(7, np.float32), "edge": r.normal(0, 1, 130).astype(np.float32)}
    for length in (64, 65, 1000):
        got = frames.frame_levels(table(spark, waves, 1000, length)).collect()
        for k, x in waves.items():
            mine = [g["level"] for g in sorted(got, key=lambda g: g["frame"]) if g["source_id"] == k]
            assert np.allclose(mine, signal.frame_rms(x, 1000), atol=1e-4)
    levels = frames.frame_levels(table(spark, waves, 1000, 64))
    assert all(abs(g["snr_db"] - signal.snr(waves[g["source_id"]], 1000)) < 1e-4 for g in frames.signal_to_noise(levels).collect())
    waves["quiet"] = np.concatenate([np.zeros(700), sine(1.0, 1000, 50.0), np.zeros(900)]).astype(np.float32)
    b = table(spark, waves, 1000, 64)
    spans = frames.voiced_span(frames.frame_levels(b), b.select("source_id", "rate", "total").distinct()).withColumn("span", F.lit(0))
    for k, x in waves.items():
        parts = sorted((g["at"], g["samples"]) for g in frames.cut(b, spans).where(F.col("source_id") == k).collect())
        assert np.array_equal(np.concatenate([p for _, p in parts]).astype(np.float32), signal.trim(x, 1000))
    with pytest.raises(Exception, match="shorter than a window"):
        frames.frame_levels(table(spark, waves, 1000, 8)).collect()


def test_loudness_of_known_tones(spark):
    """A full-scale sine of 997 Hz is -3.01 LUFS on one channel; quiet stretches are gated; levels add."""
    rate = 48_000
    tone = sine(3.0, rate)
    waves = {"full": tone, "low": sine(3.0, rate, level=-20.0), "gated": np.concatenate([tone, np.zeros(3 * rate, np.float32)]), "loud_and_low": np.concatenate([tone, sine(3.0, rate, level=-30.0)]), "silent": np.zeros(rate, np.float32), "short": tone[: rate // 4]}
    b = table(spark, waves, rate, rate).cache()
    got = {r["source_id"]: r["lufs"] for r in frames.loudness(b).collect()}
    assert abs(got["full"] + 3.01) < 0.05 and abs(got["low"] + 23.01) < 0.05 and got["silent"] is None and got["short"] is None
    assert abs(got["gated"] - got["full"]) < 0.3 and abs(got["loud_and_low"] - got["full"]) < 0.3
    gain = {r["source_id"]: r["gain"] for r in frames.gains(b, lufs=-23.0).collect()}
    assert abs(gain["low"] - 1) < 0.01 and abs(gain["full"] - 10 ** (-20 / 20)) < 0.01 and gain["silent"] == 1.0
    assert abs(gain["short"] - 10 ** (-1.5 / 20)) < 1e-3  # the peak alone
    again = {r["source_id"]: r["lufs"] for r in frames.loudness(frames.amplified(b, frames.gains(b))).collect()}
    assert abs(again["full"] + 23) < 0.05 and abs(again["low"] + 23) < 0.05
    halves = {r["source_id"]: r["lufs"] for r in frames.loudness(table(spark, waves, rate, rate // 3 + 7)).collect()}
    assert all(abs(halves[k] - v) < 1e-6 for k, v in got.items() if v is not None)


def waves_of(df):
    out = {}
    for r in df.orderBy("source_id", "block").collect():
        assert len(out.setdefault(r["source_id"], [])) == r["first"]
        out[r["source_id"]] += r["samples"]
    return {k: np.array(v) for k, v in out.items()}


def level(x):
    return 10 * np.log10(np.mean(np.square(x)) + 1e-20)


def test_another_rate(spark):
    rate = 44_100
    waves = {"low": sine(1.0, rate, 1000.0), "high": sine(1.0, rate, 9000.0), "same": sine(0.01, rate, 500.0)}
    got = waves_of(filters.resampled(table(spark, waves, rate, 10_000), 16_000))
    cut = waves_of(filters.resampled(table(spark, waves, rate, 4_321), 16_000))
    assert all(len(got[k]) == -(-len(x) * 160 // 441) and np.allclose(got[k], cut[k], atol=1e-6) for k, x in waves.items())
    middle = slice(1000, -1000)
    assert level(got["high"][middle]) < -80  # would be an alias at 7 kHz
    assert level(got["low"][middle] - sine(1.0, 16_000, 1000.0)[middle]) < -80
    up = waves_of(filters.resampled(table(spark, {"a": sine(0.5, 8_000, 1000.0)}, 8_000, 999), 22_050))["a"]
    assert len(up) == -(-4000 * 22_050 // 8_000) and level(up[middle] - sine(0.5, 22_050, 1000.0)[middle]) < -80
    assert np.array_equal(waves_of(filters.resampled(table(spark, {"a": waves["low"]}, rate, 10_000), rate))["a"].astype(np.float32), waves["low"])


def test_high_pass_and_head(spark):
    rate = 8_000
    waves = {"hum": sine(1.0, rate, 10.0), "voice": sine(1.0, rate, 1000.0)}
    got = waves_of(filters.high_passed(table(spark, waves, rate, 3_000), 60.0))
    turn = 2 * np.pi * 60 / rate
    side, c = np.sin(turn) * 2**-0.5, np.cos(turn)
    for k, x in waves.items():
        y = np.zeros(len(x) + 2)
        z = np.concatenate([[0, 0], x])
        for i in range(2, len(z)):
            y[i] = ((1 + c) / 2 * (z[i] - 2 * z[i - 1] + z[i - 2]) + 2 * c * y[i - 1] - (1 - side) * y[i - 2]) / (1 + side)
        assert np.allclose(got[k], y[2:], atol=1e-6)
    some = waves_of(filters.decoded(table(spark, waves, rate, 3_000), rate=4_000, seconds=0.5))
    assert {k: len(v) for k, v in some.items()} == {"hum": 2_000, "voice": 2_000}


def test_less_noise(spark):
    r, rate = np.random.default_rng(5), 16_000
    noise = r.normal(0, 0.01, 4 * rate).astype(np.float32)
    tone = np.concatenate([np.zeros(2 * rate), 0.3 * sine(2.0, rate, 1000.0)]).astype(np.float32)
    b = table(spark, {"a": noise + tone, "none": noise}, rate, rate)
    profile = filters.noise_profile(b.where("source_id = 'a' and block < 2"))
    got = waves_of(filters.denoised(b, profile))
    quiet, loud = slice(rate // 2, 3 * rate // 2), slice(5 * rate // 2, 7 * rate // 2)
    assert level(got["a"][quiet]) < level(noise[quiet]) - 10
    assert abs(level(got["a"][loud]) - level(tone[loud])) < 0.3 and level(got["a"][loud] - tone[loud]) < level(noise[loud]) - 6
    assert np.allclose(got["none"], noise, atol=1e-7)
    other = waves_of(filters.denoised(table(spark, {"a": noise + tone}, rate, 7_777), profile))
    assert np.allclose(other["a"], got["a"], atol=1e-5)
    clear = waves_of(filters.denoised(b, profile.withColumn("threshold", F.transform("threshold", lambda t: t - 1000)), steps=0))
    assert np.allclose(clear["a"], noise + tone, atol=1e-5)  # all bands are heard: the frames add up to what was there


def test_alignment_by_chunk(spark):
    """Scores at random against a plain dynamic programme of each chunk, margins and all; chunks without room or frames fall back."""
    import random

    r, vocab = random.Random(3), {c: k for k, c in enumerate("_|abc")}
    bounds = [0.0, 3.0, 6.5, 9.0, 12.0]
    words = [(1, k, s := r.randrange(0, 1300) / 100, s + 0.2, "".join(r.choice("abcx") for _ in range(r.choice([1, 2, 2, 3])))) for k in range(20)]
    words += [(1, 100 + k, 9.5 + k / 1000, 9.6 + k / 1000, "abcabc") for k in range(40)]  # more letters than the chunk has frames
    words += [(1, 500, 13.0, 13.2, "a"), (2, 1, 0.1, 0.2, "ab")]
    frames_ = [(1, k * 0.05, [r.gauss(0, 2) for _ in vocab]) for k in range(240)]
    w = spark.createDataFrame(words, "source_id long, ord long, s double, e double, text string")
    f = spark.createDataFrame(frames_, "source_id long, t double, scores array<double>")
    b = spark.createDataFrame([(k, n, x) for k in (1, 2) for n, x in enumerate(bounds)], "source_id long, n long, bound double")
    got = {(x["source_id"], x["ord"]): x for x in alignment.aligned_words(w, f, b, vocab, 0.05, margin=0.5).collect()}
    assert len(got) == len(words)
    failed = 0
    for n, (left, right) in enumerate(zip(bounds, bounds[1:], strict=False)):
        mine = sorted(x for x in words if x[0] == 1 and left <= (x[2] + x[3]) / 2 < right)
        mine.sort(key=lambda x: x[1])
        heard = [(t, s) for _, t, s in frames_ if left - 0.5 <= t < right + 0.5]
        tokens, owners = alignment.targets([x[4] for x in mine], vocab, "|")
        p = np.array([s for _, s in heard])
        p = p - np.log(np.exp(p).sum(1, keepdims=True))
        labels = [0] + [y for t in tokens for y in (t, 0)]
        best = {(0, 0): (p[0, 0], None)} | ({(0, 1): (p[0, labels[1]], None)} if tokens else {})
        for t in range(1, len(heard)):
            for j in range(len(labels)):
                before = [i for i in (j, j - 1, *([j - 2] if j % 2 and j > 1 and labels[j] != labels[j - 2] else [])) if (t - 1, i) in best]
                if before:
                    i = max(before, key=lambda i: best[t - 1, i][0])
                    best[t, j] = best[t - 1, i][0] + p[t, labels[j]], i
        ends = [j for j in (len(labels) - 1, len(labels) - 2) if (len(heard) - 1, j) in best]
        if not ends or not tokens:
            failed += bool(mine)
            assert all(got[1, x[1]]["failed"] and not got[1, x[1]]["realigned"] and got[1, x[1]]["s"] == x[2] and got[1, x[1]]["ctc_score"] is None for x in mine)
            continue
        j, path = max(ends, key=lambda j: best[len(heard) - 1, j][0]), []
        for t in range(len(heard) - 1, -1, -1):
            path.append(j)
            j = best[t, j][1]
        path.reverse()
        for k, x in enumerate(mine):
            own = [t for t, j in enumerate(path) if j % 2 and owners[j // 2] == k]
            y = got[1, x[1]]
            assert y["realigned"] == bool(own) and y["chunk"] == n
            if own:
                assert (y["s"], y["e"]) == (round(heard[own[0]][0], 3), round(heard[own[-1]][0] + 0.05, 3))
    assert failed == 1 and not got[1, 500]["realigned"] and got[1, 500]["chunk"] is None and got[2, 1]["failed"]
    count = {x["source_id"]: (x["chunks"], x["failed_chunks"], x["words"]) for x in alignment.counters(alignment.aligned_words(w, f, b, vocab, 0.05, margin=0.5), b).collect()}
    assert count == {1: (4, 1, 61), 2: (4, 1, 1)}


def test_frames_are_not_sent_to_all(spark):
    """Frames come of an explode, which the planner takes for small; neither they nor words may be broadcast."""
    turns = spark.range(3).select(F.col("id").alias("source_id"), F.posexplode(F.array_repeat(F.lit(0.5), 900)).alias("k", "x"))
    f = turns.select("source_id", (F.col("k") * 0.02).alias("t"), F.array_repeat("x", 28).alias("scores"))
    b = spark.createDataFrame([(k, n, 6.0 * n) for k in range(3) for n in range(4)], "source_id long, n long, bound double")
    x = alignment._inside(f, F.col("t"), alignment.chunks_of(b), 2.5, 60.0)
    assert x.count() == 3 * (900 + 2 * 250)
    assert "ShuffledHashJoin" in (plan := x._jdf.queryExecution().executedPlan().toString()) and "BuildLeft" not in plan


def _nodes(plan):
    """The nodes of a plan that has run, those of adaptive stages included."""
    yield plan
    name = plan.getClass().getSimpleName()
    below = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else [plan.children().apply(k) for k in range(plan.children().size())]
    for x in below:
        yield from _nodes(x)


def test_frames_travel_packed(spark):
    """Frames at random times, shuffled over partitions, with margins: what chunks hear is each of them once, bit by bit, and few bytes are dealt for many quiet classes."""
    r = np.random.default_rng(6)
    rows = [(k, float(t), r.normal(0, 3, 5).tolist()) for k in (1, 2) for t in np.r_[r.uniform(-70, 130, 300), 3.0, 3.0, 59.999999999999, 60.0]]
    for kind, convert in (("double", float), ("float", lambda v: float(np.float32(v)))):
        f = spark.createDataFrame([*rows, (1, float("nan"), [0.0] * 5), (1, float("inf"), [0.0] * 5), (None, 1.0, [0.0] * 5), (1, None, [0.0] * 5)], f"source_id int, t double, scores array<{kind}>")
        blocks = alignment.packed(f.repartition(3), 60.0).where("source_id = 1").toArrow()
        assert all(np.floor(a / 60.0) == np.floor(z / 60.0) == b and z - a < 60.0 / alignment.PIECES for a, z, b in zip(*(blocks.column(c).to_pylist() for c in ("first", "last", "bucket")), strict=True))
        t, x = alignment.unpacked(blocks, -20.0, 60.0, "f4" if kind == "float" else "f8")
        assert sorted(zip(t.tolist(), x.tolist(), strict=True)) == sorted((t, [convert(v) for v in s]) for k, t, s in rows if k == 1 and -20 <= t < 60) and (np.diff(t) >= 0).all()
    vocab, n = {c: k for k, c in enumerate("_|abcdefghijklmnopqrstuvwxyz")}, 30_000
    f = spark.range(n).select((F.col("id") % 3).alias("source_id"), (F.floor(F.col("id") / 3) * 0.02).alias("t"), F.transform(F.sequence(F.lit(0), F.lit(27)), lambda c: F.when(c == F.col("id") % 7, 9.0).otherwise(0.0).cast("float")).alias("scores"))
    b = spark.createDataFrame([(k, m, 20.0 * m) for k in range(3) for m in range(11)], "source_id long, n long, bound double")
    w = spark.createDataFrame([(k, m, 2.0 * m, 2.0 * m + 0.5, "ab", [m]) for k in range(3) for m in range(110)], "source_id int, ord int, s double, e double, text string, more array<int>")
    x = alignment.aligned_words(w, f, b, vocab, 0.02)
    got = x.collect()
    assert sorted((y["source_id"], y["ord"], y["more"]) for y in got) == [(k, m, [m]) for k in range(3) for m in range(110)]
    assert all((y["chunk"], y["realigned"], y["failed"]) == ((y["ord"] // 10, True, False) if y["ord"] < 100 else (None, False, False)) for y in got)
    dealt = sum(y.metrics().apply("dataSize").value() for y in _nodes(x._jdf.queryExecution().executedPlan()) if y.getClass().getSimpleName() == "ShuffleExchangeExec")
    assert 0 < dealt < 40 * n


def test_counters_align_once(spark):
    w = spark.createDataFrame([(1, 1, 0.0, 1.0, "a")], "source_id long, ord long, s double, e double, text string")
    f = spark.createDataFrame([(1, 0.5, [0.0, 0.0, 1.0])], "source_id long, t double, scores array<float>")
    b = spark.createDataFrame([(k, n, x) for k in (1, 2) for n, x in enumerate((0.0, 3.0, 6.0))], "source_id long, n long, bound double")
    x = alignment.counters(alignment.aligned_words(w, f, b, {"_": 0, "|": 1, "a": 2}, 0.02), b)
    assert sorted(map(tuple, x.collect())) == [(1, 2, 0, 1, 1), (2, 2, 0, 0, 0)]
    assert x._jdf.queryExecution().optimizedPlan().toString().count("FlatMapCoGroupsInArrow") == 1


def test_long_paths_in_little_memory():
    """The best path from held rows of scores is that of all steps at once."""
    from cliploom.operators import ctc

    r = np.random.default_rng(4)
    logp = np.log(r.dirichlet(np.ones(5), 300))
    tokens = r.integers(1, 5, 60)
    whole, parts = ctc.viterbi(logp, tokens), ctc.viterbi(logp, tokens, cells=1)
    assert np.array_equal(whole, parts) and len(whole) == 60
    heard = logp.argmax(1)
    plain = heard[np.flatnonzero((heard > 0) & np.r_[True, heard[1:] != heard[:-1]])]
    spans = ctc.viterbi(logp, plain)
    assert spans[:, 2] == pytest.approx([np.exp(logp[int(a) : int(b)].max(1)).mean() for a, b, _ in spans])
