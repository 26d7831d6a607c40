"""The parity-sketch join against all pairs."""

import random
import re

import numpy as np
import pytest

from cliploom.llm import parity_join as J

from .conftest import by_text, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(FOLD))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][0], rows[j][0]
            n = len(sets[i] & sets[j])
            if n and a is not None and b is not None and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(d, len(s), None if d is None else find(d)) for (d, _), s in zip(rows, sets)]


@pytest.fixture
def near(rng):
    words = [f"w{i}" for i in range(50)]
    rows = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 9, 20, 60, 200]))]
        for _ in range(rng.choice([1, 2, 3, 40])):
            p = rng.choice([0, 0.01, 0.03])
            w = [rng.choice(words) + "Q" if rng.random() < p else x for x in base][: len(base) - rng.randrange(1 + len(base) // 9)]
            rows.append((len(rows) * 7919 % 5003, " ".join(w).upper() if rng.random() < 0.3 else "\n".join(w)))
    return [*rows, (None, "a b c d e"), (6000, None), (6001, ""), (6002, "A b"), (6003, "a b"), rows[3], (rows[3][0], rows[9][1])]


@pytest.mark.parametrize("options", [{}, {"percent": 60, "n_batches": 2, "n_buckets": 1}])
def test_components(spark, near, options):
    got = J.link_components(frame(spark, near), **options).select("doc_id", "n_shingles", "component_id").collect()
    assert by_text(got) == by_text(brute(near, 4, options.get("percent", 85)))


@pytest.mark.parametrize("in_batch, split", [(1, 2), (2, 10**9), (100, 4)])
def test_frequent_words_lose_no_link(spark, near, monkeypatch, in_batch, split):
    monkeypatch.setattr(J, "FREQUENT", 2)
    monkeypatch.setattr(J, "MOST_IN_BATCH", in_batch)
    monkeypatch.setattr(J, "BLOCK", 3)
    monkeypatch.setattr(J, "SPLIT", split)
    monkeypatch.setattr(J, "MOST_SHINGLES", 50)
    got = J.link_components(frame(spark, near)).select("doc_id", "n_shingles", "component_id").collect()
    assert by_text(got) == by_text(brute(near, 4, 85))


@pytest.mark.parametrize("percent", [20, 45, 60, 85])
def test_sizes_far_apart(spark, percent):
    """Pairs of a set and the least part of it that is similar enough, and the part that just isn't."""
    rows = []
    for n in (5, 21, 35, 56, 89, 100, 130):
        for m in (-(-n * percent // 100), -(-n * percent // 100) - 1):
            w = [f"{n}x{m}y{i}" for i in range(n + 3)]
            rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(w[: m + 3] if m else []))]
    got = J.link_components(frame(spark, rows), percent=percent).select("doc_id", "n_shingles", "component_id").collect()
    assert by_text(got) == by_text(brute(rows, 4, percent))


@pytest.mark.parametrize("percent", [10, 33, 50, 60, 62, 80, 85])
def test_similar_sizes_share_a_band(percent):
    bands = J.Bands(percent)
    of = [{b for b, *_ in bands.of(n)} for n in range(1, 400)]
    for n in range(1, 400):
        assert all(of[n - 1] & of[m - 1] for m in range(-(-n * percent // 100), n) if bands._at(int(np.searchsorted(bands.low, m, "right")) - 1)[1])


def test_one_of_each(spark, near):
    df = frame(spark, near)
    kept = J.one_of_each(df, k=4, percent=85)
    assert kept.columns == df.columns
    want = sorted(repr(d) for d, _, c in brute(near, 4, 85) if d is None or d == c)
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == want


def test_empty(spark):
    assert J.link_components(frame(spark, [])).count() == 0


def test_sketches_bound_the_difference():
    r = random.Random(1)
    bands = J.Bands(85)
    for _ in range(300):
        a = {r.getrandbits(64) for _ in range(r.randrange(1, 200))}
        b = set(r.sample(sorted(a), max(1, int(len(a) * r.uniform(0.8, 1))))) | {r.getrandbits(64) for _ in range(r.randrange(0, 1 + len(a) // 8))}
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        bits = np.unpackbits(np.frombuffer(J.bit_sketch(x), np.uint8) ^ np.frombuffer(J.bit_sketch(y), np.uint8)).sum()
        assert bits <= len(a ^ b)
        if 100 * len(a & b) >= 85 * len(a | b) and a != b:
            words = [set(zip(w.tolist(), [c] * len(w))) for s in (x, y) for w, c, _ in [*J.sketch_words(s, bands)]]
            mine = [set().union(*[set(w.tolist()) for w, _, _ in J.sketch_words(s, bands)]) for s in (x, y)]
            assert words and mine[0] & mine[1]


def test_prefixes_meet():
    r = np.random.default_rng(4)
    for percent in (60, 85):
        for _ in range(400):
            a = np.unique(r.integers(0, 400, r.integers(1, 120)).astype(np.uint64))
            b = np.unique(np.r_[a[r.random(len(a)) < r.uniform(0.7, 1)], r.integers(0, 400, r.integers(0, 9)).astype(np.uint64)])
            frequent = r.permutation(np.arange(r.integers(0, 300))).astype(np.uint64)
            common = len(np.intersect1d(a, b))
            if 100 * common >= percent * (len(a) + len(b) - common):
                assert len(np.intersect1d(*[J.prefix_of(x, len(x), percent, frequent) for x in (a, b)]))


def test_many_near_copies(spark):
    """20,000 near copies of one text are one component, and what reaches the fullest bucket does not follow their number."""
    r = random.Random(7)
    words = [f"w{i}" for i in range(120)]
    most = []
    for n in (4000, 20000):
        rows = [(i, " ".join(words[:59] + [f"own{i}"] + words[60:])) for i in range(n)]
        rows += [(n + i, " ".join(r.choice("abcdefgh") + str(r.randrange(10**6)) for _ in range(40))) for i in range(50)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        b = J.batches(df, "doc_id", "text", 8)
        bands, sketches, sets = J.Bands(85), J.Sketches, J.shingle_sets
        sent = J.ask(b, lambda x, _: sketches(x, sets(x, 4), x.ids, bands, n // 100).messages())
        most.append(sent.selectExpr("bucket", "length(message) as n").groupBy("bucket").sum("n").agg({"sum(n)": "max"}).collect()[0][0])
    assert most[1] < 2 * most[0]
    got = J.link_components(df).where("doc_id < 20000").groupBy("component_id").count().collect()
    assert [tuple(x) for x in got] == [(0, 20000)]


def test_nothing_is_left_behind(spark, near):
    from cliploom.llm import frames

    before = len(frames._made)
    J.link_components(frame(spark, near)).count()
    assert len(frames._made) == before + 1
