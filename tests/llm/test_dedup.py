"""Suffix-array and substring deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from cliploom.llm import suffix_dedup
from cliploom.llm.cover_dedup import difference_cover, remove_repeats
from cliploom.llm.rounds import answer, ask, batches
from cliploom.llm.suffix_dedup import deduplicate, strip_repeats

from .conftest import by_text, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def brute_gone(rows, length):
    """For each row its bytes, and which of them go."""
    key = lambda d: -(10**30) if d is None else d
    raw = [(d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, t in raw:
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            first[s] = min(first.get(s, key(d)), key(d))
    for d, t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < key(d):
                gone[i : i + length] = b"\1" * length
        yield d, t, gone


def brute_bytes(rows, length):
    out = []
    for d, t, gone in brute_gone(rows, length):
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, sha(bytes(c for c, g in zip(t, gone) if not g))))
    return out


def brute_text(rows, length):
    """What is left of each text; a character of which a byte goes, goes."""
    for d, t, gone in brute_gone(rows, length):
        out, at = "", 0
        for c in t.decode():
            n = len(c.encode())
            out += "" if any(gone[at : at + n]) else c
            at += n
        yield d, out


@pytest.mark.parametrize("options", [{"length": 50}, {"length": 50, "n_batches": 1, "n_buckets": 1}, {"length": 9}])
def test_suffix(spark, rows, options):
    got = deduplicate(frame(spark, rows), digest=True, **options).collect()
    assert by_text(got) == by_text(brute_bytes(rows, options["length"]))


@pytest.mark.parametrize("length", [256, 300, 700])
def test_suffix_of_long_strings(spark, rng, length):
    """Phrases of more than 255 starts, several of one trigger."""
    base = ["".join(rng.choice("abcdefgh ") for _ in range(9000)) for _ in range(2)]
    rows = []
    for i in range(24):
        b, a = rng.choice(base), rng.randrange(6000)
        rows.append((i * 7 % 24, "".join(rng.choice("xyz") for _ in range(rng.randrange(40))) + b[a : a + rng.randrange(length, 3000)] + rng.choice("xyz")))
    got = deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), length=length, digest=True).collect()
    assert by_text(got) == by_text(brute_bytes(rows, length))


def test_suffix_keeps_columns(spark, rows):
    df = frame(spark, rows)
    out = strip_repeats(df, length=50)
    assert out.columns == df.columns
    got = sorted((repr(r["doc_id"]), len(r["text"].encode())) for r in out.collect())
    raw = deduplicate(df, length=50).collect()
    want = sorted((repr(r["doc_id"]), len(bytes(r["kept"]).decode(errors="ignore").encode())) for r in raw)
    assert got == want


def brute_words(rows, window):
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    seen = Counter(tuple(w[i : i + window]) for _, w in words for i in range(len(w) - window + 1))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return out


@pytest.mark.parametrize("options", [{"window": 35}, {"window": 35, "n_batches": 1, "n_buckets": 1}, {"window": 6, "period": 3}, {"window": 2}])
def test_cover(spark, rows, options):
    got = remove_repeats(frame(spark, rows), digest=True, **options).collect()
    assert by_text(got) == by_text(brute_words(rows, options["window"]))


@pytest.mark.parametrize("period", [2, 3, 7, 13, 21, 31])
def test_cover_has_all_differences(period):
    c = difference_cover(period)
    assert {(a - b) % period for a in c for b in c} == set(range(period))
    assert len(c) <= 2 * period**0.5 + 1


def test_empty_tables(spark):
    df = frame(spark, [])
    assert deduplicate(df).count() == remove_repeats(df).count() == 0


@pytest.mark.parametrize("limits", [(0, 64, 1024), (4, 1, 1024), (4, 64, 1), (2, 3, 9)])
def test_hot_triggers(spark, rows, monkeypatch, limits):
    for name, x in zip(("MOST_IN_BATCH", "MOST_KINDS", "MOST_ENTRIES"), limits, strict=True):
        monkeypatch.setattr(suffix_dedup, name, x)
    got = deduplicate(frame(spark, rows), digest=True, n_batches=3, n_buckets=5).collect()
    assert by_text(got) == by_text(brute_bytes(rows, 50))


def test_corpus_order(rng):
    """Starts of phrases of two triggers are in the order of their strings, and in one class if and only if those are equal."""
    length, gram = 50, 20
    mark = {7: "TRIGGERtriggerTRIGGE", 3: "zzTRIGGERtriggerTRIG"}
    pieces = []
    for i in range(120):
        t = rng.choice([3, 7])
        left = rng.choice(["", "ab", "abab", "babab", "x" * 30, "ab" * 15])[: length - gram]
        right = rng.choice(["", "c", "cd", "dc"]) * rng.randrange(4)
        count = rng.randrange(1, len(left) + 2)
        pieces.append((t, (left + mark[t] + right).ljust(200, rng.choice("yz"))[: count + length - 1].encode(), len(left), count))
    pieces = sorted(set(pieces))
    t, text, left, count = zip(*pieces, strict=True)
    begin = np.cumsum([0, *map(len, text)])[:-1]
    order, classes = suffix_dedup.corpus_order(np.frombuffer(b"".join(text), np.uint8), np.array(t, np.uint64), begin, np.array(count), np.array(left), length)
    strings = [(t[i], text[i][s : s + length]) for i in range(len(t)) for s in range(count[i])]
    got = [strings[i] for i in order]
    assert got == sorted(strings) and len(set(strings)) < len(strings)
    assert [a == b for a, b in zip(got, got[1:])] == (np.diff(classes) == 0).tolist()


def test_a_common_line_does_not_fill_a_bucket(spark):
    """One line in random texts: what reaches the fullest bucket does not follow the number of texts."""
    most = []
    for n in (500, 2000):
        k = n // 5
        r = random.Random(n)
        line = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(80))
        rows = [(i, "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300)) + line + "".join(r.choice("abcdefgh") for _ in range(300))) for i in range(n)]
        docs = batches(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 4)
        first = answer(ask(docs, lambda b, _: suffix_dedup._offer(suffix_dedup.Parse(b, 50, k))), 1, suffix_dedup._dictionary)
        sent = ask(docs, lambda b, got: suffix_dedup._details(b, 50, k, got), first)
        most.append(sent.selectExpr("bucket", "length(message) as n").groupBy("bucket").sum("n").agg({"sum(n)": "max"}).collect()[0][0])
    assert most[1] < 1.5 * most[0]
