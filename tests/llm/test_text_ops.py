"""Quality rules, decontamination, languages, licences, URLs, BPE and token files against plain versions."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from cliploom.llm import decontaminate, frames, language_mix, license_scan, quality_rules, queries, rank_bpe, token_blocks, url_rules

from .conftest import by_text, frame

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def base_statistics(t):
    t = t or ""
    w = SPACED.findall(t)
    lines = [x for x in t.split("\n") if SPACED.search(x)]
    seen, again = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2)), [False] * len(w)
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            again[i : i + 3] = [True] * 3
    return len(w), sum(map(len, w)), sum(map(t.count, "#*$%&|<>")), len(lines) - len(set(lines)), sum(again), len(w) < 50 or 100 * sum(again) > 50 * len(w)


def test_quality_statistics(spark, rows):
    rows = [*rows, (1, "a\na\n a\n#|<\n"), (2, "\x85 é😀 $$")]
    labels = spark.createDataFrame([(1, 0), (2, 1), (None, 0), (3, None)], "doc_id long, quality int")
    got = [tuple(r)[:7] for r in quality_rules.judge(frame(spark, rows), labels).collect()]
    assert by_text(got) == by_text((d, *base_statistics(t)) for d, t in rows)


def test_quality_rules_learn(spark):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice("abcdefgh") * r.randrange(1, 9) + str(r.randrange(99999)) + ("$$" if i % 4 == 0 else "") for _ in range(80))) for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 240, 2)], "doc_id long, quality int")
    rules = quality_rules.fit(frame(spark, rows), labels)
    assert rules.rules and "reject if" in str(rules)
    df = frame(spark, rows)
    kept = quality_rules.keep_good(df, labels)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i in range(240) if i % 4}
    assert quality_rules.fit(df, labels.limit(0)).rules == []
    assert quality_rules.judge(frame(spark, []), labels).count() == 0


def test_verdicts_are_those_of_the_list(spark):
    """kept against the rules read one by one in plain Python, and rejects against labels that the rules did not see."""
    data = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    seen, fresh = labels.where("doc_id % 2 = 0"), {r["doc_id"]: r["quality"] for r in labels.where("doc_id % 2 = 1").collect()}
    rules = quality_rules.fit(docs, seen)
    again = quality_rules.fit(docs, seen)
    assert rules.rules == again.rules and rules.rules
    wrong = right = bad = good = 0
    stats = {r["doc_id"]: r["_stats"] for r in quality_rules.with_statistics(docs.select("doc_id", "text"), "text", "_stats", keep_text=False).collect()}
    for r in quality_rules.judge(docs, seen).collect():
        s = stats[r["doc_id"]]
        f = {k: float(s[a]) if b is None else (s[a] / s[b] if s[b] else 0.0) for k, (a, b) in quality_rules.FEATURES.items()}
        first = next((n for n, rule in enumerate(rules.rules, 1) if all(f[c.feature] >= c.threshold if c.above else f[c.feature] <= c.threshold for c in rule)), 0)
        assert (r["rule"], r["kept"]) == (first, not r["base_failed"] and first == 0)
        if r["doc_id"] in fresh:
            bad, good = bad + (fresh[r["doc_id"]] == 0), good + (fresh[r["doc_id"]] == 1)
            right, wrong = right + (fresh[r["doc_id"]] == 0 and not r["kept"]), wrong + (fresh[r["doc_id"]] == 1 and first > 0)
    assert right >= 0.95 * bad and wrong <= 0.01 * good and bad and good


def brute_contamination(rows, items, n=13, share=20):
    windows = {}
    for i, t in items:
        w = ALNUM.findall((t or "").translate(FOLD))
        k = min(n, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[j : j + k]), set()).add(str(i))
    out = []
    for d, t in rows:
        w = ALNUM.findall((t or "").translate(FOLD))
        hit, found = [False] * len(w), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if x := windows.get(tuple(w[j : j + k])):
                    found |= x
                    hit[j : j + k] = [True] * k
        names = ",".join(sorted(found))
        out.append((d, len(w), sum(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(sum(hit)) and share * sum(hit) >= len(w)))
    return out


@pytest.mark.parametrize("options", [{}, {"block_bytes": 40}, {"block_bytes": 4000}, {"window": 3}])
def test_contamination(spark, rng, rows, options):
    vocabulary = "aB é9 cd ee fgh i j".split()
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 13, 14, 40])))) for i in range(20)] + [(31, None), (32, ""), (33, "!!")]
    items.append((34, items[5][1]))
    rows = rows + [(2000 + i, "x y. " + items[i % 20][1].upper() + "--z " * rng.randrange(300)) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_contamination(rows, items, options.get("window", 13))
    got = decontaminate.contamination(frame(spark, rows), bench, **options).collect()
    assert by_text(tuple(r)[:6] for r in got) == by_text(want)
    assert decontaminate.drop_contaminated(frame(spark, rows), bench, **options).count() == sum(not r[-1] for r in want)
    assert decontaminate.contamination(frame(spark, []), bench).count() == 0


def test_languages(spark):
    data = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = language_mix.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    fresh = [r for r in got if r["held_out"] and len(r["text"]) > 200]
    assert sum(r["lang"] == r["lang_pred"] for r in fresh) >= 0.97 * len(fresh)
    odd = spark.createDataFrame([(None, None, "en"), (2, "12 !", None), (3, "the cat", "en"), (4, "日本 😀", None), (5, "", None)], "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["lang_pred"] for r in language_mix.identify(odd).collect()} == {None: "und", 2: "und", 3: "en", 4: "en", 5: "und"}
    assert language_mix.identify(odd.limit(0)).count() == 0


def test_mixture_finds_both(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog with that thing " * 20, "en"), (6, "le chat et la souris avec une chose " * 20, "fr"), (7, "the cat and the dog with that thing " * 9 + "le chat et la souris avec une chose " * 6, None)], "doc_id long, text string, lang string")
    both = language_mix.predict(docs, language_mix.fit(docs)).where("doc_id = 7").collect()[0]
    assert both["lang_pred"] == "en" and 0.5 < both["score"] < 0.75 and set(both["languages"]) == {"en", "fr"}


def plain_shares(counts, p, penalty, steps=12):
    """Expectation-maximisation for one text in plain Python, with the same choice of languages."""
    m, total = len(p), sum(counts)
    at = [b for b, n in enumerate(counts) if n]
    like = lambda s: sum(counts[b] * np.log(sum(s[k] * p[k][b] for k in range(m))) for b in at)
    single = [like([float(k == j) for k in range(m)]) for j in range(m)]
    chosen = {int(np.argmax(single))}
    share, score = [float(k in chosen) for k in range(m)], max(single)
    while len(chosen) < m:
        mixed = {b: sum(share[k] * p[k][b] for k in range(m)) for b in at}
        slope = {k: sum(counts[b] * p[k][b] / mixed[b] for b in at) for k in range(m) if k not in chosen}
        new = max(slope, key=slope.get)
        if slope[new] <= total * 1.0001:
            break
        s = [share[k] * 0.9 if k in chosen else 0.1 * (k == new) for k in range(m)]
        for _ in range(steps):
            mixed = {b: sum(s[k] * p[k][b] for k in range(m)) for b in at}
            s = [s[k] * sum(counts[b] * p[k][b] / mixed[b] for b in at) / total for k in range(m)]
        now = like(s)
        if now <= score + penalty * np.log(max(total, 2)):
            break
        chosen, share, score = chosen | {new}, s, now
    return share


def test_shares_against_plain_em():
    r = np.random.default_rng(5)
    model = language_mix.Model({k: r.integers(0, 400, 60) * (r.random(60) < 0.6) for k in "abcd"}, 60)
    counts = []
    for _ in range(60):
        w = r.dirichlet([0.4] * 4)
        counts.append(r.multinomial(r.integers(1, 600), np.clip(w @ model.p.astype(float), 0, None) / (w @ model.p.astype(float)).sum()))
    got, n = model.shares(np.array(counts, np.float32), 3.0)
    want = np.array([plain_shares(c.tolist(), model.p.astype(float), 3.0) for c in counts])
    same = ((got > 0) == (want > 0)).all(1)
    assert same.mean() >= 0.95 and np.abs(got - want)[same].max() < 0.01 and (n > 1).any()


def test_languages_of_ties_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "abc abc", "xx"), (2, "abc abc", "aa"), (2, "abc abc", "aa"), (4, "abc", None)], "doc_id long, text string, lang string")
    model = language_mix.Model({"xx": np.ones(4096), "aa": np.ones(4096)})
    got = language_mix.predict(docs, model).collect()
    assert len(got) == 4 and {r["lang_pred"] for r in got} == {"aa"}


def test_licences(spark):
    rows = [(1, "foo Released under the MIT License. bar"), (2, "Released xx under yy"), (3, None), (4, ""), (None, "licensed under the apache license version 2.0 " * 3), (5, "This work is licensed under the GNU Public License, version 3"), (6, "all rights reserved"), (6, "x " * 5000 + "All\nRIGHTS reserved.")]
    got = {(r["doc_id"], r["n_words"]): [(m["license"], round(m["coverage"], 2), m["start"], m["end"]) for m in r["matches"]] for r in license_scan.scan(frame(spark, rows)).collect()}
    assert got == {
        (1, 7): [("MIT", 1.0, 1, 6)], (2, 4): [], (3, 0): [], (4, 0): [], (None, 24): [("Apache-2.0", 1.0, i, i + 8) for i in (0, 8, 16)],
        (5, 11): [("GPL-3.0", 0.92, 0, 11)], (6, 3): [("all-rights-reserved", 1.0, 0, 3)], (6, 5003): [("all-rights-reserved", 1.0, 5000, 5003)],
    }
    assert license_scan.scan(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(frame(spark, rows), {"short": "MIT"})


def common_words(t, d, low, high):
    """Most words of t and d in common, in order, at diagonals from low to high."""
    best = {}
    for i, x in enumerate(t):
        row = {}
        for j in range(max(0, i + low), min(len(d), i + high + 1)):
            row[j] = max(row.get(j - 1, best.get(j - 1, 0)), best.get(j, 0), best.get(j - 1, 0) + (x == d[j]))
        best = {j: max(best.get(j, 0), row.get(j, 0)) for j in {*best, *row}}
        best = dict(sorted(best.items()))
        for a, b in zip(list(best), list(best)[1:], strict=False):
            best[b] = max(best[a], best[b])
    return max(best.values(), default=0)


def test_licences_against_all_alignments(spark):
    """Templates of many lengths, with words left out, changed and put in at random and at even distances, against every template on every diagonal."""
    r = random.Random(3)
    texts = {**license_scan.NOTICES, **{f"own{n}": " ".join(f"w{(i * 7 + n) % 40}" for i in range(n)) for n in (4, 9, 11, 14)}}
    words = {k: ALNUM.findall(x.translate(FOLD)) for k, x in texts.items()}
    rows = [(1, "Released under MIT License"), (2, "Released under a MIT License"), (3, "x Licensed under CC BY 4.0 y"), (4, "Licensed under CC xx NC 4.0"), (5, "Released xx under yy the zz MIT zz License")]
    for k, x in words.items():
        miss = int(0.2 * len(x) + 1e-9)
        for m in range(9):
            out = r.sample(range(len(x)), min(len(x), miss + m // 5)) if m % 3 else [(i + 1) * len(x) // (miss + 1) for i in range(miss)]
            d = [y for i, y in enumerate(x) for y in ([y] if i not in out else ["zz"] if m % 2 else []) + ["yy"] * (r.random() < 0.05 * m)]
            rows.append((len(rows) + 1, " ".join([r.choice("the of this license under all".split()) for _ in range(r.randrange(9))] + d + ["zz"] * r.randrange(9))))
    got = {x["doc_id"]: x for x in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), texts).collect()}
    n = 0
    for i, text in rows:
        d = ALNUM.findall(text.translate(FOLD))
        for k, x in words.items():
            slack = max(2, int(0.15 * len(x)))
            found = common_words(x, d, -len(x), len(d)) >= 0.8 * len(x)
            within = found and any(common_words(x, d, c - slack, c + slack) >= 0.8 * len(x) for c in range(-len(x), len(d)))
            n += within
            assert within <= (k in got[i]["licenses"]) <= found, (k, text)
    assert n > 80 and all(got[i]["n_matches"] >= 1 for i in range(1, 6))


def test_licences_side_by_side(spark):
    rows = [(1, "Released under MIT License " * 3), (2, "all rights reserved " * 4), (3, "This work is licensed under GNU General Public License version 3 " * 2)]
    assert {x["doc_id"]: x["n_matches"] for x in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {1: 3, 2: 4, 3: 2}


def test_licences_of_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = {d: sorted(k for k, n in license_scan.NOTICES.items() if n.rstrip(".").lower() in t.lower()) for d, t in docs.collect()}
    got = {r["doc_id"]: r["licenses"] for r in license_scan.scan(docs).collect()}
    assert all(set(want[d]) <= set(got[d]) for d in want) and sum(map(len, want.values())) >= 0.9 * sum(map(len, got.values()))


def brute_urls(rows, rules):
    best = {}
    for h, p, v in rules:
        if h:
            best[h.translate(FOLD), p or ""] = max(v, best.get((h.translate(FOLD), p or ""), ""))
    out = []
    for i, u in rows:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        h, p = (m[1].translate(FOLD), m[2]) if m else ("", "")
        fits = [(len(a + b), a + b, v) for (a, b), v in best.items() if (h == a or h.endswith("." + a)) and p.startswith(b)]
        out.append((i, h, p, max(fits)[1], max(fits)[2]) if fits else (i, h, p, None, "allow"))
    return out


def test_urls(spark, rng):
    hosts = ["net", "A.net", "b.a.net", "com", "x.com", "notcom", "é.net", "net.", "a..net", "", " net"]
    paths = ["", "/", "/a", "/a/b", "/A", "/é", "/a/bc", "//", "/\n"]
    rows = [(i % 150, rng.choice(["http://", "x://y://", ""]) + rng.choice(hosts) + rng.choice(paths) + rng.choice(["", "?q://z", "#t"])) for i in range(300)] + [(None, None), (7, "://"), (7, "://")]
    rules = [(rng.choice(hosts[:-2]), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(40)] + [(None, "/", "block"), ("", "/", "block"), ("com", None, "block")]
    for some in (rules, rules[:2], []):
        df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "1 as lane")
        got = url_rules.apply_rules(df, spark.createDataFrame(some, "host string, path string, verdict string"))
        assert by_text(got.collect()) == by_text(brute_urls(rows, some))


def test_urls_with_many_rules(spark, rng, monkeypatch):
    """Dealt by domain, with hot domains in several lanes."""
    monkeypatch.setattr(url_rules, "MOST_COPIED", 3)
    monkeypatch.setattr(url_rules, "HOT_URLS", 20)
    hosts = ["net", "a.net", "b.a.net", "c.b.a.net", "x.com", "y.x.com", "notx.com", "a..net", "net.", ".net", ""]
    paths = ["", "/", "/a", "/a/b", "/b"]
    rows = [(i, "http://" + rng.choice(hosts + ["a.net"] * 9) + rng.choice(paths)) for i in range(400)] + [(None, None)]
    rules = [(h, p, rng.choice(["allow", "block"])) for h in hosts for p in paths if rng.random() < 0.5]
    got = url_rules.apply_rules(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert by_text(got.collect()) == by_text(brute_urls(rows, rules))


def plain_align(template, doc, lo, low, high):
    """All alignments within the band by recursion over cells: most words matched, then the shortest span."""
    best = (0, 0, 0, 0)
    cells = {}
    for i, word in enumerate(template):
        for p in range(i + low, i + high + 1):
            options = [cells.get((i - 1, p)) if p <= i - 1 + high else None, cells.get((i, p - 1)) if p > i + low else None]
            if 0 <= p - lo < len(doc) and doc[p - lo] == word:
                before = cells.get((i - 1, p - 1))
                options.append((before[0] + 1, before[1]) if before else (1, p))
                best = max(best, (options[-1][0], -(p + 1 - options[-1][1]), -options[-1][1], p + 1))
            options = [x for x in options if x]
            if options:
                cells[i, p] = max(options)
    return best[0], best[1]


def test_alignment_against_plain_cells():
    r = random.Random(11)
    for _ in range(300):
        template = [r.randrange(5) for _ in range(r.randrange(3, 12))]
        doc = [r.randrange(5) for _ in range(r.randrange(0, 20))]
        lo, low = r.randrange(3), r.randrange(-4, 6)
        high = low + r.randrange(0, 8)
        n, s, e = license_scan.align(template, np.array(doc, np.uint64), lo, low, high)
        assert (n, -(e - s)) == plain_align(template, doc, lo, low, high)


def test_recall_of_licences_under_edits(spark):
    """Notices with a fifth of their words left out, changed or put in, at random: those whose alignment within the band reaches the coverage."""
    r = random.Random(8)
    rows, want = [], {}
    for k, text in license_scan.NOTICES.items():
        words = ALNUM.findall(text.translate(FOLD))
        for _ in range(30):
            d, slack = list(words), max(2, int(0.15 * len(words)))
            for _ in range(r.randrange(0, 1 + len(words) // 5)):
                at = r.randrange(len(d))
                d[at : at + 1] = r.choice([[], ["zz"], [d[at], "zz"]])
            i = len(rows)
            rows.append((i, "some words before " + " ".join(d) + " and some behind"))
            full = ALNUM.findall(rows[-1][1])
            if any(common_words(words, full, c - slack, c + slack) >= 0.8 * len(words) for c in range(-len(words), len(full))):
                want[i] = k
    got = {x["doc_id"]: x["licenses"] for x in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) > 150 and sum(k in got[i] for i, k in want.items()) == len(want)


def test_urls_run_no_python(spark):
    plan = queries.op8_url_filters(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    data = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        c.execute(f"create view {t} as from '{data}/{t}.parquet{'/*.parquet' if os.path.isdir(f'{data}/{t}.parquet') else ''}'")
    want = c.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, data)
    assert sorted(got.columns) == sorted(want.columns)
    assert by_text(got.select(*want.columns).collect()) == by_text(want.fetchall())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.vocabulary())


def odd_texts(rng):
    parts = ["a", "b", " ", " ", "  ", "\n", "\t", "'s", "'re", "é", "9", "½", "Ⅷ", "_", "-", "!", "<|endoftext|>", "<|endof", "日本", "\x1c", "\x85", "\xa0", "😀", "\r", "\x00", "'", "ll"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(1500)] + ["a" * 3000, "ab" * 900 + " " + "x " * 50, "", " ", " a", "a "]


def test_bpe(spark, rng, library):
    rows = [*enumerate(odd_texts(rng)), (None, None), (None, "x")]
    got = rank_bpe.token_digests(frame(spark, rows), queries.vocabulary()).collect()
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert by_text(got) == by_text(want)
    assert all((t or "") == r["decoded"] for r in rank_bpe.encode_decode(frame(spark, rows[:200]), queries.vocabulary()).collect() for t in [rows[r["doc_id"]][1]])
    assert rank_bpe.token_digests(frame(spark, []), queries.vocabulary()).count() == 0


@pytest.mark.parametrize("n", [0, 1, 1023, 1025, 4000])
@pytest.mark.parametrize("high", [0, 3, 300, 50257, 2**32 - 1])
def test_blocks(n, high):
    r = np.random.default_rng(n + high)
    ids = r.integers(0, high, n, endpoint=True).astype(np.uint32)
    ids[r.random(n) < 0.03] = 2**32 - 1
    for block in (8, 1024):
        raw = token_blocks.pack(np.array([4, 9]), np.array([0, 1]), np.array([n // 3, n - n // 3]), ids, block=block) + b"\n"
        a, b = token_blocks.segments(raw * 2)
        assert (a.ids() == ids).all() and (b.document(1) == ids[n // 3 :]).all() and (b.document(0) == ids[: n // 3]).all()


def test_token_files(spark, rng, library):
    rows = [(i * 7919 % 997, t) for i, t in enumerate(odd_texts(rng)[:400])] + [(None, None), (None, "a"), (1, ""), (1, "z"), (-5, "é")]
    want, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    for options in ({}, {"segment_bytes": 90, "file_segments": 2, "block": 64}):
        path = frames.scratch_path(spark, "test")
        token_blocks.write_tokens(frame(spark, rows), path, queries.vocabulary(), **options)
        assert [tuple(r) for r in token_blocks.read_tokens(spark, path).orderBy("start").collect()] == want
    path = frames.scratch_path(spark, "test")
    token_blocks.write_tokens(frame(spark, []), path, queries.vocabulary())
    assert token_blocks.read_tokens(spark, path).count() == 0


def test_many_token_files(spark, library):
    """More than a thousand files from one partition and some from each of several: order is by number, not by name."""
    rows = [(i, f"t{i} " * (1 + i % 3)) for i in range(1300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            path = frames.scratch_path(spark, "test")
            token_blocks.write_tokens(frame(spark, rows), path, queries.vocabulary(), segment_bytes=1, file_segments=1)
            got = token_blocks.read_tokens(spark, path).orderBy("doc_id").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        start = 0
        for (i, t), r in zip(rows, got, strict=True):
            n = len(library.encode(t, add_special_tokens=False).ids) + 1
            assert (r["doc_id"], r["start"], r["n_tokens"]) == (i, start, n)
            start += n


def thue_morse(n):
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s, s.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 4096])
def test_strings_that_a_polynomial_hash_confuses(spark, library, n):
    a, b = thue_morse(n)
    rows = [(1, a), (2, b), (3, f"{b} {a}"), (4, a)]
    for r in rank_bpe.token_digests(frame(spark, rows), queries.vocabulary()).collect():
        ids = library.encode(rows[r["doc_id"] - 1][1], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    items = [(7, a + " x"), (8, b + " y z")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows += [(5, f"{b} x {a} y z"), (6, f"q {a} x")]
    assert by_text(tuple(r)[:6] for r in decontaminate.contamination(frame(spark, rows), bench).collect()) == by_text(brute_contamination(rows, items))


def test_runs_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(rank_bpe, "span_hash", lambda buf, start, end, lanes=None: np.zeros(len(start), np.uint64))
    text = b"".join(w.ljust(12, b".") for w in [b"one", b"two", b"one", b"three", b"two", b"four"])
    buf = np.frombuffer(text, np.uint8)
    start = np.arange(0, len(text), 12)
    code, first = rank_bpe.distinct_runs(buf, start, start + 12)
    assert [text[start[first[c]] :][:12] for c in code] == [text[s:][:12] for s in start] and len(first) == 4
