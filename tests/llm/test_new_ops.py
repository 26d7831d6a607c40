"""Token alignment, conversation repair and the quality classifier against plain versions."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import product

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cliploom.llm import conversation_repair as repair
from cliploom.llm import quality_model, queries, sql, token_sweep
from cliploom.llm.rank_bpe import byte_alphabet

from .conftest import by_text, frame

DATA = "/root/testdata/sf0.001"
BOTH = token_sweep.Vocabularies(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def tokens(rows):
    """For each row None, or [(start, end, id), ...] of both sides, by the libraries."""
    a, b, chars = Tokenizer.from_file(BOTH.a_path), sentencepiece.SentencePieceProcessor(model_file=BOTH.b_path), byte_alphabet()
    a.encode_special_tokens = True
    for _, text in rows:
        want = (" " + (text or "")).encode()
        sides = []
        for ids, spell in (
            (a.encode(" " + (text or ""), add_special_tokens=False).ids, lambda i: bytes(chars[c] for c in a.id_to_token(i))),
            (b.encode(text or ""), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()),
        ):
            parts = [spell(i) for i in ids]
            ends = np.cumsum([len(p) for p in parts]).tolist()
            sides.append([(e - len(p), e, i) for p, e, i in zip(parts, ends, ids, strict=True)] if b"".join(parts) == want else None)
        yield sides if text and None not in sides else None


def plain_groups(a, b):
    ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
    for s, e in zip([0, *ends], ends, strict=False):
        yield s, e, [i for _, z, i in a if s < z <= e], [i for _, z, i in b if s < z <= e]


def plain_links(a, b):
    j = 0
    for s, e, i in a:
        while b[j][1] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][0] < e:
            yield i, b[k][2]
            k += 1


def plain_alignment(rows):
    found = [x and (x, list(plain_groups(*x)), list(plain_links(*x))) for x in tokens(rows)]
    count = Counter(p for x in found if x for p in set(x[2]))
    best = Counter()
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    for (doc, _), x in zip(rows, found, strict=True):
        if not x:
            yield doc, 0, 0, 0, 0, 0, 0, ""
            continue
        (a, b), groups, links = x
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for _, _, p, q in groups)
        yield doc, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()


ODD = [
    (None, None), (None, "x"), (5, ""), (7, "▁a"), (8, "<s><|endoftext|> </s><unk> <0x41>"), (9, "  a   b \n\n\tc"), (9, "  a   b \n\n\tc"), (9, "zz"),
    (10, "é日本語😀 ½ﬁ  ﬁ"), (11, "a\0b\r\n"), (12, "word " * 9000), (13, "x" * 5000), (14, " " * 3000), (15, "\n"), (16, " ▁"), (17, "日本" * 4000), (18, "don't 12345 e.g. ,,;--"),
]


@pytest.mark.parametrize("step, span", [(1 << 19, 1 << 14), (50, 40)])
def test_alignment(spark, rows, monkeypatch, step, span):
    """Also with steps and rows so short that documents go over many."""
    monkeypatch.setattr(token_sweep, "STEP", step)
    monkeypatch.setattr(token_sweep, "SPAN", span)
    monkeypatch.setattr(token_sweep, "BATCH_LINKS", 500 if step == 50 else 1 << 22)
    some = [*rows, *ODD] if step > 50 else [*rows[:30], *ODD[:10]]
    got = token_sweep.alignment(frame(spark, some), BOTH).collect()
    assert by_text(got) == by_text(plain_alignment(some))
    assert token_sweep.alignment(frame(spark, []), BOTH).count() == 0


def test_groups_and_links(spark, rows, monkeypatch):
    monkeypatch.setattr(token_sweep, "STEP", 200)
    monkeypatch.setattr(token_sweep, "SPAN", 64)
    some = [*rows[:20], *ODD[:11], (9, "zz")]
    got = token_sweep.token_groups(frame(spark, some), BOTH).collect()
    assert by_text(got) == by_text((d, *g) for (d, _), x in zip(some, tokens(some), strict=True) if x for g in plain_groups(*x))
    got = token_sweep.token_links(frame(spark, some), BOTH).collect()
    assert by_text(got) == by_text((d, *p, n) for (d, _), x in zip(some, tokens(some), strict=True) if x for p, n in Counter(plain_links(*x)).items())


def test_alignment_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert by_text(queries.queries()["op11_token_alignment"](spark, DATA).collect()) == by_text(plain_alignment(docs))


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def conversations(seed=3):
    r, out = random.Random(seed), []
    for c in [*range(150), None]:
        for k in range(r.choice([1, 2, 3, 5, 9]) if c != 7 else 400):
            out.append((c, r.choice([k, k, k, None, r.randrange(6)]), r.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]), r.choice(["a.", "b!", "c", "", " \n", None, "d?", " e. ", "f\n", f"g{r.randrange(99)}."])))
    return [*out, *[(500, 1, "user", "same.")] * 50, (501, 1, "system", "x" * 100_000 + "."), (501, 2, "user", "y.")]


def by_sql(path):
    db = duckdb.connect()
    db.execute(f"create view conversations as from '{path}'")
    return by_text(db.sql(sql.OP12).select(*COLUMNS).fetchall())


@pytest.mark.parametrize("most", [20_000, 3])
def test_repair(spark, tmp_path, monkeypatch, most):
    """Against SQL; also with fragments of three rows, and with a conversation over many tasks."""
    monkeypatch.setattr(repair, "MOST_ROWS", most)
    path = str(tmp_path / "c.parquet")
    pd.DataFrame(conversations(), columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(path)
    df = spark.read.parquet(path).withColumns({"main": F.lit(1), "h": F.lit("x"), "part": F.lit(2), "a.b": F.lit(0), "copies": F.lit(9)})
    for parts in ("4", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = repair.repair_table(repair.damaged(df), copies_col="copies")
            assert by_text(got.select(*COLUMNS).collect()) == by_sql(path)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert repair.repair_table(repair.damaged(df.limit(0)), copies_col="copies").count() == 0
    lines = repair.repaired_rows(repair.damaged(df), copies_col="copies").orderBy("conv_id", "part", "k").collect()
    digest = {c: hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in lines if r["conv_id"] == c).encode()).hexdigest() for c in {r["conv_id"] for r in lines}}
    assert all(digest.get(r["conv_id"], hashlib.sha256(b"").hexdigest()) == r["repaired_sha256"] for r in got.collect())


def all_edits(symbols, most_inserted=3):
    """Least (cost, initials) of all edits of a short conversation that leave (s?(ua)+)?, tried one by one."""
    best = None
    for n in range(most_inserted + 1):
        for slots in product(range(len(symbols) + 1), repeat=n):
            if list(slots) != sorted(slots):
                continue
            for kinds in product("DKR", repeat=len(symbols)):
                cost, text, options, ok = 5 * n, "", [""], True
                for i in range(len(symbols) + 1):
                    k = slots.count(i)
                    text += "I" * k
                    options = [o + x for o in options for x in map("".join, product("ua", repeat=k))]
                    if i == len(symbols):
                        break
                    (initial, fault), e = repair.SYMBOLS[symbols[i]], kinds[i]
                    text += e
                    ok &= e == "D" or fault != repair.GONE
                    cost += {"D": 2, "K": 0, "R": 1}[e] + (5 if e != "D" and fault == repair.CUT else 0)
                    options = options if e == "D" else [o + x for o in options for x in (initial if e == "K" else "ua")]
                good = lambda o: not o or (o[o[0] == "s" :] and len(o[o[0] == "s" :]) % 2 == 0 and all(x == "ua"[j % 2] for j, x in enumerate(o[o[0] == "s" :])))
                if ok and any(map(good, options)):
                    best = min(best or (cost, text), (cost, text))
    return best


def test_least_edits():
    auto, r = repair.Repairs(), random.Random(1)
    for _ in range(150):
        symbols = bytes(r.choice([0, *range(1, 9)]) if r.random() < 0.5 else r.choice([2, 3]) for _ in range(r.randrange(4)))
        states, total = auto.scan(symbols, auto.end)
        edits, q = auto.trace(symbols, states, repair.START)
        assert (total + auto.vectors[states[0]][repair.START], "".join(edits) + auto.tail(q)) == all_edits(symbols)


def test_automaton_is_small():
    auto, r = repair.Repairs(), random.Random(2)
    for _ in range(300):
        auto.costs(bytes(r.randrange(9) for _ in range(30)))
    assert len(auto.vectors) < 500


def labelled_rows(n=600, seed=4):
    r, rows, labels = random.Random(seed), [], []
    for i in range(n):
        good = r.random() < 0.7
        rows.append((i, " ".join(r.choice("alpha beta gamma delta".split() if good else "ALPHA beta!! gamma $$ delta".split()) + r.choice("abc") for _ in range(r.randrange(5, 90)))))
        labels.append((i, int(good)))
    return rows, labels


def test_classifier(spark):
    rows, labels = labelled_rows()
    df = frame(spark, [*rows, (None, rows[0][1]), (9000, None), (9000, ""), (9001, "x" * 3_000_000), rows[5], rows[5]])
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int").withColumns({"text": F.lit("t"), "good": F.lit(1), "hash": F.lit(2)})
    model = quality_model.fit(df, marks)
    got = quality_model.score(df, model).collect()
    assert len(got) == len(rows) + 6 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert {r["doc_id"] for r in got if r["held_out"]} == held | ({9000, 9001} & {i for i in (9000, 9001) if zlib.crc32(str(i).encode()) % 5 == 0})
    want = dict(labels)
    assert sum(r["predicted"] == want[r["doc_id"]] for r in got if r["doc_id"] in held) >= 0.98 * len([r for r in got if r["doc_id"] in held])
    flipped = spark.createDataFrame([(i, q if zlib.crc32(str(i).encode()) % 5 else 1 - q) for i, q in labels], "doc_id long, quality int")
    again = quality_model.fit(df, flipped)  # held-out labels are not read
    assert np.array_equal(again.z, model.z) and np.array_equal(again.bias, model.bias)
    assert {r["score"] for r in quality_model.score(df, quality_model.fit(df, marks.limit(0))).collect()} == {0.5}
    assert quality_model.score(frame(spark, []), model).count() == 0


def test_bound_holds_for_rows(spark):
    """One labelled id with 3000 texts, and one row 3000 times."""
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(3000)] + [(2, "same")] * 3000, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert quality_model.labelled(docs, labels, 10).count() == 10


def test_updates_are_those_of_plain_ftrl():
    r, rates = random.Random(6), quality_model.Rates()
    model, z, n, bias = quality_model.Model.empty(rates), Counter(), Counter(), [0.0, 0.0]
    weight = lambda z, n, l1: 0.0 if abs(z) <= l1 else -(z - (l1 if z > 0 else -l1)) / ((rates.beta + n**0.5) / rates.alpha + rates.l2)
    for _ in range(200):
        x, good = {p: r.random() for p in r.sample(range(40), 6)}, r.random() < 0.5
        model.learn(np.array(list(x)), np.array(list(x.values())), good)
        w, b = {p: weight(z[p], n[p], rates.l1) for p in x}, weight(*bias, 0.0)
        error = 1 / (1 + np.exp(-(sum(w[p] * v for p, v in x.items()) + b))) - good
        for p, v in x.items():
            g = error * v
            z[p] += g - ((n[p] + g * g) ** 0.5 - n[p] ** 0.5) / rates.alpha * w[p]
            n[p] += g * g
        bias = [bias[0] + error - ((bias[1] + error**2) ** 0.5 - bias[1] ** 0.5) / rates.alpha * b, bias[1] + error**2]
    assert np.allclose(model.z[:40], [z[p] for p in range(40)]) and np.allclose(model.bias, bias)


def test_features_by_hand():
    texts = ["The cat the cat", "", "AB!! ab"]
    raw = "".join(texts).encode()
    row, place, value = quality_model.features(np.frombuffer(raw, np.uint8), np.cumsum([0, *map(len, texts)]))
    # the, cat, the cat, cat the / Aa, a, Aa a, a a (two), Aa a a, a a a
    assert Counter(row.tolist()) == {0: 10, 2: 3 + 3}
    assert np.allclose(np.bincount(row, value * value), [1, 0, 1])


def test_held_out_quality(spark):
    got = {r["doc_id"]: r for r in queries.queries()["op13_quality_classifier"](spark, "/root/testdata/sf0.1").collect()}
    held = [(got[r["doc_id"]], r["quality"]) for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    bad, good = [[r["predicted"] for r, q in held if q == k] for k in (0, 1)]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad) and len(bad) > 50


def test_equal_ids_are_in_order_of_text(spark, tmp_path):
    from cliploom.llm import token_blocks

    r = random.Random(8)
    rows = [(7, "same beginning of texts that differ late, after more than sixty-four characters " * (k % 2) + str(r.randrange(10**6))) for k in range(400)]
    token_blocks.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), str(tmp_path / "t"), queries.vocabulary())
    library = Tokenizer.from_file(queries.vocabulary())
    want = [zlib.crc32(np.array([*e.ids, 0], "<u4").tobytes()) for e in library.encode_batch(sorted(t for _, t in rows), add_special_tokens=False)]
    assert [x["ids_crc32"] for x in token_blocks.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()] == want


def test_rules_bound_holds_for_rows(spark):
    from cliploom.llm import labelled

    docs = spark.createDataFrame([(1, f"text {i}") for i in range(3000)], "doc_id long, text string")
    assert labelled.labelled_rows(docs, spark.createDataFrame([(1, 0), (1, 1)], "doc_id long, mark int"), 10, "doc_id", "text").count() == 10
