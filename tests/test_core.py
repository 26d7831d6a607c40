"""Operators that the registered queries do not reach, and differential tests against plain loops."""

import json
import random
import time
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from cliploom.functions import reading, signal, text
from cliploom.operators import ctc, edits, grouping, intervals, models, quality, rollup
from cliploom.operators.running import running
from cliploom.plans import stages
from cliploom.sources import scans, sinks
from cliploom.streaming import jobs

from .plain_reader import Reader

READ = [
    ("Năm 2005 có 104 người", "Năm hai nghìn không trăm lẻ năm có một trăm lẻ bốn người."),
    ("1.000.005 và 1.500,25", "một triệu không trăm lẻ năm và một nghìn năm trăm phẩy hai năm."),
    ("lúc 7h05, 8:00 hay 9:10:30", "lúc bảy giờ năm phút, tám giờ hay chín giờ mười phút ba mươi giây."),
    ("ngày 4/4/24; 12/1999; mùng 2/9", "ngày bốn tháng tư năm hai nghìn không trăm hai mươi tư tháng mười hai năm một nghìn chín trăm chín mươi chín mùng hai tháng chín."),
    ("thế kỷ XXI, chương iv, thứ 7", "thế kỷ hai mươi mốt, chương bốn, thứ bảy."),
    ("$5, 30°F, 45%, 10 km/h, 20 usd", "năm đô la, ba mươi độ ép, bốn mươi lăm phần trăm, mười ki lô mét trên giờ, hai mươi đô la."),
    ("3/8 và 3/16 và 10-15", "ba phần tám và ba trên mười sáu và mười đến mười lăm."),
    ("007 0912345678", "không không bảy không chín một hai ba bốn năm sáu bảy tám."),
    ("UBND TP.HCM & ABC", "ủy ban nhân dân thành phố Hồ Chí Minh và a bê xê."),
    ("[nhạc nền] cà–phê “ngon”... ♪", "cà phê ngon…"),
    ("24:00", "hai mươi bốn không không."),
    ("", ""), (" ​ ", ""),
]


def test_read_aloud(spark):
    """Golden rows, and random texts of all forms against the plain reader; nothing of Python in the plan."""
    r = random.Random(7)
    words = ["chương", "thế kỷ", "Phần", "ngày", "mùng", "THỨ", "và", "ABC", "TP.", "tp.hcm", "v.v.", "đt.", "USD", "vnđ", "đ", "km", "m²", "m2", "km/h", "h", "g", "IV", "xii", "IIIX", "CCC", "Ạ", "quý"]
    seps = ["", "", " ", " ", "-", "/", ":", ".", ",", "%", "°C", "°f", "$", "₫", "@", "½", "²", "_", "(", ")", "…", "...", "!", "?", ";", "\n", "\t", " - "]

    def number():
        d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
        return r.choice([d(r.randint(1, 12)), f"{d(2)}.{d(3)}", f"{d(1)},{d(3)}.{d(2)}", f"{d(2)},{d(2)}", f"{d(1)}.{d(1)}.{d(2)}", d(28), str(r.randint(0, 31)), str(r.randint(0, 60)).zfill(2)])

    texts = [x for x, _ in READ] + ["".join((number() if r.random() < 0.5 else r.choice(words)) + r.choice(seps) for _ in range(r.randint(1, 8))) for _ in range(600)]
    texts += [None, "", "a\x01b 5\x01km", "\x01", "9" * 5000 + ",5", "1." * 2000, "5 " * 2000, "ậ ớ", unicodedata.normalize("NFD", "Ngày 5/4 Ạ ậ ộ ứ ở")]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    out = reading.read_aloud(df, "t", "said")
    assert out.columns == ["i", "t", "said"] and "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got, plain = {x["i"]: x["said"] for x in out.collect()}, Reader()
    for i, (source, want) in enumerate(READ):
        assert got[i] == want or source == "24:00" and got[i].startswith("hai mươi"), source
    assert [(t, got[i]) for i, t in enumerate(texts) if got[i] != plain(t)] == []


def test_style(spark):
    style = reading.Style(thousand="ngàn", filler="linh", lowercase=True, abbreviations={"ABC.": "xyz"}, fraction_by_digit=False, punctuation=",.!?…;:")
    texts = ["1.005 Abc. 1,25", "A ; b:c 5 : d", "٣ km", ";a", "a;;b :"]
    got = [r[0] for r in reading.read_aloud(spark.createDataFrame([(t,) for t in texts], "text string"), style=style).collect()]
    assert got[:3] == ["một ngàn không trăm linh năm xyz một phẩy hai mươi lăm.", "a; b:c năm: d.", "ba ki lô mét."] and got == [Reader(style)(t) for t in texts]


def test_native_integers_equal_the_reader(spark):
    r, n = Reader(), [0, 1, 4, 5, 10, 11, 14, 15, 20, 21, 24, 25, 100, 101, 110, 999, 1000, 1001, 1_000_005, 10**9, 10**12 + 24, 10**15 + 105, 9_223_372_036_854_775_807] + [random.Random(3).randrange(10**k) for k in range(1, 19)]
    got = spark.createDataFrame([(x,) for x in n], "n long").select("n", reading.read_integer(F.col("n")).alias("w")).collect()
    assert [(x["n"], x["w"]) for x in got] == [(x, r.whole(x)) for x in n]


def test_text_forms(spark):
    df = spark.createDataFrame([("Xin chào: bạn\n\n«Đi đâu?» Hay...\nÀ ha!!! ok  ,, x",), ("a?b?",), ("?",), ("",)], "t string")
    prepared = [r[0] for r in df.select(text.prepare_speech(F.col("t"))).collect()]
    assert prepared[0] == "xin chào, bạn\x00đi đâu?\x00 hay.\x00à ha. ok, x"
    assert [r[0] for r in df.select(text.demote_inner_questions(F.col("t"))).collect()][1:] == ["a.b?", "?", ""]
    one = spark.range(1)
    assert one.select(text.clamp_speed(F.lit("0")), text.clamp_speed(F.lit("x")), text.clamp_speed(F.lit("")), text.clamp_speed(F.lit("9"))).first() == (0.5, 0.85, 0.85, 1.5)
    assert one.select(text.chunk_budget(F.lit(11.0), F.lit(100)), text.chunk_budget(F.lit(30.0), F.lit(100))).first() == (100, 100)
    assert one.select(text.replace_each(F.lit("a12b3"), r"\d+", lambda m: F.concat(F.lit("<"), m, F.lit(">")))).first()[0] == "a<12>b<3>"
    log = 'x {"a":1} y {"input_i":"-20.1","input_tp":"-3","input_lra":"5","input_thresh":"-30"}'
    assert one.select(text.loudness_filter(text.loudness_report(F.lit(log)))).first()[0] == "loudnorm=I=-14.0:TP=-1.5:LRA=11.0:measured_I=-20.1:measured_TP=-3:measured_LRA=5:measured_thresh=-30:linear=true"
    assert one.select(text.loudness_filter(text.loudness_report(F.lit("none")))).first()[0] == ""
    assert [r[0] for r in spark.createDataFrame([("/a/B ç.1.wav",), ("",)], "p string").select(text.sanitise_id(text.stem(F.col("p")))).collect()] == ["b_1", "source"]
    assert one.select(text.for_alignment(F.lit("Ab|c-9"), "abc|-")).first()[0] == "abc-"


def test_white_space_of_any_length(spark):
    """Long runs take one pass: no pattern starts anew inside them, none recurses."""
    blanks, n = " \u00a0\t" * 70_000, 200_000
    df = spark.createDataFrame([(blanks + "a" + blanks + "." + blanks + "b" + blanks,), ("," * n,), ("a" + " .." * 60_000 + "!b",), ("\\|" * n + "|x",)], "t string")
    got = df.select(text.strip(F.col("t")), text.pre_clean(F.col("t")), text.post_clean(F.col("t")), text.prepare_speech(F.col("t")), F.size(scans.pipe_fields(F.col("t")))).collect()
    assert got[0][1:3] == ("a . b", "a. b.") and len(got[0][0]) == 2 * len(blanks) + 3 and got[0][3].startswith("a") and got[0][3].endswith("b")
    assert got[1][2:4] == ("", "") and got[2][3] == "a. b" and got[3][4] == 2


def test_clean_up_of_single_signs(spark):
    cases = ["a1b", ". abc", ", . a", "a ,b", "a?,", "..a", "a . b , c", "ca-phê x-1 ½", "[nhạc] a-[music]b", "…… a.... b", "km² m³ ²", "", "  ", "é;b"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    r = Reader()
    for native, plain in ((text.pre_clean, r.clean_before), (text.post_clean, r.clean_after)):
        assert [x[0] for x in df.select(native(F.col("t"))).collect()] == [plain(c) for c in cases]
    assert [r.clean_after(c) for c in cases[:7]] == ["a b.", ". abc.", "a.", "a, b.", "a?", ". a.", "a. b, c."]
    said = {"a . . b": "a . . b", "a,.b": "a.b", "a, ?b": "a?b", "a !? b": "a. ? b", "a ... !, b": "a. b", "« a » b: ": "a.\x00 b.\x00", "a\r\n\n b…": "a\r\x00b."}
    got = spark.createDataFrame([(k,) for k in said], "t string").select("t", text.prepare_speech(F.col("t")).alias("p")).collect()
    assert {x["t"]: x["p"] for x in got} == said


def test_numbers_of_any_length():
    r = Reader()
    assert r("9" * 5000 + ",5").startswith("chín chín") and r("9" * 5000 + ",5").endswith("chín phẩy năm.") and r.whole("0005") == "năm" and r.whole("000") == "không"


def test_listed_files_keep_their_place(spark, tmp_path):
    for d in "ab":
        (tmp_path / d).mkdir()
        (tmp_path / d / "x.wav").write_bytes(b"")
    listed = [str(tmp_path / "b" / "x.wav"), str(tmp_path / "a" / "x.wav")]
    ids = {r["path"].split("/")[-2]: r["id"] for r in scans.recordings(spark, listed).collect()}
    assert ids == {"b": "x", "a": "x_2"}


def test_running_is_a_plain_run(spark):
    r = random.Random(1)
    rows = [(r.randrange(2), i, r.choice([None, r.randrange(9)])) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, i int, v int")
    for how in ("sum", "max", "last"):
        for before in (False, True):
            got = {(x["k"], x["i"]): x["o"] for x in running(df, ["k"], ["i"], "v", how, F.floor(F.col("i") / 7), "o", before).collect()}
            held = {0: [], 1: []}
            for k, i, v in rows:
                seen = [x for x in held[k] + ([] if before else [v]) if x is not None]
                want = (sum(seen) if how == "sum" else max(seen) if how == "max" else seen[-1]) if seen else (0 if how == "sum" else None)
                assert (got[k, i] or (0 if how == "sum" else None)) == want or got[k, i] == want
                held[k].append(v)


def test_interval_loops(spark):
    r = random.Random(4)
    rows = [(s, i, float(a := r.randrange(200)), a + r.choice([-3.0, 0.0, 2.0, 9.0])) for s in (1, 2) for i in range(60)]
    df = spark.createDataFrame(rows, "source_id long, ord long, s double, e double")
    got = {(x["source_id"], x["ord"]): (x["s2"], x["e2"]) for x in intervals.overlap_repair(df, chunk=20.0).collect()}
    for source in (1, 2):
        end = None
        for _, o, s, e in sorted((x for x in rows if x[0] == source), key=lambda x: (x[2], x[3], x[1])):
            if end is not None:
                s = max(s, end)
                e = max(e, s)
            assert got[source, o] == (s, e)
            end = e
    total = spark.createDataFrame([(1, 300.0), (2, 10.0), (3, 5.0)], "source_id long, total double")
    gaps = sorted(tuple(x) for x in intervals.complement(df, total, chunk=7).collect())
    want = []
    for source, end in ((1, 300.0), (2, 10.0), (3, 5.0)):
        at = 0.0
        for _, _, s, e in sorted((x for x in rows if x[0] == source), key=lambda x: x[1]):
            if s - at >= 0.05:
                want.append((source, at, s))
            at = max(at, e)
        if end - at >= 0.05:
            want.append((source, at, end))
    assert gaps == sorted(want)


def test_range_joins_plan_no_nested_loop(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(1, 1, 0.0, 5.0), (1, 2, 100.0, 90.0)], "source_id long, ord long, s double, e double")
        words = df.withColumnsRenamed({"s": "rs", "e": "re", "ord": "rord"}).withColumn("text", F.lit("ab"))
        for x in (intervals.overlaps(df, words), intervals.overlaps(df, words, how="left_anti"), intervals.silence_coverage(df, words), intervals.frames_in_speech(df.withColumn("frame", F.col("ord")), df, 1.0)):
            plan = x._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
            x.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rules_defaults(spark):
    t = quality.Thresholds(min_word_prob=0.5, ctc_overrides_no_speech=None)
    df = spark.createDataFrame([(1, "s", None, None, None), (2, "s", "abcdefghij", 2.0, 0.9)], "idx long, source_id string, text string, duration double, no_speech_prob double")
    got = {r["idx"]: r["reasons"] for r in quality.review(df, t).collect()}
    assert got[1] == ["duration_too_short", "text_too_short", "low_snr", "empty_text"]
    assert got[2] == ["low_snr", "no_speech"]


def test_splits(spark):
    assert rollup.mersenne_split([], 1) == ([], []) and [len(x) for x in rollup.mersenne_split(list(range(577)))] == [11, 566]
    assert [len(x) for x in rollup.mersenne_split([1])] == [0, 1]
    assert rollup.split(spark.range(577).withColumnRenamed("id", "idx"), "idx").where("part = 'val'").count() == 11
    assert rollup.nearest_rank(spark.createDataFrame([], "v double"), "v").count() == 0


def test_edit_file(spark, tmp_path):
    p = tmp_path / "edit.txt"
    p.write_text("# intro\n\n# a.wav  1.50s  ctc=1\nfirst\n  second \n# note\n# b.wav 2.00s\n\n# a.wav 1.52s\nlast\n", encoding="utf-8")
    got = scans.edit_records(scans.text_lines(spark, str(p))).orderBy("ord").select("name", "duration", "text").collect()
    assert [tuple(r) for r in got] == [("a.wav", 1.52, "last"), ("b.wav", 2.0, "")]
    clips = spark.createDataFrame([("x/a.wav", 1, 1.5, "old", 0.1, 0.2), ("x/b.wav", 2, 2.0, "keep", 0.3, 0.4)], "wav string, idx long, duration double, text string, ctc_score double, completeness double")
    out = {r["idx"]: (r["text"], r["text_source"], r["ctc_score"]) for r in edits.apply(scans.edit_records(scans.text_lines(spark, str(p))), clips).collect()}
    assert out == {1: ("last", "manual", 1.0), 2: ("keep", None, 0.3)}


def test_scans(spark, tmp_path):
    for n in ("b/Ab.wav", "a/ab.wav", "c/x.txt"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"1")
    found = scans.recordings(spark, [str(tmp_path / x) for x in "abc"], "*.wav").orderBy("path").collect()
    assert [r["id"] for r in found] == ["ab", "ab_2"]
    probe = json.dumps({"streams": [{"codec_type": "video"}, {"codec_type": "audio", "codec_name": "aac", "sample_rate": "44100", "channels": 2}], "format": {"duration": "3.5"}})
    assert tuple(spark.range(1).select(scans.probe_summary(F.lit(probe)).alias("p")).select("p.*").first()) == ("aac", 44100, 2, 0, 3.5)
    (tmp_path / "m.csv").write_text("a\\|b|c\\\\d\n\nx|y|z\n")
    assert [tuple(r) for r in scans.pipe_table(spark, str(tmp_path / "m.csv"), ["p", "q"]).collect()] == [("a|b", "c\\d"), ("x", "y")]
    names = spark.createDataFrame([(f"/m/{n}",) for n in ("model_last.pt", "model_9.pt", "model_1200.pt", "pretrained_x.pt", "model_final.pt", "final.pt", "note.txt", "model_00123456789012345678901234567890.pt")], "path string")
    listed = scans.checkpoints(names)
    assert [r["name"] for r in listed.orderBy("place").collect()] == ["model_00123456789012345678901234567890.pt", "model_1200.pt", "model_9.pt", "model_final.pt", "model_last.pt", "pretrained_x.pt"]
    assert scans.resolve_checkpoint(listed, "model_9.pt", "p").first()[0] == "model_9.pt" and scans.resolve_checkpoint(listed, "no", "p").first()[0] == "model_00123456789012345678901234567890.pt"
    lines = spark.createDataFrame([('{"text":"a","out":"o"}',), ("",), ("{bad",), ('{"action":"stop"}',)], "value string")
    assert [(r["kind"], r["speed"]) for r in scans.tasks(lines).collect()] == [("infer", 1.0), ("error", 1.0), ("stop", 1.0)]
    ps = spark.createDataFrame([("PID CPU S",), ("12 1.5 S",), (" 40 2.5 T+",)], "value string")
    assert tuple(scans.process_state(ps).first()) == (4.0, 2, True)
    assert spark.range(1).select(scans.gauge(F.lit(60))).first()[0] == "warn"


def test_sinks(spark, tmp_path):
    e = spark.createDataFrame([(2, "x/b.wav", "t|1\\"), (1, "a.wav", "u")], "idx long, filename string, text string")
    sinks.speech_csv(e, str(tmp_path / "csv"))
    raw = b"".join(p.read_bytes() for p in (tmp_path / "csv").glob("part-*"))
    assert raw == b"a|u|u\r\nb|t\\|1\\\\|t\\|1\\\\\r\n"
    sinks.lines_in_order(e.withColumn("list_path", F.col("filename")), sinks.list_line("me", "VI"), ["idx"], str(tmp_path / "list"))
    assert b"".join(p.read_bytes() for p in (tmp_path / "list").glob("part-*")) == "a.wav|me|VI|u\nx/b.wav|me|VI|t|1\\\n".encode()
    clips = spark.createDataFrame([(1, "q/a.wav", 1.5, "hi", None, 0.5)], "idx long, wav string, duration double, text string, ctc_score double, completeness double")
    for words in ("hi", "again"):
        sinks.edit_template(clips.withColumn("text", F.lit(words)), str(tmp_path / "edit"))
    assert "\n# a.wav  1.50s  ctc=1.00  daydu=0.50\nhi\n" == b"".join(p.read_bytes() for p in (tmp_path / "edit").glob("part-*")).decode()
    keep, lost = sinks.trainer_rows(spark.createDataFrame([("a", " Xin "), ("b", "c")], "name string, text string"), spark.createDataFrame([("a",)], "name string"))
    assert [tuple(r) for r in keep.collect()] == [("a", "xin")] and lost.count() == 1
    page = sinks.report("p", spark.createDataFrame([("s", 2, 60000)], "source_id string, clips long, ms long"), spark.createDataFrame([("low_snr", 3)], "reason string, n long"), {"qc": 0.01})
    assert "| s | 2 | 1.00 |" in page and "| low_snr | 3 |" in page


def test_report_has_every_source(spark, tmp_path):
    many = spark.range(10_050).selectExpr("format_string('s%05d', id) as source_id", "id as clips", "id * 60000 as ms")
    args = "p", many, spark.createDataFrame([("low_snr", 3)], "reason string, n long"), {"qc": 0.01}
    page = sinks.report(*args)
    assert [x.split(" | ")[0] for x in page.splitlines() if x.startswith("| s0") or x.startswith("| s1")] == [f"| s{i:05d}" for i in range(10_050)]
    sinks.write_report(str(tmp_path / "report.md"), *args)
    assert (tmp_path / "report.md").read_text() == page


def test_corpus_summary(spark):
    r = random.Random(4)
    rows = [(i, r.randrange(1000, 12000) / 1000, "é" * r.randrange(1, 90)) for i in range(150)]
    for some in (rows, rows[:1], []):
        df = spark.createDataFrame(some, "idx long, duration double, text string")
        one = rollup.corpus_summary(df, "idx").cache()
        d, c = sorted(x[1] for x in some), sorted(len(x[2]) for x in some)
        at = lambda v: {k: float(v[round(p * (len(v) - 1))]) for k, p in (("min", 0), ("p10", 0.1), ("median", 0.5), ("p90", 0.9), ("max", 1))} if v else None
        n = min(100, max(1, int(len(some) * 0.02)), max(0, len(some) - 1))
        assert [x.asDict(recursive=True) for x in one.collect()] == [{
            "clips": len(some), "total_seconds": round(sum(d), 2), "total_hours": round(sum(d) / 3600, 3), "mean_duration": round(sum(d) / len(d), 3) if d else 0.0,
            "duration_percentiles": at(d), "chars_percentiles": at(c), "train": len(some) - n, "val": n}]
        sources = spark.createDataFrame([("s", 2, 60000, "/a/b.mp3", 129473, 3446.77, None)], "source_id string, clips long, ms long, path string, bit_rate long, duration double, decoded_duration double")
        page = sinks.report("p", sources, spark.createDataFrame([], "reason string, n long"), {}, one)
        assert "| s | 2 | 1.00 | b.mp3 | 129 | 57.45 | 0.00 |" in page and f"- train, val: {len(some) - n}, {n}" in page
        assert json.loads(sinks.summary_json(one).first()[0])["clips"] == len(some)


def test_tokenise(spark):
    vocab = {"<pad>": 0, "|": 1, "a": 2, "b": 3, "é": 4}
    words = spark.createDataFrame([(1, 2, "E\u0301!"), (1, 0, "aB"), (1, 1, "?|"), (1, 3, None), (2, 0, "xyz"), (3, 5, "b")], "clip long, word int, text string")
    targets = ctc.tokenise(words, vocab)
    assert sorted(tuple(map(lambda v: v if isinstance(v, int) else list(v), r)) for r in targets.collect()) == [(1, [2, 3, 1, 4], [0, 0, -1, 2]), (3, [3], [5])]
    frames = spark.createDataFrame([(1, i, [9.0 if k == c else 0.0 for k in range(5)]) for i, c in enumerate([0, 2, 3, 3, 1, 4])], "clip long, frame long, scores array<double>")
    spans = ctc.owned(ctc.align(frames, targets), targets)
    assert sorted((r["clip"], r["word"], r["first"], r["end"]) for r in ctc.word_spans(spans).collect()) == [(1, 0, 1, 4), (1, 2, 5, 6)]


def test_folds(spark):
    p = spark.createDataFrame([(1, i, t) for i, t in enumerate(["aa", "bb", "c" * 9, "é", "f"])], "source_id long, ord long, text string")
    assert [(r["first"], r["last"], r["text"]) for r in grouping.pack_bytes(p, 6).orderBy("first").collect()] == [(0, 1, "aa bb"), (2, 2, "c" * 9), (3, 4, "é f")]
    s = spark.createDataFrame([(1, 19.8, 20.4), (1, 30.0, 30.1), (1, 41.0, 42.0)], "source_id long, s double, e double")
    t = spark.createDataFrame([(1, 45.0), (2, 3.0)], "source_id long, total double")
    got = sorted((r["source_id"], r["n"], round(r["bound"], 3)) for r in grouping.chunk_bounds(s, t).collect())
    assert got == [(1, 0, 0.0), (1, 1, 20.1), (1, 2, 45.0), (2, 0, 0.0), (2, 1, 3.0)]


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(2)
    for _ in range(30):
        t, n = int(r.integers(3, 7)), int(r.integers(1, 3))
        logp = np.log(r.dirichlet(np.ones(3), t))
        tokens = r.integers(1, 3, n)
        best = None
        for path in np.ndindex(*(3,) * t):
            merged = [c for i, c in enumerate(path) if c and (not i or path[i - 1] != c)]
            if merged == tokens.tolist():
                best = max(best if best is not None else -np.inf, sum(logp[i, c] for i, c in enumerate(path)))
        spans = ctc.viterbi(logp, tokens)
        assert (spans is None) == (best is None)
        if spans is not None:
            assert (spans[:, 0] < spans[:, 1]).all() and (np.diff(spans[:, 0]) > 0).all()


def test_alignment_tables(spark):
    spans = spark.createDataFrame([(1, 0, 0, 2, 0.5), (1, -1, 2, 3, 0.1), (1, 1, 3, 5, 0.7), (1, 1, 5, 6, 0.9)], "clip long, word long, first long, end long, score double")
    w = ctc.word_spans(spans)
    assert sorted(tuple(r) for r in w.collect()) == [(1, 0, 0, 2, 0.5), (1, 1, 3, 6, 0.8)]
    assert {r["clip"]: r["ctc_score"] for r in ctc.clip_scores(spans, spark.createDataFrame([(1,), (2,)], "clip long")).collect()} == {1: pytest.approx(0.7), 2: 0.0}
    words = spark.createDataFrame([(1, 0, 9.0, 9.5), (1, 2, 1.0, 2.0)], "clip long, word long, s double, e double")
    assert sorted((r["word"], r["s"], r["e"], r["realigned"]) for r in ctc.retime(words, w).collect()) == [(0, 0.0, 2.0, True), (2, 1.0, 2.0, False)]
    seg = spark.createDataFrame([("a", 0, 0.0, 9.0), ("a", 1, 9.0, 10.0)], "source_id string, seg long, s double, e double")
    flat = spark.createDataFrame([("a", 0, 2.0, 3.0, "y"), ("a", 0, 1.0, 2.0, "x")], "source_id string, seg long, s double, e double, text string")
    assert sorted((r["seg"], r["s"], r["e"], [x["text"] for x in r["words"] or []]) for r in ctc.regroup(flat, seg).collect()) == [(0, 1.0, 3.0, ["x", "y"]), (1, 9.0, 10.0, [])]
    assert spark.range(1).select(ctc.completeness(F.lit("ab"), F.lit("abcd")), ctc.completeness(F.lit("a"), F.lit("")), ctc.decode(F.array(*map(F.lit, (1, 0, 2))), ["|", "a", "b"])).first() == (0.5, 1.0, "a b")


def test_signals(spark):
    rate = 8000
    tone = np.sin(np.arange(rate) * 0.3).astype(np.float32)
    quiet = np.zeros(rate // 10, np.float32)
    x = np.r_[quiet, tone, quiet]
    back, r = signal.read_wav(signal.write_wav(x, rate))
    assert r == rate and np.abs(back - x).max() < 1e-3
    assert signal.frame_levels(x, rate).shape == (120,) and signal.frame_levels(x[:5], rate).size == 0
    assert signal.clip_ratio(np.ones(4)) == 1.0 == signal.clip_ratio(np.zeros(0)) and signal.dbfs(np.zeros(0)) == -120.0
    assert signal.snr(x, rate) > 60 and signal.snr(x[:100], rate) == 0.0
    assert rate * 1.0 <= len(signal.trim(x, rate)) <= rate * 1.12 and len(signal.trim(x[:10], rate)) == 10
    assert abs(np.abs(signal.peak_limit(tone, -6.0)).max() - signal.amplitude(-6.0)) < 1e-3
    assert np.allclose(signal.normalize_loudness(tone, rate, lambda x, r: -20.0, -26.0, 0.0), tone * signal.amplitude(-6.0), atol=1e-4)
    assert np.allclose(signal.core_blocks(x, rate, lambda b: b * 2, 0.3, 0.05), x * 2)
    part = signal.write_wav(tone, rate)
    joined, _ = signal.read_wav(signal.join_parts([part, part], 0.5))
    assert len(joined) == 2 * rate + rate // 2
    assert len(signal.resample(tone, rate, 4000)) == 4000
    df = spark.createDataFrame([(x.tolist(), rate)], "samples array<float>, rate int")
    assert df.select(F.size(signal.slice_seconds(F.col("samples"), F.col("rate"), F.lit(0.5), F.lit(0.75)))).first()[0] == 2000
    m = df.select(signal.measures(F.col("samples"), F.col("rate")).alias("m")).first()["m"]
    assert m["snr_db"] > 60 and m["clip_ratio"] > 0
    v = models.run(df.withColumn("source_id", F.lit("a")), "vad", "level", "source_id string, ord long, s double, e double").collect()
    assert [(round(r["s"], 2), round(r["e"], 2)) for r in v] == [(0.1, 1.1)]
    with pytest.raises(ValueError):
        models.run(df, "vad", "none", "a int")
    said = models.run(spark.createDataFrame([(0, "abc", 1.0)], "chunk long, text string, speed double"), "tts", "tone", "chunk long, samples array<float>, rate int").first()
    assert len(said["samples"]) == 1200


def test_stages(spark):
    assert stages.wanted(" qc, asr ") == ["asr", "qc"]
    for bad in ("qx", ","):
        with pytest.raises(ValueError):
            stages.wanted(bad)
    plan = spark.createDataFrame([("a", "qc", ["qc"], ["text"]), ("a", "text", ["text"], ["asr"]), ("b", "qc", ["qc"], ["text"])], "source_id string, stage string, outputs array<string>, needs array<string>")
    have = spark.createDataFrame([("a", "text"), ("a", "asr")], "source_id string, name string")
    assert sorted((r["source_id"], r["stage"], r["run"]) for r in stages.due(plan, have, ["qc", "text"]).collect()) == [("a", "qc", True), ("a", "text", False), ("b", "qc", False)]
    assert stages.complete_sources(have, ("text", "asr")).first()[0] == "a"


def test_stream_of_jobs(spark, tmp_path):
    log = spark.createDataFrame([("j", 1, 4, None, 0.0), ("j", 2, None, 2, None), ("j", 3, None, 3, None)], "job string, at long, total long, done long, started double")
    log.write.json(str(tmp_path / "in"))
    q = jobs.latest(spark.readStream.schema(log.schema).json(str(tmp_path / "in"))).writeStream.format("memory").queryName("jobs").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).start()
    try:
        q.processAllAvailable()
        assert [tuple(r) for r in spark.table("jobs").select("job", "total", "done").collect()] == [("j", 4, 3)]
    finally:
        q.stop()
    x = spark.createDataFrame([(10.0, 2, 6, 14.0), (0.0, 0, 3, 0.0)], "started double, done int, total int, done_at double")
    assert [r[0] for r in x.select(jobs.seconds_left(F.lit(15.0))).collect()] == [7, None]


def test_ids_take_the_first_free_number(spark):
    """Against a plain loop in order of path: numbered stems in the way, before and after, and ids of those that had to move."""
    r = random.Random(9)
    for _ in range(3):
        names = ["x", "x_2", "x_3", "x_2_2", "y", "Y", "y_10", "z", "x_02", "w_1"]
        paths = sorted({f"/{r.randrange(40):02d}/{r.choice(names)}.wav" for _ in range(60)}) + ["/a/x.wav", "/b/x.wav", "/c/x_2.wav"]
        got = {x["path"]: x["id"] for x in scans.with_ids(spark.createDataFrame([(p, 1) for p in paths], "path string, size int")).collect()}
        taken = set()
        for p in sorted(paths):
            base = p.split("/")[-1].removesuffix(".wav").lower()
            name, k = base, 1
            while name in taken:
                k += 1
                name = f"{base}_{k}"
            taken.add(name)
            assert got[p] == name
        assert len(taken) == len(paths)


def test_samples_of_any_width():
    import io
    import wave

    for width, values in ((1, [0, 128, 255]), (2, [-32768, 0, 16384]), (3, [-(2**23), 0, 2**22, -1]), (4, [-(2**31), 0, 2**30])):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(width)
            w.setframerate(8000)
            w.writeframes(b"".join(v.to_bytes(width, "little", signed=width > 1) for v in values))
        x, rate = signal.read_wav(out.getvalue())
        want = [(v - 128) / 128 if width == 1 else v / 2 ** (8 * width - 1) for v in values]
        assert np.allclose(x, want, atol=1e-6) and rate == 8000 and signal.duration_of(out.getvalue()) == len(values) / 8000


def test_speech_chunks(spark):
    long = "một hai ba, bốn năm sáu, bảy tám chín, mười một. hai? ba. bốn"
    df = spark.createDataFrame([(long,), ("a.\x00 ,, \x00b? c? d",), ("!!",), ("",)], "t string")
    got = [r[0] for r in df.select(text.speech_chunks(F.col("t"), 30)).collect()]
    assert got[0] == ["một hai ba, bốn năm sáu,", "bảy tám chín,", "mười một. hai. ba. bốn"] and all(len(c.encode()) <= 45 for c in got[0])
    assert got[1:] == [["a.", "b. c. d"], ["!!"], [""]]
    figures = ", ".join(str(n) for n in range(12))
    r = spark.createDataFrame([(figures, " a ; b ")], "t string, u string").select(text.speech_chunks(F.col("t"), 10, F.trim), text.packed(F.split("u", ";"), 10)).first()
    assert " ".join(r[0]) == figures and r[1] == ["a b"]


def test_discovery_takes_the_first_that_is_given(spark, tmp_path):
    for n in ("a.wav", "b.wav"):
        (tmp_path / n).write_bytes(b"x")
    got = lambda **k: [r["id"] for r in scans.discover(spark, **k).orderBy("path").collect()]
    a, folder = f"{tmp_path}/a.wav", str(tmp_path)
    assert got(folder=folder) == ["a", "b"] and got(paths=[a], folder=folder) == ["a"] and got(override=[f"{tmp_path}/b.wav"], paths=[a]) == ["b"] and got(path=a) == ["a"]
    with pytest.raises(ValueError):
        scans.discover(spark)


def test_selection_is_that_of_sorted_values(spark):
    from cliploom.operators import selection

    r, points = random.Random(1), (0.0, 0.08, 0.1, 0.5, 0.92, 1.0)
    rows = [(k, r.choice([0.0, -0.0, 1.5, -2.25, 1e300, -1e-300, r.gauss(0, 1), r.gauss(0, 1), None])) for k in ("a", "b", None) for _ in range(500)] + [("c", 3.0), ("d", None)]
    df, values = spark.createDataFrame(rows, "k string, v double"), {k: np.sort([v for q, v in rows if q == k and v is not None]) for k in ("a", "b", None, "c")}
    got = {(x["k"], x["p"]): x["value"] for x in selection.percentiles(df, ["k"], "v", points).collect()}
    assert got.keys() == {(k, p) for k in values for p in points} and all(np.isclose(got[k, p], np.percentile(v, 100 * p), rtol=1e-12) for k, v in values.items() for p in points)
    near = {(x["k"], x["p"]): x["value"] for x in selection.nearest_ranks(df, ["k"], "v", points).collect()}
    assert near == {(k, p): v[round(p * (len(v) - 1))] for k, v in values.items() for p in points}
    for most in (10, 1000):
        assert {x["k"]: x["median"] for x in selection.medians(df, ["k"], "v", most).collect()} == {k: np.median(v) for k, v in values.items()}


def test_many_values_of_a_key_lie_over_many_tasks(spark):
    """100,000 distinct durations: the ordered step of a round has some thousand counts, not all values."""
    from cliploom.operators import selection

    df = spark.range(100_000).select((F.col("id") * 0.00015).alias("v")).repartition(4)
    out = selection.nearest_ranks(df, [], "v", (0.5,))
    assert out.first()["value"] == 50_000 * 0.00015
    first_digits = df.select(F.shiftrightunsigned(selection.sortable(F.col("v")), 42).alias("d")).distinct().count()
    assert 1000 < first_digits < 20_000


def test_pointers_equal_the_folds(spark, monkeypatch):
    from cliploom.operators import jumps

    monkeypatch.setattr(jumps, "FAN", 4)
    r = random.Random(9)
    spans = [(k, b := r.randrange(0, 40_000) / 10, b + r.choice([0.2, 0.4, 0.8, 3.0])) for k in (1, 2, 3, 4) for _ in range(400 if k < 3 else 3)]
    s = spark.createDataFrame(spans, "source_id long, s double, e double")
    t = spark.createDataFrame([(1, 4100.0), (2, 4003.0), (3, 4000.0), (4, 10.0), (5, 7.0)], "source_id long, total double")
    want = sorted(map(tuple, grouping.chunk_bounds(s, t).collect()))
    assert sorted(map(tuple, grouping.chunk_bounds(s, t, most=2).collect())) == want
    mid = s.where("e - s >= 0.4").select("source_id", ((F.col("s") + F.col("e")) / 2).alias("t"))
    assert sorted(map(tuple, grouping.pointed_bounds(mid, t, 20.0, width=90.0).collect())) == [w for w in want if w[0] < 5]
    pieces = [(k, o * 3, r.choice(["", " "]) + "aé"[r.randrange(2)] * r.choice([0, 1, 2, 5, 9, 30])) for k in (1, 2, 3) for o in range(300 if k < 3 else 1)]
    p = spark.createDataFrame(pieces, "source_id long, ord long, text string")
    want = sorted(map(tuple, grouping.pack_bytes(p, 20).collect()))
    assert want and sorted(map(tuple, grouping.pack_bytes(p, 20, most=2).collect())) == want
    clean = p.select(F.col("source_id").alias("k"), F.col("ord").alias("o"), F.trim("text").alias("t")).where("t <> ''")
    assert sorted(map(tuple, grouping.pointed_packs(clean, 20, width=64.0, chunk=16).collect())) == want


def test_one_source_of_a_million(spark):
    """All silences of one source: the same bounds as a plain loop."""
    s = spark.range(1_000_000).select(F.lit(1).cast("long").alias("source_id"), (F.col("id") * 3 + F.col("id") % 7).cast("double").alias("s")).withColumn("e", F.col("s") + 1)
    got = sorted((x["n"], x["bound"]) for x in grouping.chunk_bounds(s, spark.createDataFrame([(1, 3_000_010.0)], "source_id long, total double")).collect())
    want = [0.0]
    for t in sorted(i * 3 + i % 7 + 0.5 for i in range(1_000_000)):
        if t - want[-1] >= 20:
            want.append(t)
    want = [*want[:-1], 3_000_010.0] if 3_000_010.0 - want[-1] < 10 else [*want, 3_000_010.0]
    assert [b for _, b in got] == want and [n for n, _ in got] == list(range(len(want)))


def test_packing_takes_time_of_its_length(spark):
    df = spark.createDataFrame([("a, b. " * 200_000,)], "t string")
    got = df.select(F.posexplode(text.speech_chunks(F.col("t"), 230)).alias("n", "c")).agg(F.count("*"), F.max(F.octet_length("c"))).first()
    assert got == (-(-200_000 // 38), 38 * 6 - 1)


def test_align_reads_and_searches(spark):
    """A clip whose greedy path is its tokens is read off its frames, another one searched; both as the best path of the whole clip."""
    r = np.random.default_rng(6)
    scores = {k: r.normal(0, 2, (60, 5)) for k in (1, 2, 3)}
    f = spark.createDataFrame([(k, 2 * i + 7, x.tolist()) for k, m in scores.items() for i, x in enumerate(m)], "clip long, frame long, scores array<double>")
    heard = {k: [c for i, c in enumerate(m.argmax(1).tolist()) if c and (not i or m[i - 1].argmax() != c)] for k, m in scores.items()}
    for tokens in ({1: heard[1], 3: heard[3]}, {1: heard[1], 2: [1, 2, 2, 4], 3: [1] * 60}):
        t = spark.createDataFrame(list(tokens.items()), "clip long, tokens array<long>")
        got = sorted(tuple(x) for x in ctc.align(f, t).collect())
        logp = {k: m - np.log(np.exp(m).sum(1, keepdims=True)) for k, m in scores.items()}
        spans = {k: ctc.viterbi(logp[k], np.array(x)) for k, x in tokens.items()}
        want = sorted((k, i, int(a), int(b), s) for k, v in spans.items() if v is not None for i, (a, b, s) in enumerate(v))
        assert [x[:4] for x in got] == [x[:4] for x in want] and [x[4] for x in got] == pytest.approx([x[4] for x in want])
        assert {x[0] for x in got} == set(tokens) - {k for k, x in tokens.items() if len(x) == 60}


def seconds(df, column):
    """The least time of three runs over rows that lie in memory."""
    def once():
        t = time.perf_counter()
        df.select(column.alias("x")).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    return min(once() for _ in range(3))


def plain_texts(spark):
    df = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("những lời nói plain words here "), 1000).alias("t")).cache()
    df.count()
    return df


def test_texts_without_a_sign_take_no_pass_for_it(spark):
    """A dozen patterns that cannot match cost less than eight passes of one (before: 18.8)."""
    df = plain_texts(spark)
    assert seconds(df, F.length(text.prepare_speech(F.col("t")))) < 8 * seconds(df, F.length(F.regexp_replace("t", "[0-9]", "")))


def test_commas_and_lines_of_speech_text(spark):
    """Commas that stand right beside those that do not, blanks of every kind, and blanks on both sides of lines."""
    given = ["a, b ,c ,\xa0d,, e, ", "a \t\n \r\n　b\n\n", " ,a , . b, ? c,!", "a  b\tc", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in given], "t string").select(text.prepare_speech(F.col("t"))).collect()]
    assert got == ["a, b, c, d, e", "a\x00b\x00", "a. b? c.", "a b c", None]


def test_reading_takes_no_pass_for_forms_that_a_text_lacks(spark):
    """Texts with neither digits nor signs; a column of the helper's name stays, and odd letters of keys are seen."""
    df = plain_texts(spark).limit(100).cache()
    df.count()
    one, forms = seconds(df, F.length(F.regexp_replace("t", "[0-9]", ""))), reading.Forms()
    passes = [F.when(forms.may_match(name, F.col("t"), F.lit(False)), F.length(F.regexp_replace("t", head + flags + form, ""))) for name, head, flags, form, _, _ in forms.steps if name != "acronym"]
    assert seconds(df, F.array(*passes)) < 8 * one
    rows = [("Tſ. An, PGS. Kim ở q. 1", "x"), ("CHƯƠNG IV", "y"), ("số ５", "z")]
    got = reading.read_aloud(spark.createDataFrame(rows, "t string, SAID_has_digit string"), "t", "said").collect()
    assert [r["said"] for r in got] == [Reader()(t) for t, _ in rows] and [r["SAID_has_digit"] for r in got] == ["x", "y", "z"]
