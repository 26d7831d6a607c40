"""Views that give the fixture tables the shapes that the operators work on, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What is added to the doc_id of a document for its further clip.
FURTHER = 1_000_000_000_000


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clip a document, with its whole text, and further ones with shared or empty texts; numbers that a recogniser would give are functions of the
    id and the labels."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("idx", F.col("doc_id"))
    i = F.col("doc_id")
    shared = F.concat(F.lit("Shared phrase number "), (i % 35).cast("string"), F.lit(" of the set"))
    d = d.unionByName(d.where((i % 5 == 0) | (i % 97 == 1)).withColumns({"text": F.when(i % 97 == 1, "").otherwise(shared), "idx": i + FURTHER}))
    return d.select(
        F.col("source").alias("source_id"), "idx", "text",
        (F.length("text").cast("double") / (2 + i % 30)).alias("duration"),
        F.when(F.col("toxic") == 1, 0.01).otherwise(0.0).alias("clip_ratio"),
        (5 + i * 13 % 40).cast("double").alias("snr_db"),
        F.coalesce(0.5 + 0.3 * F.col("quality"), F.lit(1.0)).alias("asr_prob"),
        ((i % 17).cast("double") / 16).alias("min_word_prob"),
        ((i % 11).cast("double") / 10).alias("ctc_score"),
        ((i % 13).cast("double") / 10).alias("completeness"),
        ((i % 7).cast("double") / 7).alias("no_speech_prob"),
    )


CLIPS_SQL = f"""
    labelled as (select source as source_id, d.doc_id as i, quality, toxic, text from documents d left join labels l on d.doc_id = l.doc_id),
    clip0 as (
        select *, i as idx from labelled union all
        select source_id, i, quality, toxic, case when i % 97 = 1 then '' else 'Shared phrase number ' || (i % 35) || ' of the set' end, i + {FURTHER} from labelled where i % 5 = 0 or i % 97 = 1
    ),
    clips as (
        select source_id, idx, text, length(text)::double / (2 + i % 30) as duration,
            case when toxic = 1 then 0.01::double else 0.0::double end as clip_ratio, (5 + i * 13 % 40)::double as snr_db,
            coalesce(0.5::double + 0.3::double * quality, 1.0::double) as asr_prob, (i % 17)::double / 16 as min_word_prob,
            (i % 11)::double / 10 as ctc_score, (i % 13)::double / 10 as completeness, (i % 7)::double / 7 as no_speech_prob
        from clip0
    )"""


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as intervals of a source: errors are silences, all else words."""
    e = table(spark, sf_dir, "events")
    s = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 100_000_000).cast("double")
    return e.select(F.col("user_id").alias("source_id"), F.col("event_id").alias("ord"), (F.col("event_type") == "error").alias("is_sil"), F.col("event_type").alias("text"), s.alias("s"), (s + 8 * F.col("value")).alias("e"), F.col("value").alias("v"))


INTERVALS_SQL = """
    iv0 as (select *, floor(epoch_us(ts) / 100000000)::double as s from events),
    iv as (select user_id as source_id, event_id as ord, event_type = 'error' as is_sil, event_type as text, s, s + 8 * value as e, value as v from iv0)"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A level every frame of one source."""
    return table(spark, sf_dir, "events").select(F.lit("s").alias("source_id"), F.col("event_id").alias("frame"), F.col("value").alias("level"))


def emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as frames of scores: a clip for each label, class 0 the blank."""
    return table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("clip"), F.col("vec_id").alias("frame"), F.col("embedding").alias("scores"))


def asr_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as a recogniser's segments, whole texts: a third of them without a list of words, some numbers missing, all kinds of white space at ends, some words of nothing else."""
    c = table(spark, sf_dir, "conversations")
    at = F.col("turn") * 1000.0
    word = lambda w, i: F.struct(
        F.when(i % 11 == 5, F.lit("\n")).when(i % 11 == 7, F.concat(F.lit("\t"), w, F.lit("\u00a0\n"))).otherwise(w).alias("word"), F.when(i % 7 != 3, at + i * 2.5).alias("s"), F.when(i % 7 != 3, at + i * 2.5 + 1 + i % 3).alias("e"), F.when(i % 5 != 0, (i % 8).cast("double") / 8).alias("prob"))
    words = F.when(F.col("turn") % 3 != 1, F.transform(F.split("text", " "), word))
    return c.select(F.col("conv_id").alias("source_id"), F.col("turn").alias("seg"), at.alias("s"), (at + 900).alias("e"), F.concat(F.lit("\t "), "text", F.lit(" \r\n\u00a0")).alias("text"), F.when(F.col("turn") % 4 != 0, (F.col("turn") % 5).cast("double") / 5).alias("no_speech_prob"), F.lit(None).cast("double").alias("avg_logprob"), words.alias("words"))


_ENDS = r"^[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$"
ASR_SQL = f"""
    asr as (select conv_id as source_id, turn as seg, turn * 1000::double as s, turn * 1000::double + 900 as e, regexp_replace(text, '{_ENDS}', '', 'g') as text, text as t0, coalesce(case when turn % 4 <> 0 then (turn % 5)::double / 5 end, 0) as no_speech_prob, turn % 3 <> 1 as listed from conversations),
    listed as (select source_id, seg, s as s0, e as e0, unnest(string_split(t0, ' ')) as w0, unnest(range(len(string_split(t0, ' ')))) as i from asr where listed),
    stripped as (select *, case when i % 11 = 5 then '' else regexp_replace(w0, '{_ENDS}', '', 'g') end as word from listed),
    flat as (
        select source_id, seg * 1048576 + i as ord, seg, word as text, case when i % 5 <> 0 then (i % 8)::double / 8 else 1 end as prob,
            case when i % 7 <> 3 then s0 + i * 2.5::double else s0 end as s, case when i % 7 <> 3 then s0 + i * 2.5::double + 1 + i % 3 else e0 end as e from stripped where word <> ''
        union all select source_id, seg * 1048576, seg, text, 1, s, e from asr where not listed and text <> ''
    )"""


def blocks(spark: SparkSession, sf_dir: str, sources: int, rate: int, length: int) -> DataFrame:
    """Event values as the samples of so many recordings, in blocks of `length`."""
    e = table(spark, sf_dir, "events").select((F.col("event_id") % sources).cast("string").alias("source_id"), F.floor(F.col("event_id") / sources).alias("i"), ((F.col("value") - 50) / 512).cast("float").alias("x"))
    b = e.groupBy("source_id", F.floor(F.col("i") / length).alias("block")).agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("s"))
    total = e.groupBy("source_id").agg(F.count("*").alias("total"))
    return b.join(total, "source_id").select("source_id", F.lit(rate).alias("rate"), "total", "block", (F.col("block") * length).alias("first"), F.col("s.x").alias("samples"))


def blocks_sql(sources: int) -> str:
    return f"""
    wave as (select (event_id % {sources})::varchar as source_id, event_id // {sources} as i, ((value - 50) / 512)::float::double as x from events),
    totals as (select source_id, count(*) as total from wave group by 1)"""


#: Seconds of a frame, and frames of silence before each turn, of the spoken fixture; every fifth turn has no frames.
STEP, SILENT = 0.02, 300
SPOKEN_VOCAB = {c: k for k, c in enumerate("_|abcdefghijklmnopqrstuvwxyz")}


def spoken(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Turns as if read letter by letter, a letter or a gap between words every other frame: words with times that are somewhat late, frames of scores, bounds in the middle of silences."""
    of = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("source_id"), "turn", "text", (F.lit(2) * F.greatest(F.lit(0), F.length(F.array_join(of, "|")))).alias("n"))
    order = Window.partitionBy("source_id").orderBy("turn")
    c = c.withColumns({"seg": F.row_number().over(order) - 1, "at": F.sum(F.col("n") + SILENT).over(order) - F.col("n")})
    c = c.select("source_id", "n", "seg", "at", of.alias("w"))  # only here: the text is what is dealt by source, not its list of words
    places = F.aggregate("w", F.array(F.lit(0)), lambda p, x: F.array_append(p, F.element_at(p, -1) + F.length(x) + 1))  # of each word in the text, and one past the last
    one = c.select("source_id", "seg", "at", F.posexplode(F.arrays_zip(F.col("w").alias("text"), places.alias("before"))).alias("k", "x")).select("source_id", "seg", "at", "k", "x.*").where("text is not null")
    begin = F.col("at") + 2 * F.col("before")
    words = one.select("source_id", F.col("seg").cast("long").alias("seg"), (F.col("seg") * 1_000_000 + F.col("k")).alias("ord"), "text", (begin * STEP + 0.3).alias("s"), ((begin + 2 * F.length("text") - 1) * STEP + 0.4).alias("e"))
    said = F.concat(F.array_repeat(F.lit("_"), 20), F.flatten(F.transform(F.filter(F.split(F.array_join("w", "|"), ""), lambda x: x != ""), lambda x: F.array(x, F.lit("_")))))
    f = c.where("seg % 5 <> 3").select("source_id", "at", F.posexplode(said).alias("k", "c"))
    # The scores of each class are a constant, looked up by its place.
    rows = F.expr("array(" + ", ".join("array(" + ", ".join("10f" if x == y else "0f" for y in SPOKEN_VOCAB) + ")" for x in SPOKEN_VOCAB) + ")")
    scores = F.element_at(rows, F.array_position(F.array(*[F.lit(x) for x in SPOKEN_VOCAB]), F.col("c")).cast("int"))
    frames = f.select("source_id", ((F.col("at") + F.col("k") - 20) * STEP).alias("t"), scores.alias("scores"))
    left = c.select("source_id", F.col("seg").cast("long").alias("n"), F.when(F.col("seg") == 0, 0.0).otherwise((F.col("at") - SILENT / 2) * STEP).alias("bound"))
    last = c.groupBy("source_id").agg(F.count("*").alias("n"), (F.max(F.col("at") + F.col("n")) * STEP + 1).alias("bound"))
    return words, frames, left.unionByName(last)


SPOKEN_SQL = f"""
    turns as (select conv_id as source_id, turn, regexp_extract_all(lower(text), '[a-z]+') as w from conversations),
    sized as (select *, 2 * length(array_to_string(w, '|')) as n from turns),
    placed as (select *, row_number() over o - 1 as seg, sum(n + {SILENT}) over o - n as begins from sized window o as (partition by source_id order by turn)),
    spoken as (select source_id, seg, k, w[k + 1] as text, begins + 2 * case when k > 0 then length(array_to_string(w[1:k], '|')) + 1 else 0 end as begin from placed, unnest(range(len(w))) u(k))"""
