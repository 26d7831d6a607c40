"""Registered queries over the fixture tables and the SQL that must give the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import reading, signal, text
from ..functions.text import basename
from ..operators import alignment, ctc, edits, frames, grouping, intervals, quality, rollup, transcripts
from ..sources import scans, sinks, wav_blocks
from ..streaming import jobs
from . import fixtures
from .fixtures import ASR_SQL, CLIPS_SQL, INTERVALS_SQL, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


RULES_SQL = CLIPS_SQL + """,
    rated as (select *, case when duration > 0 then length(text) / duration end as rate from clips),
    ruled as (
        select *, list_filter([
            case when duration < 1.5::double then 'duration_too_short' end, case when duration > 12 then 'duration_too_long' end,
            case when length(text) < 4 then 'text_too_short' end, case when rate < 4 then 'speech_rate_low' end, case when rate > 28 then 'speech_rate_high' end,
            case when clip_ratio > 0.005::double then 'clipping' end, case when snr_db < 10 then 'low_snr' end, case when asr_prob < 0.55::double then 'low_asr_confidence' end,
            case when ctc_score < 0.6::double then 'text_audio_mismatch' end, case when completeness < 0.8::double then 'text_incomplete' end,
            case when no_speech_prob > 0.5::double and ctc_score < 0.75::double then 'no_speech' end, case when text = '' then 'empty_text' end], lambda x: x is not null) as reasons0
        from rated
    ),
    marked as (
        select *, coalesce(sum(case when len(reasons0) = 0 then 1 else 0 end) over (partition by source_id, lower(text) order by idx rows between unbounded preceding and 1 preceding), 0) > 0 and text <> '' as dup from ruled
    ),
    reviewed as (select *, case when dup then list_append(reasons0, 'duplicate_text') else reasons0 end as reasons, len(reasons0) = 0 and not dup as accepted from marked)"""


def _reviewed(spark, sf_dir):
    return quality.review(fixtures.clips(spark, sf_dir))


@query(f"with {RULES_SQL} select source_id, idx, array_to_string(reasons, ',') as reasons, accepted from reviewed")
def qc_reasons(spark, sf_dir):
    return _reviewed(spark, sf_dir).select("source_id", "idx", F.array_join("reasons", ",").alias("reasons"), "accepted")


@query(f"with {RULES_SQL} select source_id, count(*) as total, count(*) filter (accepted) as n_accepted, count(*) filter (not accepted) as n_rejected, count(*) filter (dup) as n_duplicate from reviewed group by source_id")
def qc_funnel(spark, sf_dir):
    return quality.funnel(_reviewed(spark, sf_dir))


@query(f"with {RULES_SQL} select source_id, idx from reviewed where dup")
def qc_dedup(spark, sf_dir):
    return _reviewed(spark, sf_dir).where(F.array_contains("reasons", "duplicate_text")).select("source_id", "idx")


@query(f"""with {RULES_SQL}, x as (select idx, unnest(reasons) as reason, generate_subscripts(reasons, 1) - 1 as pos from reviewed)
    select reason, count(*) as n, min(idx) as first_idx, arg_min(pos, idx * 100 + pos)::bigint as first_pos from x group by reason""")
def reason_histogram(spark, sf_dir):
    return quality.reason_histogram(_reviewed(spark, sf_dir))


@query(f"with {RULES_SQL}, x as (select unnest(reasons) as reason from reviewed) select reason, count(*) as n from x group by reason")
def merged_histogram(spark, sf_dir):
    r = _reviewed(spark, sf_dir).select("source_id", F.explode("reasons").alias("reason")).groupBy("source_id", "reason").agg(F.count("*").alias("n"))
    return quality.merge_histograms(r)


@query(f"""with {RULES_SQL}, s as (select distinct source_id from clips)
    select s.source_id, count(r.idx) as clips, coalesce(sum(floor(r.duration * 1000 + 0.5)), 0)::bigint as ms from s left join reviewed r on r.source_id = s.source_id and accepted group by 1""")
def source_rollup(spark, sf_dir):
    r = _reviewed(spark, sf_dir)
    return rollup.source_rollup(r.where("accepted"), fixtures.clips(spark, sf_dir))


@query("""with v as (select l_extendedprice as x, row_number() over (order by l_extendedprice) as k, count(*) over () as n from lineitem),
    p as (select unnest([0.0, 0.1, 0.5, 0.9, 1.0])::double as p) select p, x as value from p join v on k = round_even(p * (n - 1), 0) + 1""")
def nearest_rank_percentiles(spark, sf_dir):
    return rollup.nearest_rank(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query("select count(*) as n, floor((quantile_cont(value, 0.92::double) - quantile_cont(value, 0.08::double)) * 1e3 + 0.5) / 1e3 as spread from events")
def linear_spread(spark, sf_dir):
    return rollup.linear_spread(table(spark, sf_dir, "events"), "value").select("n", (F.floor(F.col("spread") * 1e3 + 0.5) / 1e3).alias("spread"))


@query(f"""with {RULES_SQL}, a as (select idx, row_number() over (order by md5('1234|' || idx), idx) as r, count(*) over () as n from reviewed where accepted)
    select idx, case when r <= least(least(100, greatest(1, floor(n * 0.02::double))), greatest(0, n - 1)) then 'val' else 'train' end as part from a""")
def split_train_val(spark, sf_dir):
    return rollup.split(_reviewed(spark, sf_dir).where("accepted"), "idx").select("idx", "part")


EDITS_SQL = CLIPS_SQL + """,
    c as (select *, source_id || '/' || idx || '.wav' as wav from clips),
    e as (select case when idx % 50 = 7 then 'gone' || idx || '.wav' else idx || '.wav' end as name, duration + (idx % 4) * 0.03::double as duration, case idx % 3 when 0 then text when 1 then '' else 'Edited ' || idx end as text from clips),
    j as (select name, e.duration, e.text, c.idx, case when c.idx is null then 'unmatched' when abs(c.duration - e.duration) > 0.05::double then 'mismatched' when e.text = '' or e.text = c.text then 'unchanged' else 'applied' end as outcome from e left join c on name = c.idx || '.wav')"""


def _edits(spark, sf_dir):
    c = fixtures.clips(spark, sf_dir)
    i = F.col("idx")
    wav = F.concat(i.cast("string"), F.lit(".wav"))
    e = c.select(F.when(i % 50 == 7, F.concat(F.lit("gone"), wav)).otherwise(wav).alias("name"), (F.col("duration") + (i % 4) * 0.03).alias("duration"), F.when(i % 3 == 0, F.col("text")).when(i % 3 == 1, "").otherwise(F.concat(F.lit("Edited "), i.cast("string"))).alias("text"))
    return e, c.withColumn("wav", F.concat("source_id", F.lit("/"), wav))


@query(f"with {EDITS_SQL} select c.idx, case when outcome = 'applied' then j.text else c.text end as text, case when outcome = 'applied' then 'manual' end as text_source, case when outcome = 'applied' then 1 else c.ctc_score end as ctc_score, case when outcome = 'applied' then 1 else c.completeness end as completeness from c left join j on j.idx = c.idx")
def edit_upsert(spark, sf_dir):
    return edits.apply(*_edits(spark, sf_dir)).select("idx", "text", "text_source", "ctc_score", "completeness")


@query(f"with {EDITS_SQL} select outcome, count(*) as n from j group by outcome")
def edit_outcomes(spark, sf_dir):
    return edits.outcome(*_edits(spark, sf_dir)).groupBy("outcome").agg(F.count("*").alias("n"))


@query(f"""with {CLIPS_SQL}, s as (select idx, ctc_score as old, completeness as old_full, (idx * 7 % 11)::double / 10 as new, (idx * 5 % 13)::double / 10 as new_full from clips)
    select idx, case when old >= 0.8::double and old_full >= 0.9::double then 'kept' when new > old + 0.05::double then 'by_score'
        when abs(1 - new_full) + 0.05::double < abs(1 - old_full) and new > old - 0.05::double then 'by_completeness' else 'tried' end as decision from s""")
def rescore_decision(spark, sf_dir):
    i = F.col("idx")
    c = fixtures.clips(spark, sf_dir).withColumns({"new_score": (i * 7 % 11).cast("double") / 10, "new_completeness": (i * 5 % 13).cast("double") / 10})
    return quality.rescore(c).select("idx", "decision")


@query(f"with {CLIPS_SQL} select idx, coalesce(nullif(case when idx % 3 = 0 then '' when idx % 3 = 1 then 'refined ' || idx end, ''), nullif(case when idx % 2 = 0 then 'again ' || idx end, ''), text) as text from clips")
def text_choice(spark, sf_dir):
    i = F.col("idx")
    c = fixtures.clips(spark, sf_dir).select("idx", F.col("text").alias("raw_text"), F.when(i % 3 == 0, "").when(i % 3 == 1, F.concat(F.lit("refined "), i.cast("string"))).alias("refined_text"), F.when(i % 2 == 0, F.concat(F.lit("again "), i.cast("string"))).alias("rescored_text"))
    return c.select("idx", quality.chosen_text().alias("text"))


def _words(spark, sf_dir):
    return fixtures.intervals(spark, sf_dir).where("not is_sil").select("source_id", "ord", "s", "e", "text", "v")


def _silences(spark, sf_dir):
    return fixtures.intervals(spark, sf_dir).where("is_sil").select("source_id", "ord", "s", "e")


def _totals(spark, sf_dir):
    return fixtures.intervals(spark, sf_dir).groupBy("source_id").agg(F.max("e").alias("total"))


def _named(words):
    return words.withColumnsRenamed({"s": "rs", "e": "re", "ord": "rord"})


@query(f"""with {INTERVALS_SQL}, w as (select *, row_number() over (partition by source_id order by s, e, ord) as k from iv where not is_sil),
    g as (select *, max(case when k = 1 then e else greatest(s, e) end) over (partition by source_id order by s, e, ord rows unbounded preceding) as e2 from w)
    select source_id, ord, greatest(s, coalesce(lag(e2) over (partition by source_id order by s, e, ord), s)) as s2, e2 from g""")
def overlap_repair(spark, sf_dir):
    return intervals.overlap_repair(_words(spark, sf_dir)).select("source_id", "ord", "s2", "e2")


@query(f"""with {INTERVALS_SQL}, r as (select * from iv where not is_sil), t as (select source_id, max(e) + 5 as total from iv group by 1),
    g as (select source_id, greatest(0, coalesce(max(e) over (partition by source_id order by ord rows between unbounded preceding and 1 preceding), 0)) as s, s as e from r
        union all select t.source_id, greatest(0, coalesce(max(r.e), 0)), any_value(total) from t left join r on r.source_id = t.source_id group by t.source_id)
    select * from g where e - s >= 0.05::double""")
def interval_complement(spark, sf_dir):
    return intervals.complement(_words(spark, sf_dir), _totals(spark, sf_dir).withColumn("total", F.col("total") + 5))


@query("""with q as (select event_id as frame, event_id - row_number() over (order by event_id) as g from events where value < 20)
    , i as (select min(frame) as lo, max(frame) + 1 as hi from q group by g)
    select 's' as source_id, lo, hi, floor(lo * 0.01::double * 1e4 + 0.5) / 1e4 as s, floor(hi * 0.01::double * 1e4 + 0.5) / 1e4 as e from i where hi * 0.01::double - lo * 0.01::double >= 0.03::double""")
def silence_islands(spark, sf_dir):
    return intervals.islands(fixtures.frames(spark, sf_dir), F.col("level") < 20, step=0.01, min_length=0.03)


@query("select 's' as source_id, floor((coalesce(median(case when event_id % 3 = 0 then value end), median(value)) - 25) * 1e3 + 0.5) / 1e3 as threshold from events")
def reference_level(spark, sf_dir):
    f = fixtures.frames(spark, sf_dir).withColumn("inside", F.col("frame") % 3 == 0)
    return intervals.reference_level(f).select("source_id", (F.floor(F.col("threshold") * 1e3 + 0.5) / 1e3).alias("threshold"))


@query(f"""with {INTERVALS_SQL}, r as (select source_id, ord, s, e, e - s as len, (e - 5) - (s + 5) as kept from iv where is_sil),
    b as (select *, coalesce(sum(kept) over (partition by source_id order by len desc, ord rows between unbounded preceding and 1 preceding), 0) as before from r where len >= 30 and kept >= 10)
    select source_id, ord, s + 5 as s, e - 5 as e from b where before < 3000""")
def noise_budget(spark, sf_dir):
    return intervals.noise_budget(_silences(spark, sf_dir), budget=3000, min_length=30, trim=5, min_trimmed=10)


@query(f"""with {INTERVALS_SQL}, f as (select user_id as source_id, event_id as frame, floor(epoch_us(ts) / 100000000)::bigint // 2 as k from events)
    select source_id, frame from f where exists (select 1 from iv where is_sil and iv.source_id = f.source_id and f.k >= trunc(iv.s / 2) and f.k < ceil(iv.e / 2))""")
def frames_in_speech(spark, sf_dir):
    x = fixtures.intervals(spark, sf_dir)
    f = x.select("source_id", F.col("ord"), F.floor(F.col("s") / 2).alias("frame"))
    return intervals.frames_in_speech(f, x.where("is_sil"), step=2.0).select("source_id", F.col("ord").alias("frame"))


RATES_SQL = INTERVALS_SQL + """,
    w as (select *, (e - s) / greatest(length(trim(text, '.,!?…;:"'')]}»')), 1) as rate from iv where not is_sil),
    lim as (select source_id, greatest(0.12::double, median(rate) * 0.5::double) as lim from w group by 1),
    cuts as (select x.source_id, ord, (s + e) / 2 as time, least((s + e) / 2, s + 0.08::double) as before, greatest((s + e) / 2, e - 0.08::double) as after, e - s as length
        from iv x join lim on lim.source_id = x.source_id where is_sil and e > s and not exists (
            select 1 from w where w.source_id = x.source_id and w.s < x.e and w.e > x.s and (least(w.e, x.e) - greatest(w.s, x.s)) / (x.e - x.s) >= 0.5::double and w.rate >= lim))"""


def _cuts(spark, sf_dir):
    w = _named(_words(spark, sf_dir))
    return intervals.cut_points(_silences(spark, sf_dir), w, intervals.rate_limits(w, factor=0.5), most=0.5, width=4000.0)


@query(f"with {RATES_SQL} select source_id, ord, time, before, after, length from cuts")
def cut_anti_join(spark, sf_dir):
    return _cuts(spark, sf_dir)


@query(f"with {RATES_SQL} select source_id, floor(lim * 1e3 + 0.5) / 1e3 as lim from lim")
def word_rate_limit(spark, sf_dir):
    return intervals.rate_limits(_named(_words(spark, sf_dir)), factor=0.5).select("source_id", (F.floor(F.col("limit") * 1e3 + 0.5) / 1e3).alias("lim"))


@query(f"""with {INTERVALS_SQL}, p as (select x.source_id, x.ord, any_value(x.e - x.s) as len, coalesce(sum(least(w.e, x.e) - greatest(w.s, x.s)) filter (w.s is not null), 0) as covered
        from iv x left join iv w on not w.is_sil and w.source_id = x.source_id and w.s < x.e and w.e > x.s where x.is_sil group by 1, 2)
    select source_id, count(*) as n_targets, count(*) filter (covered / len < 0.2::double) as n_clean from p group by 1""")
def silence_coverage(spark, sf_dir):
    return intervals.silence_coverage(_silences(spark, sf_dir), _named(_words(spark, sf_dir)), width=4000.0)


ASSIGN_SQL = RATES_SQL + """,
    t as (select source_id, s, e, ord, 0 as cut, (s + e) / 2 as mid, text, v from iv where not is_sil union all select source_id, null, null, ord, 1, time, null, null from cuts),
    a as (select *, sum(cut) over (partition by source_id order by mid, cut desc, ord rows unbounded preceding)::bigint as block from t),
    assigned as (select source_id, ord, s, e, text, v, block from a where cut = 0)"""


@query(f"with {ASSIGN_SQL} select source_id, ord, block from assigned")
def midpoint_assign(spark, sf_dir):
    return intervals.assign_blocks(_words(spark, sf_dir), _cuts(spark, sf_dir), chunk=100_000.0).select("source_id", "ord", "block")


@query(f"""with recursive {INTERVALS_SQL}, tot as (select source_id, max(e) as total from iv group by 1),
    m as (select source_id, (s + e) / 2 as t from iv where is_sil and e - s >= 100),
    b as (select source_id, 0 as n, 0::double as bound from tot
        union all select b.source_id, b.n + 1, (select min(t) from m where m.source_id = b.source_id and t - b.bound >= 20000) from b where exists (select 1 from m where m.source_id = b.source_id and t - b.bound >= 20000)),
    l as (select b.source_id, max(n) as top, max(bound) as last, any_value(total) as total from b join tot on tot.source_id = b.source_id group by 1)
    select b.source_id, b.n::bigint as n, case when b.n = top and top > 0 and total - last < 10000 then total else bound end as bound from b join l on l.source_id = b.source_id
    union all select source_id, top + 1, total from l where not (total - last < 10000 and top > 0)""")
def chunk_bounds(spark, sf_dir):
    return grouping.chunk_bounds(_silences(spark, sf_dir), _totals(spark, sf_dir), target=20_000.0, min_silence=100.0)


GROUPS_SQL = ASSIGN_SQL + """,
    tt as (select source_id, max(e) as total from iv group by 1),
    c2 as (select source_id, row_number() over (partition by source_id order by time, ord) as block, after as span_start, lead(before) over (partition by source_id order by time, ord) as nxt from cuts),
    b2 as (select c2.source_id, block, span_start, coalesce(nxt, total) as span_end from c2 join tt on tt.source_id = c2.source_id
        union all select tt.source_id, 0, 0, coalesce((select arg_min(before, time) from cuts where cuts.source_id = tt.source_id), total) from tt),
    b3 as (select b2.*, coalesce(n, 0) as n_words, coalesce(ends, false) as ends from b2 left join (select source_id, block, count(*) as n, arg_max(text, (s + e) / 2) in ('click', 'view') as ends from assigned group by 1, 2) w on w.source_id = b2.source_id and w.block = b2.block),
    walk as (
        select source_id, block, case when n_words > 0 then block end as first, case when n_words > 0 then span_start end as gs, span_end as ge, ends from b3 where block = 0
        union all
        select x.source_id, x.block, case when x.n_words = 0 then null when w.first is null or not ((w.ge - w.gs < 1500 and x.span_end - w.gs <= 12000) or not (x.span_end - w.gs > 8000 or (w.ends and w.ge - w.gs >= 1500))) then x.block else w.first end,
            case when x.n_words = 0 then null when w.first is null or not ((w.ge - w.gs < 1500 and x.span_end - w.gs <= 12000) or not (x.span_end - w.gs > 8000 or (w.ends and w.ge - w.gs >= 1500))) then x.span_start else w.gs end, x.span_end, x.ends
        from walk w join b3 x on x.source_id = w.source_id and x.block = w.block + 1
    ),
    grouped as (select source_id, block::bigint as block, first::bigint as group_block from walk where first is not null)"""


def _grouped(spark, sf_dir):
    w, c, t = _words(spark, sf_dir), _cuts(spark, sf_dir), _totals(spark, sf_dir)
    a = intervals.assign_blocks(w, c, chunk=100_000.0)
    last = F.max_by("text", F.struct((F.col("s") + F.col("e")) / 2, -F.col("ord")))  # of words with one middle the first
    n = a.groupBy("source_id", "block").agg(F.count("*").alias("n_words"), last.isin("click", "view").alias("ends"))
    b = grouping.blocks_of(w, c, t).join(n, ["source_id", "block"], "left").select("source_id", "block", "span_start", "span_end", F.coalesce("n_words", F.lit(0)).alias("n_words"), F.coalesce("ends", F.lit(False)).alias("ends"))
    return a, grouping.greedy_groups(b, 1500.0, 8000.0, 12000.0)


@query(f"with recursive {GROUPS_SQL} select source_id, block, group_block from grouped")
def greedy_groups(spark, sf_dir):
    return _grouped(spark, sf_dir)[1]


@query(f"""with recursive {GROUPS_SQL} select a.source_id, group_block, count(*) as word_count, min(s) as speech_start, max(e) as speech_end, sum(floor(v * 1000 + 0.5))::bigint as prob_milli, min(v) as min_word_prob, string_agg(text, ' ' order by s, e, ord) as raw_text
    from assigned a join grouped g on g.source_id = a.source_id and g.block = a.block group by 1, 2""")
def segment_rollup(spark, sf_dir):
    a, g = _grouped(spark, sf_dir)
    return grouping.segments(a.join(g, ["source_id", "block"]).withColumn("prob", F.col("v")))


@query("""with f as (select user_id as source_id, event_id, epoch_us(ts) // 1000000 as t, floor(value * 100 + 0.5)::bigint as power, event_type from events),
    ed as (select source_id, event_id as ord, 'start' as label, t as pos from f where event_type = 'error' union all select source_id, event_id, 'end', t + 4000 from f where event_type = 'error')
    select ed.source_id, ed.ord, label, count(*) as n, sum(power) > 5000 * count(*) as loud from ed join f on f.source_id = ed.source_id and f.t >= pos - 20000 and f.t < pos + 20000 group by 1, 2, 3""")
def boundary_audit(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    t = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long")
    f = e.select(F.col("user_id").alias("source_id"), F.col("event_id").alias("ord"), t.alias("t"), F.floor(F.col("value") * 100 + 0.5).alias("power"), "event_type")
    ends = F.explode(F.array(F.struct(F.lit("start").alias("label"), F.col("t").alias("at")), F.struct(F.lit("end").alias("label"), (F.col("t") + 4000).alias("at")))).alias("x")
    edges = f.where("event_type = 'error'").select("source_id", "ord", ends).select("source_id", "ord", "x.label", "x.at")
    limit = f.select("source_id").distinct().withColumn("threshold", F.lit(5000))
    return intervals.boundary_audit(edges, f.select("source_id", "t", "power"), limit, half=20_000, width=40_000.0)


@query("""with recursive p as (select conv_id, turn, trim(text) as t, row_number() over (partition by conv_id order by turn) as k from conversations),
    w as (select conv_id, k, turn as f, turn as l, t as buf, null::bigint as df, null::bigint as dl, null::varchar as dt from p where k = 1
        union all select p.conv_id, p.k, case when strlen(buf || ' ' || t) > 900 then turn else f end, turn, case when strlen(buf || ' ' || t) > 900 then t else buf || ' ' || t end,
            case when strlen(buf || ' ' || t) > 900 then f end, case when strlen(buf || ' ' || t) > 900 then l end, case when strlen(buf || ' ' || t) > 900 then buf end from w join p on p.conv_id = w.conv_id and p.k = w.k + 1)
    select conv_id, df as first, dl as last, dt as text from w where dt is not null
    union all select conv_id, f, l, buf from w where k = (select max(k) from p where p.conv_id = w.conv_id)""")
def byte_pack(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.trim("text").alias("text"))
    return grouping.pack_bytes(c, 900, "conv_id", "turn")


@query("""with f as (select label::bigint as clip, vec_id, list_position(embedding, list_max(embedding)) - 1 as c from embeddings),
    l as (select *, lag(c) over (partition by clip order by vec_id) as p from f)
    select clip, coalesce(string_agg(c, ',' order by vec_id) filter (c <> 0 and (p is null or p <> c)), '') as classes from l group by clip""")
def ctc_greedy(spark, sf_dir):
    g = ctc.greedy(fixtures.emissions(spark, sf_dir))
    return g.select("clip", F.array_join(F.transform("classes", lambda c: c.cast("string")), ",").alias("classes"))


@query("""with f as (select label::bigint as clip, row_number() over (partition by label order by vec_id) - 1 as t, embedding::double[] as x, list_max(embedding)::double as m from embeddings),
    p as (select clip, t, list_position(x, m) - 1 as c, 1 / list_sum(list_transform(x, lambda v: exp(v - m))) as s from f),
    l as (select *, lag(c) over (partition by clip order by t) as before from p),
    r as (select *, sum(case when c is distinct from before then 1 else 0 end) over (partition by clip order by t) as run from l)
    select clip, row_number() over (partition by clip order by run) - 1 as token, min(t) as "first", max(t) + 1 as "end", floor(avg(s) * 1e6 + 0.5) / 1e6 as score
    from r where c <> 0 group by clip, run""")
def ctc_align(spark, sf_dir):
    """The best path through what greedy decoding gave is the greedy one, so each run of a class is a token's span."""
    e = fixtures.emissions(spark, sf_dir)
    spans = ctc.align(e, ctc.greedy(e).withColumnRenamed("classes", "tokens"))
    return spans.withColumn("score", F.floor(F.col("score") * 1e6 + 0.5) / 1e6)


@query(r"""with a as (select doc_id, translate('‘Rào’ «' || text || '» [Nhạc nền] 5 km² 3 m³ cà—phê a–1 ♪ x....y …… (music) z' || chr(8203) || 'z', '‘’«»—–♪', '''''""-- ') as t from documents),
    b as (select doc_id, regexp_replace(regexp_replace(regexp_replace(replace(t, chr(8203), ''), '[\[(]\s*(nhạc|music|laugh\w*|applause|silence|inaudible|tiếng\s+[^\])]{0,20})[^\])]*[\])]', ' ', 'gi'), '\.{3,}|…{2,}', '…', 'g'), 'm([²³])', 'm\1', 'g') as t from a)
    select doc_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(t, 'm²', 'm2'), 'm³', 'm3'), '(\p{L})-(\p{L})', '\1 \2', 'g'), '(\p{L})-(\p{L})', '\1 \2', 'g'), '[ \t\n\r\f\v]+', ' ', 'g')) as text from b""")
def pre_clean(spark, sf_dir):
    """Whole texts between signs of every kind that the clean-up knows."""
    t = F.concat(F.lit("‘Rào’ «"), "text", F.lit("» [Nhạc nền] 5 km² 3 m³ cà—phê a–1 ♪ x....y …… (music) z\u200bz"))
    return table(spark, sf_dir, "documents").select("doc_id", text.pre_clean(t).alias("text"))


@query(r"""with a as (select doc_id, regexp_replace(text, '[^ ,.!?…\p{Latin}]', ' ', 'g') as t from documents),
    w as (select doc_id, regexp_extract_all(t, '\p{Latin}+|[,.!?…][^\p{Latin}]*') as w from a),
    c as (select doc_id, trim(array_to_string(list_transform(w, lambda x: case when left(x, 1) in (',', '.', '!', '?', '…') then left(x, 1) else ' ' || x end), ''), ' ,;:-') as t from w)
    select doc_id, case when t <> '' and right(t, 1) not in ('.', '!', '?', '…') then t || '.' else t end as text from c""")
def post_clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.post_clean(F.col("text")).alias("text"))


@query("""with a as (select doc_id, regexp_replace(text, '[^ ,.!?…A-Za-z]', ' ', 'g') as t from documents),
    b as (select doc_id, regexp_replace(regexp_replace(t, '\\s+([,.!?…;:])', '\\1', 'g'), '([,.!?…])(\\s*[,.!?…])+', '\\1', 'g') as t from a),
    c as (select doc_id, trim(trim(regexp_replace(regexp_replace(t, '([,.!?…])([^\\s])', '\\1 \\2', 'g'), '\\s+', ' ', 'g')), ' ,;:-') as t from b)
    select doc_id, case when t <> '' and right(t, 1) not in ('.', '!', '?', '…') then t || '.' else t end as text from c""")
def post_clean_ascii(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.post_clean(F.col("text"), "A-Za-z").alias("text"))


_WS = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPEECH_SQL = rf"""
    lines as (select doc_id, string_split_regex(text, '[ \t]*\n{_WS}*') as ls from documents),
    broken as (select doc_id, array_to_string(list_transform(ls, lambda x: array_to_string(list_transform(string_split(regexp_replace(x, '(\.{{2,}}|…)({_WS}*)$', '.\2'), '»')[:-2],
        lambda p: case when rtrim(p, ' ' || chr(9)) <> '' and right(rtrim(p, ' ' || chr(9)), 1) in ('.', '!', '?') then rtrim(left(rtrim(p, ' ' || chr(9)), length(rtrim(p, ' ' || chr(9))) - 1), ' ' || chr(9)) || right(rtrim(p, ' ' || chr(9)), 1) else rtrim(p, ' ' || chr(9)) || '.' end)
        || [regexp_replace(string_split(regexp_replace(x, '(\.{{2,}}|…)({_WS}*)$', '.\2'), '»')[-1], '[ \t]*:[ \t]*$', '.' || chr(0))], chr(0))), chr(0)) as t from lines),
    plain as (select doc_id, regexp_replace(regexp_replace(lower(t), '[:;\-–—()\[\]]', ',', 'g'), '["''“”‘’«]', '', 'g') as t from broken),
    signs as (select doc_id, regexp_replace(regexp_replace(regexp_replace(t, '\.{{2,}}|…', ',', 'g'), '{_WS}*!+(?:{_WS}|[.,!])*', '. ', 'g'), '{_WS}*,(?:{_WS}|,)*', ', ', 'g') as t from plain),
    prepared as (select doc_id, regexp_replace(regexp_replace(regexp_replace(t, ',{_WS}*([.!?…])', '\1', 'g'), '[ \t]+', ' ', 'g'), '^(?:{_WS}|,)+|(?:{_WS}|,)+$', '', 'g') as t from signs)"""


@query(f"with {SPEECH_SQL} select doc_id, t as text from prepared")
def prepare_tts_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.prepare_speech(F.col("text")).alias("text"))


def _packed_sql(pieces: str, limit: int) -> str:
    """The fold that joins neighbours while they stay within limit bytes, over lists of one piece each."""
    own = f"list_transform(list_filter(list_transform({pieces}, lambda q: trim(q)), lambda q: q <> ''), lambda q: [q])"
    return f"case when len({own}) = 0 then [] else list_reduce({own}, lambda done, q: case when strlen(done[-1] || ' ' || q[1]) <= {limit} then done[:-2] || [done[-1] || ' ' || q[1]] else done || q end) end"


CHUNK_BYTES = 230


@query(rf"""with {SPEECH_SQL},
    block as (select doc_id, unnest(string_split(t, chr(0))) as raw, generate_subscripts(string_split(t, chr(0)), 1) as b from prepared),
    spoken as (select doc_id, b, trim(raw, ' ,' || chr(9) || chr(10)) as t from block where regexp_matches(trim(raw, ' ,' || chr(9) || chr(10)), '[\p{{L}}\p{{M}}\p{{N}}]')),
    sentence as (select doc_id, b, unnest(x) as t, generate_subscripts(x, 1) as k from (select doc_id, b, string_split(regexp_replace(trim(t), '([.!?]){_WS}+', '\1' || chr(1), 'g'), chr(1)) as x from spoken)),
    unit as (select doc_id, b, k, case when strlen(t) <= {CHUNK_BYTES} then [t] else {_packed_sql(rf"string_split(regexp_replace(t, '([,;:]){_WS}+', '\1' || chr(1), 'g'), chr(1))", CHUNK_BYTES)} end as us from sentence where t <> ''),
    units as (select doc_id, b, flatten(list(us order by k)) as us from unit group by doc_id, b),
    chunks as (select doc_id, flatten(list(c order by b)) as cs from (select doc_id, b, {_packed_sql("us", CHUNK_BYTES)} as c from units) group by doc_id),
    whole as (select doc_id, case when len(cs) > 0 then list_transform(cs, lambda c: case when length(c) < 2 then c else replace(left(c, length(c) - 1), '?', '.') || right(c, 1) end) else [trim(replace(t, chr(0), ' '))] end as cs from prepared left join chunks using (doc_id))
    select doc_id, generate_subscripts(cs, 1) - 1 as n, unnest(cs) as chunk from whole""")
def speech_chunks(spark, sf_dir):
    """Chunks of about CHUNK_BYTES bytes of each whole text."""
    chunks = text.speech_chunks(text.prepare_speech(F.col("text")), CHUNK_BYTES)
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunks).alias("n", "chunk"))


@query("""with s as (select conv_id, turn, strlen(text) as n from conversations)
    select conv_id, turn, floor(case when n >= 115 then 0.85::double when n <= 25 then 0.85::double * 0.76::double else 0.85::double * (0.76::double + 0.24::double * ((n - 25)::double / 90)) end * 1e6 + 0.5) / 1e6 as speed from s""")
def speed_ramp(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.floor(text.speed_for(F.col("text")) * 1e6 + 0.5) / 1e6).alias("speed"))


@query("select page_id, coalesce(nullif(trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'source') as id from pages")
def sanitise(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.sanitise_id(F.col("url")).alias("id"))


_D = "['không','một','hai','ba','bốn','năm','sáu','bảy','tám','chín']"
_G = f"""case when g = 0 then null else concat_ws(' ', case when g >= 100 or not lead then {_D}[g // 100 + 1] || ' trăm' end,
    case when g // 10 % 10 > 1 then {_D}[g // 10 % 10 + 1] || ' mươi' when g // 10 % 10 = 1 then 'mười' when g % 10 > 0 and (g >= 100 or not lead) then 'lẻ' end,
    case when g % 10 = 0 then null when g // 10 % 10 > 0 and g % 10 = 5 then 'lăm' when g // 10 % 10 > 1 and g % 10 = 1 then 'mốt' when g // 10 % 10 > 1 and g % 10 = 4 then 'tư' else {_D}[g % 10 + 1] end) end"""


@query(f"""with n as (select distinct l_orderkey * 7919 + l_partkey as n from lineitem),
    k as (select n, unnest([3, 2, 1, 0]) as k from n), g as (select n, k, (n // (1000 ** k)::bigint) % 1000 as g, n < (1000 ** (k + 1))::bigint as lead from k)
    , r as (select n, k, {_G} as t from g)
    select n, coalesce(string_agg(t || case k when 3 then ' tỷ' when 2 then ' triệu' when 1 then ' nghìn' else '' end, ' ' order by k desc), 'không') as words from r group by n""")
def read_integer(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 7919 + F.col("l_partkey")).alias("n")).distinct()
    return n.select("n", reading.read_integer(F.col("n")).alias("words"))


@query()
def read_aloud(spark, sf_dir):
    return reading.read_aloud(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("select distinct unnest(string_split(text, '')) as ch from documents")
def distinct_chars(spark, sf_dir):
    return sinks.distinct_characters(table(spark, sf_dir, "documents"))


@query("with c as (select distinct unnest(string_split(text, '')) as ch from documents) select count(*) + 1 = 64 as fits, count(*) as n from c")
def vocab_check(spark, sf_dir):
    return sinks.vocabulary_fits(sinks.distinct_characters(table(spark, sf_dir, "documents")), 64)


@query("""with e as (select user_id as job, epoch_us(ts) // 1000000 as sec, value from events),
    s as (select job, min(sec) as started, max(sec) as done_at, count(*) as done, arg_max(floor(value)::bigint, sec) as extra from e group by job)
    select job, done, greatest(0, floor((done_at - started) / done::double * extra - 60 + 0.5))::bigint as eta from s""")
def job_eta(spark, sf_dir):
    """Of the last second's events the first one counts."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("job"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long").alias("at"), "value", "event_id")
    latest = F.when(F.col("value").isNotNull(), F.struct("at", -F.col("event_id")))
    s = e.groupBy("job").agg(F.min("at").alias("started"), F.max("at").alias("done_at"), F.count("*").alias("done"), F.max_by(F.floor("value"), latest).alias("extra"))
    return s.withColumn("total", F.col("done") + F.col("extra")).select("job", "done", jobs.seconds_left(F.col("done_at") + 60).alias("eta"))


@query("select user_id as job, arg_max(event_type, ts) as state, arg_max(value, ts) filter (event_type = 'error') as error from events group by 1")
def job_state(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("job"), F.col("ts").alias("at"), F.col("event_type").alias("state"), F.when(F.col("event_type") == "error", F.col("value")).alias("error"))
    return jobs.latest(log)


@query(f"with {ASR_SQL} select source_id, seg, text, no_speech_prob, 0::double as avg_logprob, case when listed then len(string_split(t0, ' ')) else 0 end::int as n_words from asr")
def asr_normalise(spark, sf_dir):
    return transcripts.normalise(fixtures.asr_segments(spark, sf_dir)).select("source_id", "seg", "text", "no_speech_prob", "avg_logprob", F.size("words").alias("n_words"))


FLAT_SQL = ASR_SQL + """,
    ends as (select *, max(e) over (partition by source_id order by s, e, ord rows between unbounded preceding and 1 preceding) as before from flat),
    repaired as (select source_id, ord, seg, text, prob, s, e, greatest(s, coalesce(before, s)) as s2, greatest(e, coalesce(before, e), s) as e2 from ends)"""


def _flat(spark, sf_dir):
    return transcripts.flatten_words(transcripts.normalise(fixtures.asr_segments(spark, sf_dir)), chunk=500.0)


@query(f"with {FLAT_SQL} select source_id, ord, seg, text, prob, s2, e2 from repaired")
def flatten_words(spark, sf_dir):
    return _flat(spark, sf_dir).select("source_id", "ord", "seg", "text", "prob", "s2", "e2")


RECORDS_SQL = FLAT_SQL + """,
    w as (select source_id, floor(s2 / 250)::bigint as g, ord, seg, text, prob, s2, e2, case when ord % 3 = 0 then null else (ord % 8)::double / 8 end as ctc from repaired),
    own as (select source_id, g, max(no_speech_prob) as ns from (select distinct source_id, g, seg from w) join asr using (source_id, seg) group by 1, 2),
    rec as (select source_id, g, arg_min(s2, (s2, e2, ord)) as a, arg_max(e2, (s2, e2, ord)) as z, count(*) as n, sum(prob) / count(*) as p, min(prob) as mp,
        sum(coalesce(ctc, 1)) / count(*) as c, min(coalesce(ctc, 1)) as mc, string_agg(text, ' ' order by s2, e2, ord) as t from w group by 1, 2)"""


def _records(spark, sf_dir):
    w = _flat(spark, sf_dir).withColumn("ctc_score", F.when(F.col("ord") % 3 != 0, (F.col("ord") % 8).cast("double") / 8))
    w = w.select("source_id", F.floor(F.col("s2") / 250).alias("group_block"), "seg", "ord", F.col("s2").alias("s"), F.col("e2").alias("e"), "text", "prob", "ctc_score")
    spans = w.groupBy("source_id", "group_block").agg((F.col("group_block") * 250.0).alias("start"), (F.max("e") + 0.25).alias("end"))
    return transcripts.segment_records(w, spans, transcripts.normalise(fixtures.asr_segments(spark, sf_dir)), most=200.0)


@query(f"""with {RECORDS_SQL}, x as (select rec.*, g * 250::double as b, max_e + 0.25::double as f, coalesce(ns, 0) as ns from rec join (select source_id, g, max(e2) as max_e from w group by 1, 2) using (source_id, g) left join own using (source_id, g))
    select source_id, g as group_block, floor(b * 1e3 + 0.5) / 1e3 as start, floor(f * 1e3 + 0.5) / 1e3 as "end", floor((f - b) * 1e3 + 0.5) / 1e3 as duration, floor(a * 1e3 + 0.5) / 1e3 as speech_start, floor(z * 1e3 + 0.5) / 1e3 as speech_end,
        floor(p * 1e4 + 0.5) / 1e4 as asr_prob, floor(mp * 1e4 + 0.5) / 1e4 as min_word_prob, floor(c * 1e4 + 0.5) / 1e4 as ctc_score, floor(mc * 1e4 + 0.5) / 1e4 as min_ctc_word_score, floor(ns * 1e4 + 0.5) / 1e4 as no_speech_prob,
        trim(regexp_replace(t, '\\s+', ' ', 'g')) as raw_text, n as word_count from x""")
def segment_record(spark, sf_dir):
    return _records(spark, sf_dir)[0]


@query(f"with {RECORDS_SQL} select rec.source_id, count(*) as groups, count(*) filter (max_e + 0.25::double - g * 250::double > 200) as oversize, sum(n)::bigint as words from rec join (select source_id, g, max(e2) as max_e from w group by 1, 2) using (source_id, g) group by 1")
def segment_figures(spark, sf_dir):
    return _records(spark, sf_dir)[1]


@query(f"""with {INTERVALS_SQL}, p as (select x.source_id, x.ord, any_value(x.e - x.s) as len, coalesce(sum(least(w.e, x.e) - greatest(w.s, x.s)) filter (w.s is not null), 0) as covered
        from iv x left join iv w on not w.is_sil and w.source_id = x.source_id and w.s < x.e and w.e > x.s where x.is_sil and x.e - x.s between 100 and 1000 group by 1, 2),
    s as (select count(*) filter (covered / len < 0.2::double) as clean, count(*) as n from p) select case when n = 0 then 0 else clean / n::double end as purity from s""")
def silence_purity(spark, sf_dir):
    targets = intervals.silence_targets(_silences(spark, sf_dir), 100.0, 1000.0)
    return intervals.purity(intervals.silence_coverage(targets, _named(_words(spark, sf_dir)), width=4000.0))


@query("""with w as (select conv_id as clip, turn as word, lower(text) as t from conversations),
    c as (select clip, word, unnest(range(1, length(t) + 1)) as i, t from w), k as (select clip, word, i, strpos('|abcdefghijklmnopqrstuvwxyz', t[i]) - 1 as id from c),
    kept as (select * from k where id > 0), first as (select clip, min(word) as word from kept group by clip),
    tok as (select clip, word, i, id, word as owner from kept union all select distinct kept.clip, kept.word, 0, 0, -1 from kept join first on first.clip = kept.clip and first.word < kept.word)
    select clip, string_agg(id, ',' order by word, i) as tokens, string_agg(owner, ',' order by word, i) as owners from tok group by clip""")
def tokenise(spark, sf_dir):
    w = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("clip"), F.col("turn").alias("word"), "text")
    t = ctc.tokenise(w, {c: i for i, c in enumerate("|abcdefghijklmnopqrstuvwxyz")})
    return t.select("clip", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("tokens", "owners")])


@query("""with recursive f as (select '/d' || lpad((doc_id % 89)::varchar, 2, '0') || '/' || doc_id || '/Take ' || (doc_id % 11) || case when doc_id % 3 = 0 then '_2' when doc_id % 7 = 0 then '_3_2' else '' end || '.wav' as path,
        'take_' || (doc_id % 11) || case when doc_id % 3 = 0 then '_2' when doc_id % 7 = 0 then '_3_2' else '' end as base from documents),
    o as (select *, row_number() over (partition by regexp_extract(base, '^take_\\d+') order by path) as k, regexp_extract(base, '^take_\\d+') as root from f),
    walk as (select root, k, path, base as id, [base] as taken from o where k = 1
        union all select o.root, o.k, o.path, pick, list_append(taken, pick) from (select o.*, taken, case when not list_contains(taken, base) then base else base || '_' || list_min(list_filter(range(2, o.k + 2), lambda n: not list_contains(taken, base || '_' || n))) end as pick from walk join o on o.root = walk.root and o.k = walk.k + 1) o)
    select path, id from walk""")
def source_ids(spark, sf_dir):
    i = F.col("doc_id")
    tail = F.when(i % 3 == 0, "_2").when(i % 7 == 0, "_3_2").otherwise("")
    path = F.concat(F.lit("/d"), F.lpad((i % 89).cast("string"), 2, "0"), F.lit("/"), i.cast("string"), F.lit("/Take "), (i % 11).cast("string"), tail, F.lit(".wav"))
    return scans.with_ids(table(spark, sf_dir, "documents").select(path.alias("path")))


@query("""with l as (select conv_id, turn * 3 as n, '# c' || (turn // 3) || '.wav ' || (turn + 1) || '.50 s' as line from conversations union all select conv_id, turn * 3 + 1, '  ' || text || ' ' from conversations union all select conv_id, turn * 3 + 2, '# note' from conversations),
    r as (select conv_id, turn, 'c' || (turn // 3) || '.wav' as name, turn + 1.5::double as duration, trim(text) as text, row_number() over (partition by conv_id order by turn) as k from conversations)
    select conv_id::varchar as file, min(k)::bigint as ord, name, arg_max(duration, k) as duration, arg_max(text, k) as text from r group by conv_id, name""")
def edit_records(spark, sf_dir):
    c, t = table(spark, sf_dir, "conversations"), F.col("turn")
    head = F.concat(F.lit("# c"), F.floor(t / 3).cast("string"), F.lit(".wav "), (t + 1).cast("string"), F.lit(".50 s"))
    lines = F.posexplode(F.array(head, F.concat(F.lit("  "), "text", F.lit(" ")), F.lit("# note")))
    x = c.select(F.col("conv_id").cast("string").alias("file"), "turn", lines.alias("k", "line")).select("file", (t * 3 + F.col("k")).alias("n"), "line")
    return scans.edit_records(x)


@query("select doc_id, source || chr(1) || '|' || chr(4) as voice, chr(2) || text || chr(92) || chr(3) as text, lang from documents")
def pipe_fields(spark, sf_dir):
    """Each row written as a line with escapes, control characters among them, and read back."""
    d = table(spark, sf_dir, "documents").withColumns({"source": F.concat("source", F.lit("\u0001|\u0004")), "text": F.concat(F.lit("\u0002"), "text", F.lit("\\\u0003"))})
    line = F.concat_ws("|", *[F.regexp_replace(c, r"([|\\])", r"\\$1") for c in ("source", "text", "lang")])
    f = d.select("doc_id", scans.pipe_fields(line).alias("f"))
    return f.select("doc_id", *[F.element_at("f", i + 1).alias(c) for i, c in enumerate(("voice", "text", "lang"))])


@query("""with f as (select distinct case o_custkey % 6 when 0 then 'model_last.pt' when 1 then 'pretrained_' || o_custkey || '.safetensors' when 2 then 'model_final.pt' when 3 then 'notes' || o_custkey when 4 then 'model_' || o_custkey || '0000000000000000000.pt' else 'model_0' || o_custkey || '.pt' end as name from orders),
    k as (select name, nullif(regexp_replace(name, '[^0-9]', '', 'g'), '')::hugeint as number, case when name = 'model_last.pt' then 2 when name = 'model_final.pt' then 1 when name like 'pretrained%' then 3 when name like 'model%' then 0 end as kind from f)
    select name, number::varchar as number, row_number() over (order by kind, number desc nulls last, name)::int as place from k where kind is not null""")
def checkpoint_order(spark, sf_dir):
    """Names as the trainer gives them, some with numbers beyond 64 bits."""
    k = F.col("o_custkey")
    s = k.cast("string")
    name = F.when(k % 6 == 0, "model_last.pt").when(k % 6 == 1, F.concat(F.lit("pretrained_"), s, F.lit(".safetensors"))).when(k % 6 == 2, "model_final.pt").when(k % 6 == 3, F.concat(F.lit("notes"), s)).when(k % 6 == 4, F.concat(F.lit("model_"), s, F.lit("0" * 19 + ".pt"))).otherwise(F.concat(F.lit("model_0"), s, F.lit(".pt")))
    return scans.checkpoints(table(spark, sf_dir, "orders").select(F.concat(F.lit("/m/"), name).alias("path")).distinct())


@query("""select case when page_id % 10 = 0 then 'error' when page_id % 9 = 0 then 'stop' else 'infer' end as kind, case when page_id % 10 <> 0 then url end as text, count(*) as n,
        case when page_id % 10 <> 0 and page_id % 4 = 0 then 0.5::double else 1 end as speed from pages group by all""")
def task_lines(spark, sf_dir):
    p, i = table(spark, sf_dir, "pages"), F.col("page_id")
    body = F.to_json(F.struct(F.when(i % 9 == 0, "stop").otherwise("say").alias("action"), F.col("url").alias("text"), F.when(i % 4 == 0, 0.5).alias("speed")))
    lines = p.select(F.when(i % 10 == 0, F.lit("{broken")).otherwise(body).alias("value")).unionByName(p.select(F.lit(" ").alias("value")))
    return scans.tasks(lines).groupBy("kind", "text", "speed").agg(F.count("*").alias("n"))


@query("""with s as (select user_id as source_id, count(*) as n, count(*) filter (event_type = 'error') as replaced, count(*) filter (event_type = 'error' and value > 20) as by_score, count(*) filter (value is null) as failed from events group by 1)
    select source_id, n as clips, replaced, by_score, failed from s""")
def outcome_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "source_id")
    hit = F.col("event_type") == "error"
    return transcripts.outcome_counts(e, replaced=hit, by_score=hit & (F.col("value") > 20), failed=F.col("value").isNull())


@query("""with t as (select label::bigint as clip, vec_id as token, vec_id % 5 - 1 as word, vec_id * 2 as first, vec_id * 2 + 3 as e, (vec_id % 16)::double / 16 as score from embeddings)
    select clip, word, min(first) as first, max(e) as "end", floor(sum((score * 16)::bigint) / count(*)::double / 16 * 1e6 + 0.5) / 1e6 as score from t where word >= 0 group by 1, 2""")
def word_spans(spark, sf_dir):
    return ctc.word_spans(_spans(spark, sf_dir)).withColumn("score", transcripts.rounded(F.col("score"), 6))


def _spans(spark, sf_dir):
    v = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("clip"), v.alias("token"), (v % 5 - 1).alias("word"), (v * 2).alias("first"), (v * 2 + 3).alias("end"), ((v % 16).cast("double") / 16).alias("score"))


@query("""with t as (select label::bigint as clip, vec_id % 5 - 1 as word, (vec_id % 16)::double / 16 as score from embeddings), c as (select distinct label::bigint as clip from embeddings union select 99999)
    select c.clip, coalesce(floor(sum((score * 16)::bigint) filter (word >= 0) / count(*) filter (word >= 0)::double / 16 * 1e6 + 0.5) / 1e6, 0) as ctc_score from c left join t on t.clip = c.clip group by 1""")
def clip_scores(spark, sf_dir):
    s = _spans(spark, sf_dir)
    return ctc.clip_scores(s, s.select("clip").unionByName(spark.range(99999, 100000).select(F.col("id").alias("clip")))).withColumn("ctc_score", transcripts.rounded(F.col("ctc_score"), 6))


@query(f"""with {INTERVALS_SQL}, a as (select ord, s + 1 as first, case when ord % 4 = 0 then s else e end as z, (ord % 32)::double / 32 as score from iv where ord % 3 > 0)
    select source_id as clip, iv.ord as word, case when z > first then floor(first * 1e3 + 0.5) / 1e3 else s end as s, case when z > first then floor(z * 1e3 + 0.5) / 1e3 else e end as e, case when z > first then floor(score * 1e4 + 0.5) / 1e4 end as ctc_score, coalesce(z > first, false) as realigned from iv left join a using (ord)""")
def retime_words(spark, sf_dir):
    x = fixtures.intervals(spark, sf_dir).select(F.col("source_id").alias("clip"), F.col("ord").alias("word"), "s", "e")
    a = x.where("word % 3 > 0").select("clip", "word", (F.col("s") + 1).alias("first"), F.when(F.col("word") % 4 == 0, F.col("s")).otherwise(F.col("e")).alias("end"), ((F.col("word") % 32).cast("double") / 32).alias("score"))
    return ctc.retime(x, a)


@query(f"""with {FLAT_SQL}, g as (select source_id, seg, min(s2) as a, max(e2) as z, string_agg(text, ' ' order by s2, e2, text) as t, count(*) as n from repaired where ord % 4 > 0 group by 1, 2)
    select asr.source_id, asr.seg, coalesce(a, s) as s, coalesce(z, e) as e, coalesce(n, 0)::int as n_words, t as words from asr left join g on g.source_id = asr.source_id and g.seg = asr.seg""")
def regroup_words(spark, sf_dir):
    w = _flat(spark, sf_dir).where("ord % 4 > 0").select("source_id", "seg", F.col("s2").alias("s"), F.col("e2").alias("e"), "text")
    x = ctc.regroup(w, fixtures.asr_segments(spark, sf_dir).select("source_id", "seg", "s", "e"))
    return x.select("source_id", "seg", "s", "e", F.coalesce(F.size("words"), F.lit(0)).alias("n_words"), F.array_join(F.col("words.text"), " ").alias("words"))


@query(f"""with {fixtures.blocks_sql(16)},
    f as (select source_id, unnest([i // 10, i // 10 - 1]) as frame, x from wave)
    select source_id, frame, floor(10 * log10(avg(x * x) + 1e-12) * 1e4 + 0.5) / 1e4 as level from f where frame >= 0 group by 1, 2 having count(*) = 20
    union all select source_id, 0, -120 from totals where total < 20""")
def block_levels(spark, sf_dir):
    """Windows of 20 samples every 10 over blocks of 64, so that every block's edge is crossed."""
    x = frames.frame_levels(fixtures.blocks(spark, sf_dir, 16, 1000, 64))
    return x.withColumn("level", F.floor(F.col("level") * 1e4 + 0.5) / 1e4)


@query(f"""with {fixtures.blocks_sql(16)},
    f as (select source_id, unnest([i // 10, i // 10 - 1]) as frame, x from wave),
    l as (select source_id, frame, 10 * log10(avg(x * x) + 1e-12) as level from f where frame >= 0 group by 1, 2 having count(*) = 20),
    q as (select source_id, count(*) as n, quantile_cont(level, 0.92) - quantile_cont(level, 0.08) as snr, max(level) - 40 as low from l group by 1),
    v as (select source_id, min(frame) * 10 - 30 as a, max(frame) * 10 + 50 as z from l join q using (source_id) where level > low group by 1)
    select totals.source_id, floor(case when n >= 8 then snr else 0 end * 1e3 + 0.5) / 1e3 as snr_db, case when coalesce(n, 0) < 3 then 0 else greatest(0, a) end as "begin", case when coalesce(n, 0) < 3 then total else least(total, z) end as "end"
    from totals left join q using (source_id) left join v using (source_id)""")
def block_speech(spark, sf_dir):
    """Signal to noise and the span of voice of each recording, from its levels."""
    b = fixtures.blocks(spark, sf_dir, 16, 1000, 64)
    levels = frames.frame_levels(b)
    x = frames.signal_to_noise(levels).join(frames.voiced_span(levels, b.groupBy("source_id", "rate").agg(F.max("total").alias("total"))), "source_id")
    return x.withColumn("snr_db", F.floor(F.col("snr_db") * 1e3 + 0.5) / 1e3)


_RATE = 4000
_K1, _K2 = "tan(pi() * 1681.974450955533 / 4000)", "tan(pi() * 38.13547087602444 / 4000)"


@query(f"""with recursive {fixtures.blocks_sql(2)},
    c as (select {_K1} as k, pow(10, 3.999843853973347 / 20) as h, pow(pow(10, 3.999843853973347 / 20), 0.4996667741545416) as b, 0.7071752369554196 as q, {_K2} as k2, 0.5003270373238773 as q2),
    co as (select (h + b * k / q + k * k) / (1 + k / q + k * k) as b0, 2 * (k * k - h) / (1 + k / q + k * k) as b1, (h - b * k / q + k * k) / (1 + k / q + k * k) as b2, 2 * (k * k - 1) / (1 + k / q + k * k) as a1, (1 - k / q + k * k) / (1 + k / q + k * k) as a2,
        2 * (k2 * k2 - 1) / (1 + k2 / q2 + k2 * k2) as e1, (1 - k2 / q2 + k2 * k2) / (1 + k2 / q2 + k2 * k2) as e2 from c),
    run(source_id, i, z1, z2, z3, z4, y) as (
        select source_id, -1::bigint, 0::double, 0::double, 0::double, 0::double, 0::double from totals
        union all
        select source_id, i, b1 * x - a1 * u + z2, b2 * x - a2 * u, -2 * u - e1 * (u + z3) + z4, u - e2 * (u + z3), u + z3
        from (select w.source_id, w.i, w.x, b0 * w.x + z1 as u, z1, z2, z3, z4, co.* from run join wave w on w.source_id = run.source_id and w.i = run.i + 1, co)),
    s as (select source_id, i // 400 as step, avg(y * y) as p from run where i >= 0 group by 1, 2 having count(*) = 400),
    g as (select source_id, g, avg(p) as p from (select source_id, p, unnest(range(step - 3, step + 1)) as g from s) group by 1, 2 having count(*) = 4),
    h1 as (select * from g where -0.691 + 10 * log10(p) > -70),
    h2 as (select h1.source_id, -0.691 + 10 * log10(avg(p)) as lufs from h1 join (select source_id, -10.691 + 10 * log10(avg(p)) as low from h1 group by 1) t on t.source_id = h1.source_id where -0.691 + 10 * log10(p) > low group by 1),
    top as (select source_id, max(abs(x)) as top, count(*) / 4000 as sec from wave group by 1),
    w as (select source_id, lufs, top, case when sec >= 0.5 and lufs is not null then pow(10, (-23 - lufs) / 20) else 1 end as wanted from top left join h2 using (source_id))
    select source_id, floor(lufs * 1e4 + 0.5) / 1e4 as lufs, floor(case when top * wanted > pow(10, -1.5 / 20) then pow(10, -1.5 / 20) / top else wanted end * 1e6 + 0.5) / 1e6 as gain from w""")
def block_loudness(spark, sf_dir):
    """Integrated loudness and gain of each recording, against the filter's recursion sample by sample."""
    b = fixtures.blocks(spark, sf_dir, 2, _RATE, 1000)
    x = frames.loudness(b).join(frames.gains(b), "source_id")
    return x.select("source_id", (F.floor(F.col("lufs") * 1e4 + 0.5) / 1e4).alias("lufs"), (F.floor(F.col("gain") * 1e6 + 0.5) / 1e6).alias("gain"))


@query("""with s as (select event_id % 5 as k, event_id // 5 as i, floor(value)::bigint % 30000 as v from events), t as (select k, count(*) as total from s group by 1)
    select 'r' || k || '.wav' as name, i // 100 as block, (i // 100 * 100) / 100::double as start, least(total, i // 100 * 100 + 100) / 100::double as "end", sum(v)::double as level, count(*)::int as n
    from s join t using (k) where k <> 3 and i // 100 * 100 / 100::double < 30 and least(total, i // 100 * 100 + 100) / 100::double > 0.5 group by k, i // 100, total""")
def wav_range_scan(spark, sf_dir):
    """Recordings of event values, written as files under a commit, and a stretch of all but one read back by byte range."""
    e = table(spark, sf_dir, "events").select((F.col("event_id") % 5).alias("k"), F.col("event_id").alias("i"), (F.floor("value") % 30000).cast("int").alias("v"))
    content = F.udf(lambda x: signal.write_wav(np.array(x) / 32767, 100), "binary")  # a fixture: one value a file
    files = e.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("s")).select(F.concat(F.lit("r"), F.col("k").cast("string"), F.lit(".wav")).alias("name"), content("s.v").alias("content"))
    folder = _shared(spark, "recordings")
    wav_blocks.save_files(files, folder)
    x = wav_blocks.blocks(spark, folder, seconds=1.0, split_bytes=1 << 12).where((F.col("start") < 30) & (F.col("end") > 0.5)).withColumn("name", basename(F.col("path"))).where("name <> 'r3.wav'")
    return x.select("name", "block", "start", "end", F.aggregate("samples", F.lit(0.0), lambda a, v: a + v.cast("double") * 32768).alias("level"), F.size("samples").alias("n"))


@query(f"""with {fixtures.SPOKEN_SQL}
    select source_id, seg * 1000000 + k as ord, seg % 5 <> 3 as realigned, floor((case when seg % 5 <> 3 then begin * 0.02::double else begin * 0.02::double + 0.3 end) * 1e3 + 0.5) / 1e3 as s,
        floor((case when seg % 5 <> 3 then (begin + 2 * length(text) - 1) * 0.02::double else (begin + 2 * length(text) - 1) * 0.02::double + 0.4 end) * 1e3 + 0.5) / 1e3 as e, case when seg % 5 <> 3 then 0.9988::double end as ctc_score from spoken""")
def chunk_alignment(spark, sf_dir):
    """Words of whole texts by chunk; those of chunks without frames keep their times."""
    words, heard, bounds = fixtures.spoken(spark, sf_dir)
    x = alignment.aligned_words(words.drop("seg"), heard, bounds, fixtures.SPOKEN_VOCAB, fixtures.STEP)
    return x.select("source_id", "ord", "realigned", transcripts.rounded(F.col("s"), 3).alias("s"), transcripts.rounded(F.col("e"), 3).alias("e"), "ctc_score")


@query(f"""with {fixtures.SPOKEN_SQL}, w as (select source_id, count(*) as words, count(*) filter (seg % 5 <> 3) as realigned, count(distinct seg) filter (seg % 5 = 3) as failed from spoken group by 1)
    select p.source_id, count(*) as chunks, coalesce(any_value(failed), 0) as failed_chunks, coalesce(any_value(words), 0) as words, coalesce(any_value(realigned), 0) as realigned from placed p left join w on w.source_id = p.source_id group by 1""")
def alignment_counters(spark, sf_dir):
    words, heard, bounds = fixtures.spoken(spark, sf_dir)
    return alignment.counters(alignment.aligned_words(words.drop("seg"), heard, bounds, fixtures.SPOKEN_VOCAB, fixtures.STEP), bounds)


def _shared(spark, name: str) -> str:
    """A new folder that all executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or (f"file://{tempfile.gettempdir()}/cliploom" if spark.sparkContext.master.startswith("local[") else None)
    if not root:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
