"""URL rules by a sort-merge range join, in DataFrame functions only.

A rule of a host and a path prefix becomes the interval of keys that begin with its reversed host and its path. Each
URL asks once for each suffix of its host. Keys are put in order, with the opening and the closing of each interval
among them, and one sweep carries the rule on top of the stack: intervals of prefixes are nested or apart, so what lies
under a rule is known beforehand (the longest other rule that is a prefix of it) and the closing of a rule brings back
exactly that one.

URLs are dealt to `lanes`, and each lane sweeps its URLs among the rules that it has; each URL is sorted once. Up to MOST_COPIED
rules, URLs are dealt by a hash of their row, whatever their host, and all lanes have all rules. Beyond, they are dealt by domain (the
last two labels of the host), a domain of more than HOT_URLS of them to several lanes; a rule goes to the lanes of its domain, and
only rules for top-level domains go to all. So a host with a third of the rows is spread either way, and rules are copied for
hot domains only.

Null URLs and those without :// have an empty host and path and no rule. Rules with a null host or an empty one are
ignored; a null path is empty; of rules with the same host and path a block stands before an allow; without rules the default
decides. A URL of any length is one row. Repeated rows each get their row; a null id comes back null; an empty table gives none.
Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import named, settled

#: Rules that are copied to every lane; URLs of a domain that one lane takes, where there are more rules.
MOST_COPIED, HOT_URLS = 10_000, 1_000_000
#: Stands after all characters of a host or path, and before none: it ends a key's interval.
LAST = "\U0010ffff\U0010ffff"
#: Ends the reversed host in a key. It cannot be in a host, so a host's key is no prefix of another host's.
END = "/"


def fold_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.coalesce(fold_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def domain_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def apply_rules(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", lanes: int | None = None) -> DataFrame:
    """page_id, host, path, rule (host + path of the longest rule that fits, else null), verdict.

    rules has host, path and verdict (allow or block). One shuffle of the questions (a key and a row number for each
    label of each host), one of the best answer of each row.
    """
    lanes = lanes or 4 * int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rule = (
        rules.select(fold_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("verdict"))
        .where(F.length("host") > 0)
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
        .select(F.concat(reversed_host(F.col("host")), F.lit(END), F.col("path")).alias("key"), F.concat("host", "path").alias("rule"), "verdict")
    )
    # The rule under each rule: the longest proper prefix that is a rule's key too.
    prefix = rule.select(F.col("key").alias("inner"), F.explode(F.expr("transform(sequence(1, greatest(length(key) - 1, 1)), n -> substring(key, 1, n))")).alias("key")).where(F.col("key") != F.col("inner"))
    under = prefix.join(rule, "key").groupBy("inner").agg(F.max_by(F.struct("rule", "verdict"), F.length("key")).alias("under"))
    top = rule.join(under, rule["key"] == under["inner"], "left").select("key", F.struct("rule", "verdict").alias("own"), "under")
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    event = top.select(F.explode(F.array(F.struct(F.col("key").alias("key"), F.lit(0).alias("kind"), F.col("own").alias("top")), F.struct(F.concat("key", F.lit(LAST)).alias("key"), F.lit(2).alias("kind"), F.coalesce("under", none).alias("top")))).alias("e")).select("e.*")
    event = event.withColumn("page", F.lit(None).cast("struct<page_id:bigint,host:string,path:string,row:bigint,levels:int>"))
    page = pages.select(named(pages, id_col).cast("long").alias("page_id"), named(pages, url_col).cast("string").alias("url"))
    page = page.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.xxhash64("page_id", "url").alias("hash"), F.monotonically_increasing_id().alias("n"))
    every = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane")
    if rule.limit(MOST_COPIED + 1).count() <= MOST_COPIED:
        page = page.withColumn("lane", F.pmod(F.col("hash"), F.lit(lanes)).cast("int"))
        events = event.select(every, "key", "kind", "top", "page")
    else:
        hot = page.groupBy(domain_of(F.col("host")).alias("domain")).count().where(F.col("count") > HOT_URLS)
        hot = settled(hot.select("domain", F.ceil(F.col("count") / HOT_URLS).cast("int").alias("parts")), "domains")  # at most a row for HOT_URLS URLs
        lane = lambda part: F.pmod(F.xxhash64("domain", part), F.lit(lanes)).cast("int")
        parts = F.coalesce("parts", F.lit(1))
        page = page.withColumn("domain", domain_of(F.col("host"))).join(hot, "domain", "left").withColumn("lane", lane(F.pmod(F.col("hash"), parts).cast("int"))).drop("domain", "parts")
        own = event.withColumn("host", F.substring_index("key", END, 1))  # reversed
        wide = F.instr("host", ".") == 0
        narrow = own.where(~wide).withColumn("domain", F.array_join(F.reverse(F.slice(F.split("host", r"\.", -1), 1, 2)), "."))
        narrow = narrow.join(hot, "domain", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        events = own.where(wide).select(every, "key", "kind", "top", "page").unionByName(narrow.select(lane(F.col("part")).alias("lane"), "key", "kind", "top", "page").distinct())
    labels = F.split(F.col("host"), r"\.", -1)
    # Each row asks once for each suffix; its questions stay in one lane, so its answers meet without a further shuffle.
    asked = page.select("*", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("level"), F.size(labels).alias("levels"))
    suffix = F.concat(F.array_join(F.reverse(F.slice(F.split("host", r"\."), F.col("levels") - F.col("level") + 1, F.col("level"))), "."), F.lit(END))
    question = asked.select("lane", F.concat(suffix, "path").alias("key"), F.lit(1).alias("kind"), F.lit(None).cast("struct<rule:string,verdict:string>").alias("top"), F.struct("page_id", "host", "path", F.col("n").alias("row"), "levels").alias("page"))
    sweep = Window.partitionBy("lane").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = question.unionByName(events).withColumn("top", F.last("top", ignorenulls=True).over(sweep)).where(F.col("kind") == 1)
    best = swept.groupBy("lane", "page.row").agg(F.first("page").alias("page"), F.max(F.when(F.col("top.rule").isNotNull(), F.struct(F.length("top.rule").alias("size"), F.col("top.rule").alias("rule"), F.col("top.verdict").alias("verdict")))).alias("best"))
    return best.select("page.page_id", "page.host", "page.path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def rules_frame(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows as a frame of literals; nothing is sent from Python."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*") if rows else spark.range(0).select(*[F.lit("").alias(c) for c in ("host", "path", "verdict")])


