"""Sources: recordings, probes, artefacts, edit files, pipe-separated lists, checkpoints, task lines, system output."""

from __future__ import annotations

from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import basename, sanitise_id, stem


def recordings(spark: SparkSession, paths: str | list[str], pattern: str = "*", content: bool = False) -> DataFrame:
    """(path, id) of files, each with an id of its own, in order of path; files that are listed by name come first, as they are listed. A missing path raises; in a folder, files without bytes are not seen."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths)
    files = files.select("path", *(["content"] if content else [])).dropDuplicates(["path"])
    if isinstance(paths, str):
        return with_ids(files)
    whole = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    listed = {}
    empty = []  # named files without bytes, which a scan leaves out
    for k, p in enumerate(whole):
        system = p.getFileSystem(spark._jsc.hadoopConfiguration())
        name = str(system.makeQualified(p).toString())
        if name not in listed and system.exists(p) and system.getFileStatus(p).isFile() and not system.getFileStatus(p).getLen() and fnmatch(p.getName(), pattern):
            empty.append((name, bytearray()))
        listed.setdefault(name, k)
    files = files.unionByName(spark.createDataFrame(empty, "path string, content binary").select(*files.columns))
    places = spark.createDataFrame(list(listed.items()), "path string, _place long")
    return with_ids(files.join(places, "path", "left").withColumn("_place", F.coalesce("_place", F.lit(len(paths)))), ["_place", "path"]).drop("_place")


def discover(spark: SparkSession, override: list[str] | None = None, paths: list[str] | None = None, folder: str | None = None, path: str | None = None, pattern: str = "*", content: bool = False) -> DataFrame:
    """recordings() of the first of these that is given: files named for this run, files of the configuration, its folder, its one file."""
    for given in (override, paths, folder, path):
        if given:
            return recordings(spark, given, pattern, content)
    raise ValueError("no source is given")


def with_ids(files: DataFrame, order: list[str] | None = None) -> DataFrame:
    """files (path, ...) with id: the sanitised stem, or with the first of _2, _3, ... that no file before has taken, in order of path or of the given columns.

    Ids can only meet where a stem is there twice, or is one with a number behind it; files of other stems keep theirs. The
    files of a stem and of those that begin with it and numbers are one ordered run where both kinds are there, else they are counted.
    """
    order = order or ["path"]
    base = files.withColumn("_id", sanitise_id(stem(F.col("path"))))
    twice = base.groupBy("_id").count().where("count > 1").select(F.col("_id").alias("_root"))
    head, tail = F.regexp_extract("_id", r"^(.*?)((?:_\d+)*)$", 1), F.regexp_extract_all(F.regexp_extract("_id", r"^(.*?)((?:_\d+)*)$", 2), F.lit(r"_\d+"), F.lit(0))
    begins = F.transform(F.sequence(F.lit(0), F.size(tail)), lambda n: F.concat(head, F.array_join(F.slice(tail, F.lit(1), n), "")))
    roots = base.select("_id").distinct().select("_id", F.explode(begins).alias("_root")).join(twice, "_root").groupBy("_id").agg(F.min_by("_root", F.length("_root")).alias("_root"))
    named = base.join(roots, "_id", "left")
    kinds = roots.groupBy("_root").agg((F.count("*") > 1).alias("_mixed"))
    named = named.join(kinds, "_root", "left")
    n = F.row_number().over(Window.partitionBy("_id").orderBy(*order))
    counted = named.where(~F.coalesce("_mixed", F.lit(False))).withColumn("id", F.when(n == 1, F.col("_id")).otherwise(F.concat("_id", F.lit("_"), n.cast("string"))))

    def first_free(t: pa.Table) -> pa.Table:
        taken: set[str] = set()
        last: dict[str, int] = {}
        out = []
        t = t.sort_by([(c, "ascending") for c in order])
        for name in t.column("_id").to_pylist():
            k, free = last.get(name, 1), name
            while free in taken:
                k += 1
                free = f"{name}_{k}"
            last[name] = k
            taken.add(free)
            out.append(free)
        return pa.table({"path": t.column("path"), "id": pa.array(out, pa.string())})

    met = named.where("_mixed")
    ids = met.groupBy("_root").applyInArrow(lambda t: first_free(t.select([*dict.fromkeys(["path", *order]), "_id"])), "path string, id string")
    return counted.select(*files.columns, "id").unionByName(met.join(ids, "path").select(*files.columns, "id"))


PROBE = "struct<streams:array<struct<codec_type:string,codec_name:string,sample_rate:string,channels:int,bit_rate:string>>,format:struct<duration:string,bit_rate:string>>"


def probe_summary(raw: Column) -> Column:
    """codec, sample_rate, channels, bit_rate and duration of a probe's JSON: its first audio stream; missing numbers are 0."""
    p = F.from_json(raw, PROBE)
    a = F.try_element_at(F.filter(p["streams"], lambda s: s["codec_type"] == "audio"), F.lit(1))
    number = lambda c, t: F.coalesce(c.try_cast(t), F.lit(0).cast(t))
    return F.struct(a["codec_name"].alias("codec"), number(a["sample_rate"], "int").alias("sample_rate"), number(a["channels"], "int").alias("channels"), number(F.coalesce(a["bit_rate"], p["format"]["bit_rate"]), "bigint").alias("bit_rate"), number(p["format"]["duration"], "double").alias("duration"))


def documents_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Whole JSON documents, by a given schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def edit_records(lines: DataFrame) -> DataFrame:
    """(ord, name, duration, text) of numbered lines (file, n, line): # name.wav 1.23 s begins a record, other # lines are left out.

    The text lines of a record are joined by a blank; of a name's records the last text counts, at the first one's place.
    Edit files are written by hand, one a source, so a file is one ordered run.
    """
    head = r"^#\s*(\S+\.wav)\s+([0-9]+(?:\.[0-9]+)?)\s*s"
    x = lines.withColumn("_t", F.trim(F.regexp_replace("line", r"(?U)^\s+|\s+$", ""))).withColumn("_head", F.col("_t").rlike(head))
    x = x.withColumn("_r", F.sum(F.col("_head").cast("int")).over(Window.partitionBy("file").orderBy("n"))).where("_r > 0")
    kept = F.when(~F.col("_t").startswith("#") & (F.col("_t") != ""), F.struct("n", "_t"))
    r = x.groupBy("file", "_r").agg(F.max(F.when(F.col("_head"), F.col("_t"))).alias("_h"), F.array_join(F.transform(F.sort_array(F.collect_list(kept)), lambda s: s["_t"]), " ").alias("text"))
    r = r.select("file", "_r", F.regexp_extract("_h", head, 1).alias("name"), F.regexp_extract("_h", head, 2).cast("double").alias("duration"), "text")
    return r.groupBy("file", "name").agg(F.min("_r").alias("ord"), F.max_by(F.struct("duration", "text"), "_r").alias("_l")).select("file", "ord", "name", "_l.duration", "_l.text")


def text_lines(spark: SparkSession, paths) -> DataFrame:
    """(file, n, line) of text files."""
    x = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("n", "line"))
    return x


def pipe_fields(line: Column) -> Column:
    """Fields of a line: | separates, a backslash takes the next character as it is, nothing is quoted."""
    # U+0001 of the data becomes U+0001 a, so that U+0001 b can stand before an escaped separator or backslash.
    x = F.regexp_replace(F.replace(line, F.lit("\u0001"), F.lit("\u0001a")), r"\\([\\|])", "\u0001b$1")
    bare = lambda f: F.replace(F.regexp_replace(f, r"(?<!\u0001b)\\", ""), F.lit("\u0001b"), F.lit(""))
    return F.transform(F.split(x, r"(?<!\u0001b)\|", -1), lambda f: F.replace(bare(f), F.lit("\u0001a"), F.lit("\u0001")))


def pipe_table(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A pipe-separated file; blank lines are left out."""
    f = spark.read.text(path).where("value <> ''").select(pipe_fields(F.col("value")).alias("f"))
    return f.select(*[F.try_element_at("f", F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def checkpoints(files: DataFrame, final: str = "model_final.pt", last: str = "model_last.pt", pretrained: str = "pretrained") -> DataFrame:
    """(name, number, place) of model files: numbered ones by falling number (all digits of the name, however many), then the final and the last one, then
    those whose names begin with `pretrained`. The list is one of files of a folder, short enough for one task."""
    name = F.col("name")
    x = files.select(basename(F.col("path")).alias("name"))
    digits = F.nullif(F.regexp_replace(name, "[^0-9]", ""), F.lit(""))
    number = F.when(digits.isNotNull(), F.coalesce(F.nullif(F.ltrim(digits, F.lit("0")), F.lit("")), F.lit("0")))
    kind = F.when(name == final, 1).when(name == last, 2).when(name.startswith("model_") & name.endswith(".pt") & digits.isNotNull(), 0).when(name.startswith(pretrained), 3)
    x = x.withColumns({"kind": kind, "number": number}).where("kind is not null")
    return x.withColumn("place", F.row_number().over(Window.orderBy("kind", F.length("number").desc_nulls_last(), F.col("number").desc_nulls_last(), "name"))).select("name", "number", "place")


def resolve_checkpoint(listed: DataFrame, wanted: str, pretrained: str) -> DataFrame:
    """The wanted checkpoint if it is listed, else the first, else the pretrained one."""
    return listed.agg(F.coalesce(F.max(F.when(F.col("name") == wanted, F.col("name"))), F.min_by("name", "place"), F.lit(pretrained)).alias("name"))


def voice(voices: DataFrame, wanted: str, default: str) -> DataFrame:
    """The voice's row, or the default's."""
    return voices.where(F.col("voice").isin(wanted, default)).orderBy(F.col("voice") != wanted).limit(1)


TASK = "action string, text string, out string, speed double, _corrupt_record string"


def tasks(lines: DataFrame) -> DataFrame:
    """Task lines (value) as rows: blank lines left out, broken ones marked, speed 1 if missing, stop apart."""
    x = lines.where(F.trim("value") != "").select(F.from_json("value", TASK, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("t"))
    kind = F.when(F.col("t._corrupt_record").isNotNull(), "error").when(F.col("t.action") == "stop", "stop").otherwise("infer")
    return x.select(kind.alias("kind"), "t.text", "t.out", F.coalesce("t.speed", F.lit(1.0)).alias("speed"))


def process_state(ps: DataFrame) -> DataFrame:
    """cpu_percent, n, and whether the last process is stopped, of ps lines (value: pid cpu state)."""
    f = F.split(F.trim("value"), r"\s+")
    x = ps.where(F.trim("value").rlike(r"^\d+\s")).select(f[0].cast("int").alias("pid"), f[1].cast("double").alias("cpu"), f[2].alias("state"))
    return x.agg(F.coalesce(F.sum("cpu"), F.lit(0.0)).alias("cpu_percent"), F.count("*").alias("n"), F.coalesce(F.max_by("state", "pid").startswith("T"), F.lit(False)).alias("paused"))


def gauge(value: Column) -> Column:
    return F.when(value < 60, "ok").when(value < 85, "warn").otherwise("danger")
