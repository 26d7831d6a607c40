"""Sinks: lists, pipe-separated metadata, summaries, rejected rows, the edit template, clips, trainer files and the report."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import basename, stem


def stage_table(df: DataFrame, path: str, by: str = "source_id") -> None:
    """Parquet by source; a run replaces only the sources that it has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def list_line(speaker: str, language: str, path: str = "list_path", text: str = "text") -> Column:
    """path|speaker|language|text, nothing escaped."""
    return F.concat(F.col(path), F.lit(f"|{speaker}|{language}|"), F.col(text))


def lines_in_order(df: DataFrame, line: Column, order: list, path: str, separator: str = "\n") -> None:
    """A text file of a line each, in order."""
    df.select(line.alias("value"), *[o if isinstance(o, Column) else F.col(o) for o in order]).orderBy(*order).select("value").coalesce(1).write.mode("overwrite").option("lineSep", separator).text(path)


def escape_field(c: Column) -> Column:
    """Backslash before | and backslashes, and before the characters that end a line."""
    return F.regexp_replace(c, r"([|\\\r\n])", r"\\$1")


def speech_csv(entries: DataFrame, path: str, order: str = "idx") -> None:
    """stem|text|text with CRLF."""
    lines_in_order(entries, F.concat_ws("|", escape_field(stem(F.col("filename"))), escape_field(F.col("text")), escape_field(F.col("text"))), [order], path, "\r\n")


def rejected_lines(reviewed: DataFrame, path: str) -> None:
    """The rejected, seven keys each, nulls written."""
    reviewed.where("not accepted").select("source_id", F.col("idx").alias("index"), "start", "end", "duration", "reasons", "text").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def edit_line() -> Column:
    """The header of a clip in an edit file, and its text."""
    head = F.format_string("# %s  %.2fs  ctc=%.2f  daydu=%.2f", basename(F.col("wav")), F.col("duration"), F.coalesce("ctc_score", F.lit(1.0)), F.coalesce("completeness", F.lit(1.0)))
    return F.concat(F.lit("\n"), head, F.lit("\n"), F.coalesce("text", F.lit("")))


def edit_template(clips: DataFrame, path: str, order: str = "idx") -> None:
    """Only where there is none yet, so edits by hand stay."""
    clips.select(edit_line().alias("value"), order).orderBy(order).select("value").coalesce(1).write.mode("ignore").text(path)


def trainer_rows(metadata: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose recording exists, with lower-case text; those without), by name."""
    m = metadata.withColumn("text", F.lower(F.trim("text")))
    return m.join(files, "name", "left_semi"), m.join(files, "name", "left_anti")


def distinct_characters(texts: DataFrame, text: str = "text") -> DataFrame:
    """Every character once, in code point order."""
    return texts.select(F.explode(F.split(F.col(text), "")).alias("ch")).where("ch <> ''").distinct().orderBy("ch")


def vocabulary_fits(characters: DataFrame, rows: int) -> DataFrame:
    """Whether an embedding of that many rows has one for each line and one more."""
    return characters.agg((F.count("*") + 1 == rows).alias("fits"), F.count("*").alias("n"))


def summary_json(summary: DataFrame) -> DataFrame:
    return summary.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


#: Heads of the columns of probes, and their values.
PROBES = {
    "path": ("file", lambda x: (x or "").rsplit("/", 1)[-1]),
    "bit_rate": ("kbps", lambda x: round((x or 0) / 1000)),
    "duration": ("minutes of the original", lambda x: f"{(x or 0) / 60:.2f}"),
    "decoded_duration": ("minutes decoded", lambda x: f"{(x or 0) / 60:.2f}"),
}


def report_lines(project: str, sources: DataFrame, reasons: DataFrame, timings: dict[str, float], summary: DataFrame | None = None) -> Iterator[str]:
    """The lines of a Markdown page of per-source and per-reason figures: every source and every reason, a partition at a time on the driver.

    Sources that have columns of probes (PROBES) show them; summary is the row of rollup.corpus_summary.
    """
    probes = [c for c in PROBES if c in sources.columns]
    yield from (f"# {project}", "", "| " + " | ".join(["source", "clips", "minutes", *[PROBES[c][0] for c in probes]]) + " |", "|-|-|-|" + "-|" * len(probes))
    for r in sources.orderBy("source_id").toLocalIterator():
        yield f"| {r['source_id']} | {r['clips']} | {r['ms'] / 60000:.2f} |" + "".join(f" {PROBES[c][1](r[c])} |" for c in probes)
    if summary is not None:
        s = summary.first().asDict(recursive=True)
        yield from ("", f"- clips: {s['clips']}", f"- hours: {s['total_hours']} ({s['total_seconds']} s)", f"- mean duration: {s['mean_duration']} s")
        for k, head in (("duration_percentiles", "seconds"), ("chars_percentiles", "characters")):
            yield f"- {head}: " + ", ".join(f"{n} {v}" for n, v in (s[k] or {}).items())
        yield f"- train, val: {s['train']}, {s['val']}"
    yield from ("", "| reason | clips |", "|-|-|")
    for r in reasons.toLocalIterator():
        yield f"| {r['reason']} | {r['n']} |"
    yield from ("", "| stage | seconds |", "|-|-|", *[f"| {k} | {v:.1f} |" for k, v in timings.items()])


def report(project: str, sources: DataFrame, reasons: DataFrame, timings: dict[str, float], summary: DataFrame | None = None) -> str:
    """The page as a whole; write_report holds a line at a time."""
    return "\n".join(report_lines(project, sources, reasons, timings, summary)) + "\n"


def write_report(path: str, project: str, sources: DataFrame, reasons: DataFrame, timings: dict[str, float], summary: DataFrame | None = None) -> None:
    """The page as a file of the driver, written line by line."""
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(x + "\n" for x in report_lines(project, sources, reasons, timings, summary))
