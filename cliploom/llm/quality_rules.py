"""Quality rules: an ordered decision list learned from labelled statistics.

Sequential covering for the label 0: a rule grows by the threshold condition of greatest FOIL gain until it covers no
good row of the growing part, is cut back to the prefix that does best on the pruning part, and is kept while it is
right there often enough; the rows that it covers are then set aside. The rules become one ordered Spark conditional.

Statistics are of whole texts; a null text has no words and all its statistics are 0. Labels that are null, or of
documents that are absent, are ignored; a document with several labels counts once for each. Without labels of both
kinds there are no rules and only the base limits decide. Of conditions of equal gain the first feature's lowest threshold is taken, of
prefixes that do equally well the shortest, and labelled rows of equal hash stand in order of id. Repeated rows each get their row, an
empty table none; a text longer than a slab is one slab. Extra columns, whatever their names, are kept by `keep_good` and ignored otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from .columns import SPACE_LIKE, U, Words, covered, separators, slabs, text_buffer
from .frames import free_name, named, numbered, quoted
from .labelled import labelled_rows

#: The statistics that the base limits and the result use, and those that only rules use.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_marks", "n_lines")
SYMBOLS = b"#*$%&|<>"
STATS = "struct<" + ",".join(f"{c}:bigint" for c in BASE + MORE) + ">"


def _count_bytes(x: np.ndarray, offs: np.ndarray, table: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(table[x])][offs])


def statistics(col) -> pa.StructArray:
    """The statistics of each text of an Arrow column."""
    buf, offs = text_buffer(col)
    sep = separators(SPACE_LIKE)
    symbols, marks, upper, newline = (separators(t) for t in (SYMBOLS, b"!?.,;:\"'()[]{}/\\@^_`~+=-", range(0x41, 0x5B), b"\n"))
    chars = ~sep
    chars[0x80:0xC0] = False  # continuation bytes
    out: list[list[np.ndarray]] = [[] for _ in BASE + MORE]
    for x, y in slabs(offs):
        b, o = buf[offs[x] : offs[y]], offs[x : y + 1] - offs[x]
        w = Words(b, o, sep)
        g, ok = w.grams(3)
        at = np.flatnonzero(ok)
        key = g[at] ^ (w.row[at].astype(U) * U(0x9E3779B97F4A7C15))
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        again = at[count[back] > 1]
        mask = covered(len(w.start), again, again + 3)
        raw = b.tobytes()
        dup = np.zeros(y - x, np.int64)
        for i, (s, e) in enumerate(zip(o[:-1].tolist(), o[1:].tolist(), strict=True)):
            lines = [t for t in raw[s:e].split(b"\n") if t.strip()]
            dup[i] = len(lines) - len(set(lines))
        for c, v in zip(out, (w.count, _count_bytes(b, o, chars), _count_bytes(b, o, symbols), dup, np.diff(np.r_[0, np.cumsum(mask)][w.first]), _count_bytes(b, o, upper), _count_bytes(b, o, marks), _count_bytes(b, o, newline) + (np.diff(o) > 0)), strict=True):
            c.append(v)
    return pa.StructArray.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out], names=list(BASE + MORE))


def with_statistics(docs: DataFrame, text_col: str, name: str, keep_text: bool = True) -> DataFrame:
    """docs with a struct column of statistics."""
    names = [c for c in docs.columns if keep_text or c != text_col]
    source = numbered(docs.select(*[named(docs, c) for c in names], named(docs, text_col).cast("string").alias(name)))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], statistics(b.columns[-1])], names=b.schema.names)

    stats = StructField(source.columns[-1], _parse_datatype_string(STATS))
    return source.mapInArrow(run, StructType([*source.schema.fields[:-1], stats])).toDF(*names, name)


#: Features of rules: statistics per word, so that the length of a text does not decide alone.
FEATURES = {"n_words": ("n_words", None), "chars_per_word": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"), "dup_lines_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"), "upper_share": ("n_upper", "word_chars"), "marks_per_word": ("n_marks", "n_words")}


def feature_columns(stats: str) -> dict[str, Column]:
    s = lambda c: F.col(f"`{stats}`.{c}").cast("double")
    return {k: s(a) if b is None else F.when(s(b) > 0, s(a) / s(b)).otherwise(F.lit(0.0)) for k, (a, b) in FEATURES.items()}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


class DecisionList:
    """Ordered rules, each a conjunction; a row that any covers is bad."""

    def __init__(self, rules: list[tuple[Condition, ...]]):
        self.rules = rules

    def column(self, stats: str) -> Column:
        """The number of the first rule that covers the row, from 1; 0 for none."""
        f, out = feature_columns(stats), None
        for n, rule in enumerate(self.rules, 1):
            test = F.lit(True)
            for c in rule:
                test = test & (f[c.feature] >= F.lit(c.threshold) if c.above else f[c.feature] <= F.lit(c.threshold))
            out = F.when(test, F.lit(n)) if out is None else out.when(test, F.lit(n))
        return F.lit(0) if out is None else out.otherwise(F.lit(0))

    def __str__(self) -> str:
        return "\n".join([*(f"{n}. reject if {' and '.join(map(str, r))}" for n, r in enumerate(self.rules, 1)), "otherwise keep"])


def _covers(rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    mask = np.ones(n, bool)
    for c in rule:
        mask &= x[c.feature] >= c.threshold if c.above else x[c.feature] <= c.threshold
    return mask


def learn(x: dict[str, np.ndarray], bad: np.ndarray, part: np.ndarray, cuts: int = 64, max_rules: int = 24, max_conditions: int = 5, precision: float = 0.9) -> DecisionList:
    """x: features; bad: what rules should cover; part: True for growing, False for pruning."""
    alive, rules = np.ones(len(bad), bool), []
    points = {k: np.unique(np.quantile(v, np.linspace(0, 1, cuts + 1), method="nearest")) for k, v in x.items()} if len(bad) else {}
    middle = {k: (p[1:] + p[:-1]) / 2 for k, p in points.items()}
    while len(rules) < max_rules and (bad & alive & part).sum() >= 3 and (bad & alive & ~part).any():
        rule: list[Condition] = []
        mask = alive & part
        while len(rule) < max_conditions and (mask & ~bad).any():
            p0, n0 = int((mask & bad).sum()), int((mask & ~bad).sum())
            best, gain = None, 1e-9
            for k, mids in middle.items():
                if not len(mids):
                    continue
                place = np.searchsorted(mids, x[k][mask])
                p = np.bincount(place[bad[mask]], minlength=len(mids) + 1)
                n = np.bincount(place[~bad[mask]], minlength=len(mids) + 1)
                below_p, below_n = np.cumsum(p)[:-1], np.cumsum(n)[:-1]
                for above, pp, nn in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
                    with np.errstate(divide="ignore", invalid="ignore"):
                        g = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - np.log2(p0 / (p0 + n0))), -1)
                    i = int(np.argmax(g))
                    if g[i] > gain:
                        best, gain = Condition(k, above, float(mids[i])), g[i]
            if best is None:
                break
            rule.append(best)
            mask &= _covers([best], x, len(bad))
        test = alive & ~part
        scores = []
        for n in range(1, len(rule) + 1):
            m = test & _covers(rule[:n], x, len(bad))
            p, q = int((m & bad).sum()), int((m & ~bad).sum())
            scores.append(((p - q) / (p + q) if p + q else -1.0, p / (p + q) if p + q else 0.0))
        if not scores:
            break
        n = max(range(len(scores)), key=lambda i: (scores[i][0], -i))
        if scores[n][1] < precision:
            break
        rule = rule[: n + 1]
        rules.append(tuple(rule))
        alive &= ~_covers(rule, x, len(bad))
    return DecisionList(rules)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label: str = "quality", **options) -> DecisionList:
    """Rules from at most max_labelled labelled rows, those of least hash, each but once; the driver gets their numbers only. Documents that the base limits reject teach nothing."""
    marks = labels.select(named(labels, label_id).cast("long").alias("doc_id"), named(labels, label).cast("int").alias("mark"))
    rows = labelled_rows(docs, marks, max_labelled, id_col, text_col)
    found = with_statistics(rows, "text", "_stats", keep_text=False).where(~base_failed("_stats")).select("mark", (F.pmod("order", F.lit(3)) > 0).alias("grow"), "order", *[c.alias(k) for k, c in feature_columns("_stats").items()]).orderBy("order").toPandas()
    bad = (found["mark"] == 0).to_numpy(bool)
    if not len(bad) or bad.all() or not bad.any():
        return DecisionList([])
    return learn({k: found[k].to_numpy(float) for k in FEATURES}, bad, found["grow"].to_numpy(bool), **options)


def base_failed(stats: str) -> Column:
    s = lambda c: F.col(f"`{stats}`.{c}")
    return (s("n_words") < 50) | (100 * s("n_repeat_words") > 50 * s("n_words"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept and rule (the number of the rule that rejects, 0 for none). No shuffle of documents."""
    rules = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    x = with_statistics(docs.select(named(docs, id_col).cast("long").alias("doc_id"), named(docs, text_col).alias("text")), "text", "_stats", keep_text=False)
    rule = rules.column("_stats")
    return x.select("doc_id", *[f"_stats.{c}" for c in BASE], base_failed("_stats").alias("base_failed"), (~base_failed("_stats") & (rule == 0)).alias("kept"), rule.alias("rule"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that are kept, all columns as they are."""
    rules = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    name = free_name(docs, "_stats")
    x = with_statistics(docs, text_col, name)
    return x.where(~base_failed(name) & (rules.column(name) == 0)).select(*[quoted(c) for c in docs.columns])
