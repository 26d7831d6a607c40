"""Conversations brought into the order `(system? (user assistant)+)?` by the cheapest edits, with an audit of them.

An edit keeps a row (0), gives it the role user or assistant (1), deletes it (2; the only one for blank rows and repeats) or inserts a
row without text (5); a truncated row that stays adds 5. What is left to pay from each of the four grammar states is a vector. Vectors, less
their minimum, are the states of a deterministic automaton that is built as it is needed: its transition table is kept by
the worker, so a row costs one look-up. The table is scanned from a conversation's last row to its first, which gives costs; the trace
goes back over tight arcs, those on which nothing is lost, from the first row to the last, and takes the edit of least initial. An initial
and a grammar state have one successor each, so that gives the least audit of all cheapest ones.

Rows are sorted by (conversation, turn, role, digest of role and text) in range partitions, so that a conversation of any size lies over as many
tasks as it needs. A conversation inside a task is finished there. The first and last ones of a task, and runs of more than MOST_ROWS rows,
become fragments: each gives the least cost between any two grammar states, costs are chained over a conversation's fragments (a row each),
then the states in which the trace passes from fragment to fragment, and each fragment is traced by itself. Repeats are
found by the least turn of each (conversation, role, text), aggregated beside and merged in by the same sort.

Nulls of role and text are one space. A role by whose initial no state goes on can't be kept. Rows of equal turn are in order of role and
then of the digest; null turns come first; a null conversation is one as any other. Copies of a row are counted before they are sent. A text
of any length is a value of its row. Extra columns, whatever their names, are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import memo
from .frames import named, settled

#: Rows and bytes of text of a fragment.
MOST_ROWS, MOST_BYTES = 20_000, 4 << 20
RETYPE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
#: Grammar states: before all, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
#: What an inserted or retyped row becomes, by the state before it.
TURN = ("u", "u", "a", "u")
ROLE = {"u": "user", "a": "assistant"}
FAR = 1 << 60
FINE, GONE, CUT = 0, 1, 2
#: Symbols: a row that must go, or one of each initial, whole or truncated.
INITIALS = "sua?"
SYMBOLS = [("?", GONE), *((r, f) for f in (FINE, CUT) for r in INITIALS)]
NUMBER = {s: i for i, s in enumerate(SYMBOLS)}
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def symbol(initial: str, fault: int) -> int:
    return 0 if fault == GONE else NUMBER[initial if initial in NEXT else "?", fault]


class Repairs:
    """The automaton. A state is a normalised vector of costs that are left to pay; reading goes from the last row to the first."""

    def __init__(self):
        self.vectors: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.table: list[tuple[int, int] | None] = []
        self.arcs: dict[tuple[int, int, int], tuple[str, int]] = {}
        self.end = self.state(tuple(self._inserted([0, FAR, FAR, 0])))[0]
        self.units = [self.state(tuple(0 if q == e else FAR for q in range(4)))[0] for e in range(4)]

    def state(self, costs: tuple) -> tuple[int, int]:
        """(number of the state, what all costs have in common)."""
        low = min(costs)
        v = tuple(min(FAR, c - low) if c < FAR else FAR for c in costs)
        if v not in self.number:
            self.number[v] = len(self.vectors)
            self.vectors.append(v)
            self.table += [None] * len(SYMBOLS)
        return self.number[v], low

    @staticmethod
    def _inserted(costs: list) -> list:
        """The same, if rows may first be inserted."""
        for _ in range(2):
            costs = [min(c, INSERT + costs[NEXT[TURN[q]][q]]) for q, c in enumerate(costs)]
        return costs

    @staticmethod
    def _edits(q: int, sym: int):
        """(initial, cost, next state) of the edits of a row."""
        initial, fault = SYMBOLS[sym]
        yield "D", DELETE, q
        if fault != GONE:
            late = CUT_OFF if fault == CUT else 0
            if initial in NEXT and NEXT[initial][q] is not None:
                yield "K", late, NEXT[initial][q]
            yield "R", RETYPE + late, NEXT[TURN[q]][q]

    def back(self, state: int, sym: int) -> tuple[int, int]:
        """(state before the row, what is added to all its costs)."""
        at = state * len(SYMBOLS) + sym
        found = self.table[at]
        if found is None:
            v = self.vectors[state]
            found = self.table[at] = self.state(tuple(self._inserted([min(c + v[to] for _, c, to in self._edits(q, sym)) for q in range(4)])))
        return found

    def scan(self, symbols: bytes, state: int) -> tuple[list[int], int]:
        """States before each row and after the last, and what is added in all."""
        out, total, table, width = [state], 0, self.table, len(SYMBOLS)
        for sym in reversed(symbols):
            found = table[state * width + sym] or self.back(state, sym)
            state = found[0]
            total += found[1]
            out.append(state)
        out.reverse()
        return out, total

    def costs(self, symbols: bytes) -> list[int]:
        """Least cost from each state before the rows to each one after them, 16 numbers."""
        ends = [self.scan(symbols, u) for u in self.units]
        return [min(FAR, self.vectors[s[0]][q] + total) for q in range(4) for s, total in ends]

    def arc(self, after: int, sym: int, q: int) -> tuple[str, int]:
        """(initials of inserted rows and of the row's own edit, next state) of the least tight arcs at a row, the state after it being `after`."""
        key = (after, sym, q)
        if key not in self.arcs:
            v = self.vectors[after]
            before, low = self.back(after, sym)
            here, text = [c + low for c in self.vectors[before]], ""
            while True:
                tight = [(e, to, False) for e, c, to in self._edits(q, sym) if c + v[to] == here[q]]
                on = NEXT[TURN[q]][q]
                if INSERT + here[on] == here[q]:
                    tight.append(("I", on, True))
                e, q, more = min(tight)
                text += e
                if not more:
                    break
            self.arcs[key] = text, q
        return self.arcs[key]

    def trace(self, symbols: bytes, states: list[int], q: int) -> tuple[list[str], int]:
        """Initials at each row and the state after them."""
        out, arcs = [], self.arcs
        for i, sym in enumerate(symbols):
            text, q = arcs.get((states[i + 1], sym, q)) or self.arc(states[i + 1], sym, q)
            out.append(text)
        return out, q

    def tail(self, q: int) -> str:
        """Rows inserted after the last."""
        return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[q]


def repairs() -> Repairs:
    return memo("repairs", Repairs)


class Run(NamedTuple):
    """Rows of one conversation: symbols of all; roles and texts of those that need not go."""

    symbols: bytes
    roles: list
    texts: list


def repaired(run: Run, edits: list[str], tail: str, q: int) -> tuple[list[str], int]:
    """(role:text of what is left and inserted, cost) from the state before the rows."""
    lines, cost, rows = [], 0, iter(zip(run.roles, run.texts, strict=True))
    for sym, text in zip([*run.symbols, None], [*edits, tail], strict=True):
        role, words = next(rows) if sym else ("", "")
        for e in text:
            if e == "D":
                cost += DELETE
                continue
            late = CUT_OFF if e != "I" and SYMBOLS[sym][1] == CUT else 0
            cost += {"K": 0, "R": RETYPE, "I": INSERT}[e] + late
            now = role if e == "K" else ROLE[TURN[q]]
            lines.append(f"{now}:{'' if e == 'I' else words}")
            q = NEXT[now[:1]][q]
    return lines, cost


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", kinds: int = 20) -> DataFrame:
    """(conv_id, turn, role, text, copies) with faults by crc32 of conversation and turn: 0 drops a row (copies is 0), 1 empties it, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's."""
    conv, turn = named(rows, conv_col), named(rows, turn_col)
    role, text = (F.coalesce(named(rows, c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    kind = F.crc32(F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))) % kinds
    return rows.select(
        conv.alias("conv_id"), turn.cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def repair_table(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None) -> DataFrame:
    """A row for each conversation: faults, cost, audit and a digest of what is repaired; `lines` has the repaired rows as role:text, null where the conversation lies in fragments.

    copies_col: how often a row stands there; 0 for a row that only tells of its conversation.
    """
    whole, kind = _scanned(rows, conv_col, turn_col, role_col, text_col, copies_col)
    done = whole.where("lines is not null").select("conv_id", *COUNTS, "audit", "repaired_sha256", "lines")
    return done.unionByName(_joined(_pieces(whole, kind), kind).withColumn("lines", F.lit(None).cast("array<string>")))


def repaired_rows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None) -> DataFrame:
    """(conv_id, part, k, role, text): the repaired conversations, in order of (part, k)."""
    whole, kind = _scanned(rows, conv_col, turn_col, role_col, text_col, copies_col)
    parts = whole.where("lines is not null").select("conv_id", F.lit(0).cast("long").alias("part"), "lines").unionByName(_pieces(whole, kind).select("conv_id", (F.shiftleft(F.col("part").cast("long"), 32) + F.col("seq")).alias("part"), "lines"))
    line = parts.select("conv_id", "part", F.posexplode("lines").alias("k", "line"))
    at = F.instr("line", ":")
    return line.select("conv_id", "part", "k", F.substring("line", F.lit(1), at - 1).alias("role"), F.substring("line", at + 1, F.length("line")).alias("text"))


def _scanned(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies_col: str | None) -> tuple[DataFrame, str]:
    kind = named(rows, conv_col)
    copies = named(rows, copies_col).cast("long") if copies_col else F.lit(1).cast("long")
    role, text = (F.coalesce(named(rows, c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    base = rows.select(kind.alias("conv_id"), named(rows, turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("copies"))
    kind = base.schema["conv_id"].dataType.simpleString()
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    counted = base.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(bare == "", 1).when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(2)
    full = counted.select("conv_id", "turn", "role", digest.alias("h"), F.lit(1).alias("main"), "text", "copies", fault.cast("byte").alias("fault"))
    # The first row of each (conversation, role, text) is announced by a row without text that sorts before it.
    seen = base.where("copies > 0").select("conv_id", "turn", "role", digest.alias("h")).groupBy("conv_id", "role", "h").agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("none"))
    first = seen.select("conv_id", F.when(~F.col("none"), F.col("least")).alias("turn"), "role", "h", F.lit(0).alias("main"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"), F.lit(0).cast("byte").alias("fault"))
    key = ["conv_id", "turn", "role", "h"]
    ordered = full.unionByName(first).repartitionByRange(*key).sortWithinPartitions(*key, "main")
    schema = _arrow(_schema(kind))
    return settled(ordered.mapInArrow(lambda b: _scan(b, schema), _schema(kind)), "conversations"), kind


def _schema(kind: str) -> str:
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return f"conv_id {kind}, {counts}, audit string, repaired_sha256 string, lines array<string>, part int, seq int, symbols binary, roles array<string>, texts array<string>, least long, most long, turns long, head string, last string, costs array<long>"


class _Fragment:
    def __init__(self):
        self.symbols, self.roles, self.texts, self.size = bytearray(), [], [], 0
        self.n = dict.fromkeys(COUNTS, 0)
        self.least = self.most = self.head = self.last = None
        self.turns = 0

    def add(self, turn, role: str, text: str, fault: int, times: int) -> None:
        """times rows; fault: 0 none, 1 blank, 2 truncated, 3 duplicate."""
        initial = role[:1]
        self.n["illegal"] += (self.last is not None and self.last + initial not in ("su", "ua", "au")) + (times - 1 if initial * 2 not in ("su", "ua", "au") else 0)
        self.head, self.last = initial if self.head is None else self.head, initial
        if turn is not None:
            self.turns += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        if fault:
            self.n[("", "blank", "truncated", "duplicate")[fault]] += times
        sym = symbol(initial, (FINE, GONE, CUT, GONE)[fault])
        self.symbols += bytes([sym]) * times
        if sym:
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(text)

    def full(self) -> bool:
        return len(self.symbols) >= MOST_ROWS or self.size >= MOST_BYTES

    def row(self, conv, part: int, seq: int) -> dict:
        return {"conv_id": conv, **self.n, "part": part, "seq": seq, "symbols": bytes(self.symbols), "roles": self.roles, "texts": self.texts, "least": self.least, "most": self.most, "turns": self.turns, "head": self.head, "last": self.last, "costs": repairs().costs(bytes(self.symbols))}

    def finished(self, conv) -> dict:
        auto, run = repairs(), Run(bytes(self.symbols), self.roles, self.texts)
        states, _ = auto.scan(run.symbols, auto.end)
        edits, q = auto.trace(run.symbols, states, START)
        lines, cost = repaired(run, edits, auto.tail(q), START)
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        return {"conv_id": conv, **self.n, "gaps": gaps, "cost": cost, "audit": "".join(edits) + auto.tail(q), "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(), "lines": lines}


def _scan(batches, schema: pa.Schema):
    """Finished conversations, and fragments of the first and last one and of long ones."""
    part, seq, at_start, now, found, key, size = TaskContext.get().partitionId(), 0, True, None, None, None, 0
    out: list[dict] = []
    split = False

    def close(final: bool) -> None:
        nonlocal seq, size
        if split or at_start or final:
            out.append(found.row(now, part, seq))
            seq += 1
            size += found.size
        else:
            out.append(found.finished(now))
            size += found.size

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(8)]
        for conv, turn, role, h, main, text, copies, fault in zip(*columns, strict=True):
            if found is None or conv != now:
                if found is not None:
                    close(False)
                    at_start = False
                now, found, split = conv, _Fragment(), False
            if not main:
                key = (conv, turn, role, h)
                continue
            first = key == (conv, turn, role, h)
            while copies > 0:
                if found.full():
                    split = True
                    close(False)
                    found = _Fragment()
                n = 1 if first and fault != 1 else min(copies, MOST_ROWS)
                found.add(turn, role, text, fault if first or fault == 1 else 3, n)
                copies, first = copies - n, False
            if len(out) >= 2000 or size >= MOST_BYTES:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
    if found is not None:
        close(True)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _arrow(ddl: str) -> pa.Schema:
    """Of the driver: reading a schema's text takes the session."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _pieces(whole: DataFrame, kind: str) -> DataFrame:
    """Fragments with their edits: (conv_id, part, seq, counts, what the ends of a fragment show, audit, lines)."""
    cut = whole.where("lines is null")

    def left(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: (r["part"], r["seq"]), reverse=True)
        auto, out = repairs(), []
        costs = list(auto.vectors[auto.end])
        for r in rows:
            out.append({"part": r["part"], "seq": r["seq"], "left": costs})
            costs = [min(FAR, *(r["costs"][4 * q + e] + costs[e] for e in range(4))) for q in range(4)]
            low = min(costs)
            costs = [min(FAR, c - low) if c < FAR else FAR for c in costs]
        return pa.Table.from_pylist(out, pa.schema({"part": pa.int32(), "seq": pa.int32(), "left": pa.list_(pa.int64())}))

    after = cut.select("conv_id", "part", "seq", "costs").groupBy("conv_id").applyInArrow(left, "part int, seq int, left array<long>")
    known = cut.join(after, ["part", "seq"])
    led = f"conv_id {kind}, part int, seq int, to array<int>"
    led_arrow = _arrow(led)

    def passed(batches):
        for b in batches:
            auto, out = repairs(), []
            for r in b.to_pylist():
                states, _ = auto.scan(r["symbols"], auto.state(tuple(r["left"]))[0])
                out.append({"conv_id": r["conv_id"], "part": r["part"], "seq": r["seq"], "to": [auto.trace(r["symbols"], states, q)[1] if auto.vectors[states[0]][q] < FAR else q for q in range(4)]})
            yield pa.RecordBatch.from_pylist(out, led_arrow)

    def begun(t: pa.Table) -> pa.Table:
        out, q = [], START
        for r in sorted(t.to_pylist(), key=lambda r: (r["part"], r["seq"])):
            out.append({"part": r["part"], "seq": r["seq"], "begin": q})
            q = r["to"][q]
        for r in out:
            r["final"] = r is out[-1]
        return pa.Table.from_pylist(out, pa.schema({"part": pa.int32(), "seq": pa.int32(), "begin": pa.int32(), "final": pa.bool_()}))

    starts = known.select("conv_id", "part", "seq", "symbols", "left").mapInArrow(passed, led).groupBy("conv_id").applyInArrow(begun, "part int, seq int, begin int, final boolean")
    shown = "least long, most long, turns long, head string, last string"
    schema = f"conv_id {kind}, part int, seq int, {', '.join(f'{c} long' for c in COUNTS)}, {shown}, audit string, lines array<string>"
    arrow = _arrow(schema)

    def traced(batches):
        for b in batches:
            auto, out = repairs(), []
            for r in b.to_pylist():
                run = Run(r["symbols"], r["roles"], r["texts"])
                states, _ = auto.scan(run.symbols, auto.state(tuple(r["left"]))[0])
                edits, q = auto.trace(run.symbols, states, r["begin"])
                tail = auto.tail(q) if r["final"] else ""
                lines, cost = repaired(run, edits, tail, r["begin"])
                out.append({k: r[k] for k in ("conv_id", "part", "seq", *COUNTS, "least", "most", "turns", "head", "last")} | {"cost": cost, "audit": "".join(edits) + tail, "lines": lines})
            yield pa.RecordBatch.from_pylist(out, arrow)

    return known.join(starts, ["part", "seq"]).select("conv_id", "part", "seq", *COUNTS, *[x.split()[0] for x in shown.split(", ")], "symbols", "roles", "texts", "left", "begin", "final").mapInArrow(traced, schema)


def _joined(pieces: DataFrame, kind: str) -> DataFrame:
    """A row for each conversation that lies in fragments: streamed in order, one fragment at a time."""
    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string"
    arrow = _arrow(schema)

    def run(batches):
        now, first = None, True

        def row() -> pa.RecordBatch:
            n["gaps"] = most - least + 1 - turns if turns else 0
            return pa.RecordBatch.from_pylist([{"conv_id": now, **n, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], arrow)

        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                if first or r["conv_id"] != now:
                    if not first:
                        yield row()
                    now, first, n, audit, sha, any_line = r["conv_id"], False, dict.fromkeys(COUNTS, 0), [], hashlib.sha256(), False
                    least = most = last = None
                    turns = 0
                for c in COUNTS:
                    n[c] += r[c]
                if r["head"] is not None:
                    n["illegal"] += last is not None and last + r["head"] not in ("su", "ua", "au")
                    last = r["last"]
                if r["turns"]:
                    turns += r["turns"] - (r["least"] == most)
                    least, most = r["least"] if least is None else least, r["most"]
                audit.append(r["audit"])
                if r["lines"]:
                    sha.update((("\n" if any_line else "") + "\n".join(r["lines"])).encode())
                    any_line = True
        if not first:
            yield row()

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(run, schema)


