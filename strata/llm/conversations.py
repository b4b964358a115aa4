"""Conversation structure repair by a run-length dynamic program.

A conversation is repaired by the cheapest edits that give it the role
initials ``(s?(ua)+)?``.  Its rows, in order, are symbols: what their role's
initial and their first fault allow.  The edits walk through four states
(nothing said yet, after the system, after the user, after the assistant),
so a symbol is a 4 x 4 matrix of costs in the min-plus algebra, with
insertions before the row included, and a run of n equal symbols is its
n-th power, found from cached binary powers.

Backward over the runs this gives the cost that is left at each run's end;
forward, the first edit in the order of the letters that keeps to it is the
least audit among the cheapest.

Rows are range-partitioned by conversation and turn.  The part of a
conversation that lies in one task is a segment.  Only a task's first and
last conversation can go on in another task: their segments are reduced to
one matrix each, the matrices of a conversation give the cost left at every
segment's end, each segment is unrolled from all four states, and the chain
of states picks the one that happens.  So a conversation of any length is
repaired in parallel, without its text.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.storage import cut

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3   # costs
_INF = 1 << 50
_STATES = range(4)        # 0: nothing said, 1: after the system, 2: after the user, 3: after the assistant
_AFTER = (2, 2, 3, 2)     # the state after an inserted or reroled row
_SAID = {2: "u", 3: "a"}
_ROLE = {"u": "user", "a": "assistant"}
_BLANKS = " \t\n\x0b\x0c\r"


def _keeps(symbol: str, state: int) -> int | None:
    """The state after keeping a row, if its initial may follow."""
    follows = {"s": (0,), "u": (0, 1, 3), "a": (2,)}.get(symbol.lower(), ())
    return {"s": 1, "u": 2, "a": 3}[symbol.lower()] if state in follows else None


def _edits(symbol: str, state: int):
    """(cost, code, next state) of the edits that use up a row.  Codes: D;
    K; U and A, a row made the user's or the assistant's."""
    yield DELETE, "D", state
    if symbol in "bd":                       # blank and duplicate rows must go
        return
    extra = TRUNCATED if symbol.isupper() else 0
    kept = _keeps(symbol, state)
    if kept is not None:
        yield KEEP + extra, "K", kept
    yield REROLE + extra, _SAID[_AFTER[state]].upper(), _AFTER[state]


def product(a: tuple, b: tuple) -> tuple:
    """Min-plus product of two matrices, or of a matrix and a vector."""
    if isinstance(b[0], tuple):
        return tuple(tuple(min(a[i][k] + b[k][j] for k in _STATES) for j in _STATES) for i in _STATES)
    return tuple(min(a[i][k] + b[k] for k in _STATES) for i in _STATES)


def _inserting() -> tuple:
    """Costs of insertions alone, between every two states."""
    cost = [[0 if i == j else _INF for j in _STATES] for i in _STATES]
    for i in _STATES:
        state, spent = i, 0
        for _ in range(3):
            state, spent = _AFTER[state], spent + INSERT
            cost[i][state] = min(cost[i][state], spent)
    return tuple(map(tuple, cost))


INSERTING = _inserting()
ONE = tuple(tuple(0 if i == j else _INF for j in _STATES) for i in _STATES)
END = product(INSERTING, (0, _INF, _INF, 0))     # cost left after the last row


_powers: dict = {}
_unrolled: dict = {}


def power(symbol: str, bit: int) -> tuple:
    """The transition of 2^bit equal symbols."""
    if (symbol, bit) not in _powers:
        if bit:
            half = power(symbol, bit - 1)
            _powers[symbol, bit] = product(half, half)
        else:
            step = [[_INF] * 4 for _ in _STATES]
            for i in _STATES:
                for cost, _, j in _edits(symbol, i):
                    step[i][j] = min(step[i][j], cost)
            _powers[symbol, bit] = product(INSERTING, tuple(map(tuple, step)))
    return _powers[symbol, bit]


def advance(symbol: str, n: int, right: tuple) -> tuple:
    """A run of ``n`` symbols applied to the costs (or matrix) after it."""
    bit = 0
    while n:
        if n & 1:
            right = product(power(symbol, bit), right)
        n, bit = n >> 1, bit + 1
    return right


def runs_of(items) -> list:
    """(symbol, rows) with equal neighbours collapsed."""
    out: list = []
    for symbol, n in items:
        if out and out[-1][0] == symbol:
            out[-1][1] += n
        else:
            out.append([symbol, n])
    return out


def unroll(items: tuple, left: tuple, last: bool, state: int) -> tuple:
    """Cheapest edits of the rows ``items`` ((symbol, rows) each) from
    ``state``, if ``left`` is the cost left after them: one code per item,
    and the state reached.  A code is what is inserted before (u, a), the
    row's own letter, and after the conversation's last row what is inserted
    there."""
    runs = runs_of(items)
    ends = [left] * len(runs)
    for i in range(len(runs) - 1, 0, -1):
        ends[i - 1] = advance(*runs[i], ends[i])
    codes, at, rest = [], 0, runs[0][1] if runs else 0
    for symbol, n in items:
        if not rest:
            at, rest = at + 1, runs[at + 1][1]
        rest -= n
        after = advance(symbol, rest, ends[at])          # cost left once these rows are done
        if n > 1:                                        # only rows that must go come in numbers
            codes.append("D" * n)
            continue
        code = ""
        while True:
            here = product(power(symbol, 0), after)[state]
            choices = [(letter, c, s) for c, letter, s in _edits(symbol, state) if c + after[s] == here]
            go = next((x for x in choices if x[0] == "D"), None)
            inserted = _AFTER[state]
            if go is None and INSERT + product(power(symbol, 0), after)[inserted] == here:
                code, state = code + _SAID[inserted], inserted
                continue
            letter, _, state = go or choices[0]          # K comes before a rerole
            code += letter
            break
        codes.append(code)
    if last and codes:
        while state not in (0, 3):
            state = _AFTER[state]
            codes[-1] += _SAID[state]
    return tuple(codes), state


def _unroll_known(*what) -> tuple:
    """``unroll``, with the results for short conversations remembered."""
    if len(what[0]) > 32:
        return unroll(*what)
    if what not in _unrolled:
        if len(_unrolled) >= 1 << 14:
            _unrolled.clear()
        _unrolled[what] = unroll(*what)
    return _unrolled[what]


def symbols(role: Column, text: Column) -> Column:
    """A row's symbol before duplicates are known: the role's initial (o:
    another), upper case if truncated, b if blank."""
    initial = F.substring(role, 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    bare = F.rtrim(text, F.lit(_BLANKS))
    return (F.when(bare == "", "b").when(F.substring(bare, -1, 1).isin(".", "!", "?"), initial)
            .otherwise(F.upper(initial)))


def _name(role: Column, text: Column) -> Column:
    """128 bits that stand for (role, text)."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def _items(symbol: str, n: int):
    """A row that comes ``n`` times: all but the first are duplicates."""
    return ((symbol, 1),) if n == 1 else ((symbol, 1), ("b" if symbol == "b" else "d", n - 1))


def _by_conversation(batches):
    """(conversation key, rows) of a sorted partition, one after another;
    a row is (turn, name, symbol, n)."""
    key, rows = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "part", "turn", "name", "symbol", "n", "left", "last")]
        for conv, part, turn, name, symbol, n, left, last in zip(*columns):
            new = (conv, part, tuple(left) if left else None, last)
            if key is not None and key[0] != conv:
                yield key, rows
                rows = []
            key = new
            rows.append((turn, name, symbol, n))
    if key is not None:
        yield key, rows


def _matrix_task(batches):
    """The matrix of the first and of the last segment of a partition."""
    def flush(key, matrix, place):
        return {"conv": key[0], "part": key[1], "m": [x for row in matrix for x in row], "place": place}
    key, matrix, first, run = None, ONE, None, None
    for batch in batches:
        for conv, part, symbol, n in zip(*[batch.column(c).to_pylist() for c in ("conv", "part", "symbol", "n")]):
            if key is not None and key[0] != conv:
                if first is None:
                    first = flush(key, product(matrix, advance(*run, ONE)), 0)
                matrix, run = ONE, None
            key = (conv, part)
            for s, c in _items(symbol, n):
                if run and run[0] == s:
                    run = (s, run[1] + c)
                else:
                    matrix, run = (product(matrix, advance(*run, ONE)) if run else matrix), (s, c)
    if key is not None:
        out = ([first] if first else []) + [flush(key, product(matrix, advance(*run, ONE)), 1)]
        kind = batch.schema.field("conv").type
        yield pa.RecordBatch.from_pylist(out, pa.schema([
            ("conv", kind), ("part", pa.int64()), ("m", pa.list_(pa.int64())), ("place", pa.int32())]))


def _costs_left(segments: pd.DataFrame) -> pd.DataFrame:
    """One conversation's segments: the cost left after each."""
    segments = segments.sort_values("part")
    left, out = END, []
    for m in reversed(segments["m"].tolist()):
        out.append(list(left))
        left = product(tuple(tuple(int(x) for x in m[4 * i:4 * i + 4]) for i in _STATES), left)
    return pd.DataFrame({"conv": segments["conv"], "part": segments["part"], "left": out[::-1],
                         "last": [False] * (len(out) - 1) + [True]})


def _unroll_task(batches):
    """Codes of every row; segments that may have a beginning elsewhere are
    unrolled from every state."""
    out: list = []
    for key, rows in _by_conversation(batches):
        conv, part, left, last = key
        items = tuple(i for _, _, symbol, n in rows for i in _items(symbol, n))
        for state in (_STATES if left else (0,)):
            codes, reached = _unroll_known(items, left or END, last is not False, state)
            codes, at = list(codes), 0
            for i, (turn, name, symbol, n) in enumerate(rows):
                width = 1 if n == 1 else 2
                out.append((conv, part, state, turn, name, symbol, n, "".join(codes[at:at + width]),
                            reached if left and i == len(rows) - 1 else None))
                at += width
        if len(out) >= 10_000:
            yield out
            out = []
    yield out


def _unroll(kind):
    names = ("conv", "part", "entry", "turn", "name", "symbol", "n", "code", "reached")
    types = (kind, pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32())

    def run(batches):
        for rows in _unroll_task(batches):
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)
    return run


def _chain(segments: pd.DataFrame) -> pd.DataFrame:
    """The state in which each segment of one conversation begins."""
    state, out = 0, []
    step = {(p, e): r for p, e, r in zip(segments["part"], segments["entry"], segments["reached"])}
    parts = sorted(set(segments["part"]))
    for p in parts:
        out.append(state)
        state = int(step[p, state])
    return pd.DataFrame({"conv": [segments["conv"].iloc[0]] * len(parts), "part": parts, "begins": out})


def edits(rows: DataFrame) -> DataFrame:
    """(conv, turn, name, symbol, n, code) of every distinct row of ``rows``
    (conv, turn, role, text, copies), none of them null but conv and turn.

    Rows are taken by turn, nulls first, and by name within a turn; ``n`` is
    how often a row comes, and ``code`` the edits of all of them.
    """
    spark = rows.sparkSession
    light = rows.where("copies > 0").select(
        "conv", "turn", _name(F.col("role"), F.col("text")).alias("name"),
        symbols(F.col("role"), F.col("text")).alias("symbol"), F.col("copies").cast("long").alias("copies"))
    once = light.groupBy("conv", "turn", "name", "symbol").agg(F.sum("copies").alias("n"))
    # a text that comes on several turns of its conversation is a duplicate after the first of them
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = once.groupBy(F.col("conv").alias("_conv"), F.col("name").alias("_name")).agg(
        F.min(place).alias("_first"), F.count("*").alias("_turns")).where("_turns > 1").drop("_turns")
    again = once.join(again, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("name") == F.col("_name")), "left")
    symbol = F.when((F.col("symbol") != "b") & (F.col("_first") < place), "d").otherwise(F.col("symbol"))
    order = ["conv", F.col("turn").asc_nulls_first(), "name"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    flat = cut(again.select("conv", "turn", "name", symbol.alias("symbol"), "n").repartitionByRange(tasks, *order)
               .sortWithinPartitions(*order).withColumn("part", F.spark_partition_id().cast("long")))
    kind = flat.schema["conv"].dataType.simpleString()
    ends = flat.mapInArrow(_matrix_task, f"conv {kind}, part long, m array<long>, place int")
    # two rows per task at most, here and below: small enough to send to every task
    left = ends.groupBy("conv").applyInPandas(_costs_left, f"conv {kind}, part long, left array<long>, last boolean")
    left = cut(left.select(F.col("conv").alias("_conv"), F.col("part").alias("_part"), "left", "last"))
    at = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))
    told = flat.join(F.broadcast(left), at, "left").drop("_conv", "_part").sortWithinPartitions(*order)
    arrow = pa.int64() if kind == "bigint" else pa.string() if kind == "string" else pa.int32()
    done = cut(told.mapInArrow(_unroll(arrow), f"conv {kind}, part long, entry int, turn long, name string, "
                                               "symbol string, n long, code string, reached int"))
    begins = done.where("reached is not null").select("conv", "part", "entry", "reached").groupBy("conv").applyInPandas(
        _chain, f"conv {kind}, part long, begins int")
    begins = begins.select(F.col("conv").alias("_conv"), F.col("part").alias("_part"), "begins")
    return done.join(F.broadcast(begins), at, "left").where(F.col("entry") == F.coalesce("begins", F.lit(0))).select(
        "conv", "turn", "name", "symbol", "n", "code")


class _Told:
    """What is known of the conversation that a task is reading."""

    def __init__(self, conv):
        self.conv, self.hash, self.codes = conv, hashlib.sha256(), []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.turns, self.low, self.high, self.said, self.lines, self.initial = 0, None, None, 0, 0, None
        self.row = self.turn = None

    def edit(self, turn, symbol, n, code):
        c = self.counts
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.turns, self.high, self.turn = self.turns + 1, turn, turn
        c["blank"] += n if symbol == "b" else 0
        c["duplicate"] += 0 if symbol == "b" else n - (symbol != "d")
        c["truncated"] += symbol.isupper()
        c["cost"] += DELETE * code.count("D") + sum(INSERT if x in "ua" else REROLE for x in code if x in "uaUA")
        c["cost"] += TRUNCATED if symbol.isupper() and next(filter(str.isupper, code)) != "D" else 0
        self.codes.append(code)
        self.row = (n, code)

    def text(self, role, text):
        """The text of the row whose edits came last; it is read once."""
        if self.row is None:
            return
        n, code = self.row
        self.row = None
        first = role[:1]
        self.counts["illegal"] += (n - 1) + (self.initial is not None and self.initial + first not in ("su", "ua", "au"))
        self.initial = first
        for letter in code:
            if letter in "uaUAK":
                who = role if letter == "K" else _ROLE[letter.lower()]
                line = who + ":" + (text if letter in "UAK" else "")
                self.hash.update((("\n" if self.lines else "") + line).encode())
                self.lines += 1

    def row_out(self):
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        audit = "".join(self.codes).translate(str.maketrans("uaUA", "IIRR"))
        return {"conv": self.conv, "gaps": gaps, **self.counts, "audit": audit, "repaired_sha256": self.hash.hexdigest()}


def _digest_task(kind):
    schema = pa.schema([("conv", kind), *[(c, pa.int64()) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()),
        ("repaired_sha256", pa.string())])

    def run(batches):
        now, out = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "symbol", "n", "code", "role", "text")]
            for conv, turn, symbol, n, code, role, text in zip(*columns):
                if now is None or now.conv != conv:
                    if now is not None:
                        out.append(now.row_out())
                    now = _Told(conv)
                if code is not None:
                    now.edit(turn, symbol, n, code)
                elif role is not None:
                    now.text(role, text)
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row_out()], schema)
    return run


def audit(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text,
    copies): gaps, faults, illegal neighbours, cost, audit and the SHA-256
    of the repaired conversation.

    Null roles and texts are one space; a conversation whose rows all have
    0 copies gives zeros, an empty audit and the hash of nothing; a null
    conv_id is a conversation, a null turn comes before all others.  Rows of
    one turn are taken by the MD5 of role and text.  Texts are shuffled once
    and read in order: a digest runs through one task, in constant memory.
    """
    told = F.coalesce
    rows = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
                       told("role", F.lit(" ")).alias("role"), told("text", F.lit(" ")).alias("text"), "copies")
    found = edits(rows).select("conv", "turn", "name", "symbol", "n", "code").withColumn("kind", F.lit(0))
    there = F.col("copies") > 0
    texts = rows.select("conv", "turn", F.when(there, _name(F.col("role"), F.col("text"))).alias("name"),
                        F.when(there, F.col("role")).alias("role"), F.when(there, F.col("text")).alias("text"),
                        F.lit(1).alias("kind"))
    both = found.unionByName(texts, allowMissingColumns=True)
    kind = both.schema["conv"].dataType.simpleString()
    arrow = pa.int64() if kind == "bigint" else pa.string() if kind == "string" else pa.int32()
    out = (both.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "name", "kind")
           .select("conv", "turn", "symbol", "n", "code", "role", "text").mapInArrow(
        _digest_task(arrow), f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, "
                             "cost long, audit string, repaired_sha256 string"))
    return out.withColumnRenamed("conv", "conv_id")


def damaged(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, copies) after planted faults,
    drawn by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties
    its text, 2 takes its sentence marks, 3 repeats it, 4 makes it the
    user's.  Nulls are one space, in that name too."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(text("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text")).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))
