"""Conversation repair by rank-convergence parallel Viterbi.

Rows of a conversation, in order of turn, become a conversation of the form ``(s?(ua)+)?`` (role
initials) by the cheapest edits: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty
user or assistant row 5. Blank rows and repeats of an earlier (role, text) must go; a truncated row
that stays costs 5 more. Among the cheapest, the edits whose initials are least in ASCII order win.

Rows are sorted by ranges of (conversation, turn), so a conversation of any length spreads over
tasks, and cut into pieces of bounded rows and bytes. A conversation that lies in one piece is
solved where it stands. The pieces of the others run in parallel: each computes costs-to-go from
its end back to its start from a speculative cost vector (that of a conversation's end). Fix-up
passes hand every piece the true vector of its successor; a piece runs again if that differs from
what it assumed by more than a constant, and stops as soon as its new vectors differ from the old
ones only by a constant, since all earlier ones then do too. Passes end when nothing changes; a
pass walks spans of SPAN pieces, so only texts without any convergence over a span take another.
The stitched vectors then drive the tracing: each piece traces from every state, the maps of states
are chained, and the trace of the true start is kept.

Turns come in ascending order, nulls first; rows of equal turn in order of a hash of role and text,
so equal rows are adjacent. A null role or text counts as one space; a null conversation is a
conversation. Repeated rows are rows. An empty table gives an empty result; extra columns are
ignored. Texts of any length are kept whole; a piece holds one row at least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.llm.common import staged

ROWS, BYTES, SPAN = 4096, 8_000_000, 1024
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"

# States: nothing yet, after system, after user, after assistant. What a conversation's end costs.
START, SYSTEM, USER, ASSISTANT = range(4)
END = (0, 2 * INSERT, INSERT, 0)
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ANSWER = (USER, USER, ASSISTANT, USER)  # the state after a row of the role that fits
GONE, SHORT = 4, 8  # marks of a row's code beside its initial: must be deleted, is truncated


def code_of(role: str, text: str) -> int:
    """A row in four bits: initial (0 s, 1 u, 2 a, 3 other), blank, truncated."""
    stripped = text.strip(SPACE)
    initial = "sua".find(role[0]) & 3 if role else 3
    return initial | (GONE if not stripped else SHORT if stripped[-1] not in ".!?" else 0)


def _choices(code: int, after: tuple, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost to the end, next state) of a row in a state, without insertions."""
    found = [("D", DELETE + after[state], state)]
    if not code & GONE:
        cut = CUT if code & SHORT else 0
        kept = NEXT["sua"[code & 3]].get(state) if code & 3 < 3 else None
        if kept is not None:
            found.append(("K", KEEP + cut + after[kept], kept))
        found.append(("R", REROLE + cut + after[ANSWER[state]], ANSWER[state]))
    return found


@lru_cache(maxsize=None)
def back(code: int, after: tuple) -> tuple[tuple, int]:
    """Costs to go before a row, less their least, and that least. Vectors have small entries, so
    there are few."""
    own = [min(cost for _, cost, _ in _choices(code, after, s)) for s in range(4)]
    user, assistant = min(own[USER], INSERT + own[ASSISTANT]), min(own[ASSISTANT], INSERT + own[USER])
    costs = (min(own[START], INSERT + user), min(own[SYSTEM], INSERT + user), user, assistant)
    least = min(costs)
    return tuple(c - least for c in costs), least


@lru_cache(maxsize=None)
def step(code: int, after: tuple, state: int) -> tuple[str, int, int]:
    """(edits, their cost, next state) of a row on the way that is cheapest and then least."""
    costs, least = back(code, after)
    edits, spent = "", 0
    while True:
        to_go = costs[state] + least
        here = [(e, c, n) for e, c, n in _choices(code, after, state) if c == to_go]
        into = ANSWER[state]
        if INSERT + costs[into] + least == to_go:
            here.append(("I", to_go, into))
        edit, cost, after_state = min(here)
        edits += edit
        if edit != "I":
            return edits, spent + cost - after[after_state], after_state
        spent, state = spent + INSERT, into


def backward(codes: bytes, after: tuple, assumed: tuple | None = None, known: tuple | None = None) -> tuple:
    """Normalised vector before the first row. With the vector assumed earlier and its result, the
    walk stops where both runs differ by a constant only."""
    for code in reversed(codes):
        if assumed is not None:
            if assumed == after:
                return known
            assumed = back(code, assumed)[0]
        after = back(code, after)[0]
    return after


def vectors(codes: bytes, after: tuple) -> list[tuple]:
    """Normalised vectors behind each row."""
    found = [after]
    for code in reversed(codes[1:]):
        found.append(back(code, found[-1])[0])
    return found[::-1] if codes else []


def trace(codes: bytes, after: tuple, state: int, last: bool) -> tuple[list[str], int, int]:
    """(edits of each row, cost, state at the end); after the last row of a conversation one more
    entry holds what is inserted there."""
    edits, cost = [], 0
    for code, behind in zip(codes, vectors(codes, after)):
        done, spent, state = step(code, behind, state)
        edits.append(done)
        cost += spent
    if last:
        tail = ""
        while END[state]:
            tail, cost, state = tail + "I", cost + INSERT, ANSWER[state]
        edits.append(tail)
    return edits, cost, state


def apply_edits(edits: list[str], roles: list[str], texts: list[str], state: int) -> list[tuple[str, str]]:
    """Rows after the edits."""
    out = []
    for i, of_row in enumerate(edits):
        for edit in of_row:
            if edit == "D":
                continue
            if edit == "K":
                state = NEXT[roles[i][0]][state]
                out.append((roles[i], texts[i]))
            else:
                state = ANSWER[state]
                out.append(("user" if state == USER else "assistant", texts[i] if edit == "R" else ""))
    return out


MESSAGE = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


def _piece_schema(conv: T.StructField, turn: T.StructField) -> T.StructType:
    long, text = T.LongType(), T.StringType()
    return T.StructType([
        T.StructField("conv", conv.dataType), T.StructField("part", T.IntegerType()), T.StructField("no", long),
        T.StructField("alone", T.BooleanType()),
        T.StructField("first_turn", turn.dataType), T.StructField("last_turn", turn.dataType), T.StructField("turns", long),
        T.StructField("first_role", text), T.StructField("last_role", text), T.StructField("illegal", long),
        T.StructField("blank", long), T.StructField("duplicate", long), T.StructField("truncated", long),
        T.StructField("cost", long), T.StructField("edits", text), T.StructField("messages", MESSAGE),
        T.StructField("codes", T.BinaryType()), T.StructField("keys", T.ArrayType(T.BinaryType())),
    ])


def _marked(codes: bytearray, keys: list, seen: set) -> tuple[int, int, int]:
    """Mark repeats as rows to delete; counts of each row's first fault: blank, duplicate, truncated."""
    blank = duplicate = truncated = 0
    for i, key in enumerate(keys):
        if codes[i] & GONE:
            blank += 1
        elif key in seen:
            duplicate += 1
            codes[i] |= GONE
        elif codes[i] & SHORT:
            truncated += 1
        seen.add(key)
    return blank, duplicate, truncated


def _key(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()


class _Piece:
    """Rows of one conversation that stand together."""

    def __init__(self, conv):
        self.conv, self.turns, self.roles, self.texts, self.size = conv, [], [], [], 0

    def add(self, turn, role, text) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)

    def row(self, part: int, no: int | None) -> tuple:
        """Solved if the conversation lies in this piece (no number), else ready for the passes."""
        codes = bytearray(code_of(r, t) for r, t in zip(self.roles, self.texts))
        initials = [r[:1] for r in self.roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        known = [t for t in self.turns if t is not None]
        facts = (
            known[0] if known else None, known[-1] if known else None, len(set(known)),
            initials[0], initials[-1], illegal)
        keys = [_key(r, t) for r, t in zip(self.roles, self.texts)]
        if no is not None:
            rows = list(zip(self.roles, self.texts))
            return (self.conv, part, no, False, *facts, None, None, None, None, None, rows, bytes(codes), keys)
        faults = _marked(codes, keys, set())
        edits, cost, _ = trace(bytes(codes), END, START, True)
        return (self.conv, part, 0, True, *facts, *faults, cost, "".join(edits),
                apply_edits(edits, self.roles, self.texts, START), None, None)


def _cut(schema: T.StructType, most_rows: int, most_bytes: int):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        part, number, first, piece, ready, weight = TaskContext.get().partitionId(), 0, True, None, [], 0
        split = False  # an earlier piece of the conversation has left

        def leave(alone: bool) -> None:
            nonlocal number, weight
            ready.append(piece.row(part, None if alone else number))
            number += 0 if alone else 1
            weight += piece.size + 100 * len(piece.roles)

        def packed():
            nonlocal weight
            rows, weight = ready.copy(), 0
            ready.clear()
            columns = [list(c) for c in zip(*rows)]
            at = schema.names.index("messages")
            columns[at] = [[{"role": r, "text": t} for r, t in m] for m in columns[at]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            for conv, turn, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if piece is None:
                    piece = _Piece(conv)
                elif piece.conv != conv:
                    # The first conversation of a task may have begun in the one before.
                    leave(not first and not split)
                    first, split, piece = False, False, _Piece(conv)
                elif len(piece.roles) >= most_rows or piece.size + len(text) > most_bytes:
                    leave(False)
                    split, piece = True, _Piece(conv)
                piece.add(turn, role, text)
                if weight > most_bytes:
                    yield packed()
        if piece is not None:
            leave(False)  # the last one may go on in the next task
        if ready:
            yield packed()

    return cut


def pieces_of(
    turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, rows: int, size: int,
) -> DataFrame:
    """Sorted rows in pieces; those of conversations within one piece are solved."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kinds = {f.name: f for f in turns.schema.fields}
    narrow = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), plain(role_col).alias("role"),
        plain(text_col).alias("text"))
    # The row number only spreads equal rows over ranges; which of them goes where does not show.
    keyed = narrow.withColumn("_h", F.xxhash64("role", "text")).withColumn("_row", F.monotonically_increasing_id())
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("_h"), F.col("_row")]
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = _piece_schema(kinds[conv_col], kinds[turn_col])
    return staged(ordered.select("conv", "turn", "role", "text").mapInArrow(_cut(schema, rows, size), schema), "pieces")


def _numbered(pieces: DataFrame) -> DataFrame:
    """Pieces of longer conversations with one number over all, in order. One count a task comes
    to the driver."""
    counts = pieces.groupBy("part").count().orderBy("part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["part"], total))
        total += row["count"]
    table = pieces.sparkSession.createDataFrame(offsets, "part int, before bigint")
    return pieces.join(F.broadcast(table), "part").withColumn("idx", F.col("before") + F.col("no")).drop("before")


def _with_repeats(pieces: DataFrame) -> DataFrame:
    """Final codes and fault counts: rows whose key an earlier piece of the conversation holds are
    repeats. A piece sends each key once."""
    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for idx, codes, keys, before in zip(pdf["idx"], pdf["codes"], pdf["keys"], pdf["seen"]):
                codes = bytearray(codes)
                faults = _marked(codes, [bytes(k) for k in keys], {bytes(k) for k in before})
                rows.append((idx, bytes(codes), *faults))
            yield pd.DataFrame(rows, columns=["idx", "codes", "blank", "duplicate", "truncated"])

    held = pieces.select("conv", "idx", F.explode(F.array_distinct("keys")).alias("key"))
    first = held.groupBy("conv", "key").agg(F.min("idx").alias("least")).select(
        F.col("conv").alias("_conv"), F.col("key").alias("_key"), "least")
    seen = held.join(first, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key"))).where(
        "idx > least").groupBy("idx").agg(F.collect_list("key").alias("seen"))
    none = F.array().cast("array<binary>")
    return pieces.select("idx", "codes", "keys").join(seen, "idx", "left").withColumn(
        "seen", F.coalesce("seen", none)).mapInPandas(
        mark, "idx bigint, codes binary, blank bigint, duplicate bigint, truncated bigint")


_STATE = "idx bigint, codes binary, goes_on boolean, used array<int>, found array<int>"


def _speculate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every piece from the vector of a conversation's end."""
    for pdf in batches:
        pdf["used"] = [list(END)] * len(pdf)
        pdf["found"] = [list(backward(bytes(c), END)) for c in pdf["codes"]]
        yield pdf[["idx", "codes", "goes_on", "used", "found"]]


def _fix_up(pdf: pd.DataFrame) -> pd.DataFrame:
    """A span of pieces from its last to its first; ``handed`` is the vector behind the span."""
    pdf = pdf.sort_values("idx", ascending=False)
    behind, rows = None, []
    for idx, codes, on, used, found, handed in zip(*[pdf[c] for c in ("idx", "codes", "goes_on", "used", "found", "handed")]):
        used, found = tuple(map(int, used)), tuple(map(int, found))
        if behind is None and handed is not None:
            behind = tuple(map(int, handed))
        entry = behind if on else END
        if entry != used:
            used, found = entry, backward(bytes(codes), entry, used, found)
        rows.append((idx, codes, on, list(used), list(found)))
        behind = found
    return pd.DataFrame(rows, columns=["idx", "codes", "goes_on", "used", "found"])


def stitched(chain: DataFrame, span: int = SPAN) -> DataFrame:
    """``chain`` (idx, codes, goes_on) with the true vector behind each piece (``used``)."""
    state = staged(chain.mapInPandas(_speculate, _STATE), "speculated")
    while True:
        # Only pieces whose successor lies in the next span look across.
        heads = state.where(F.col("idx") % span == 0).select((F.col("idx") - 1).alias("idx"), F.col("found").alias("handed"))
        state = staged(
            state.join(heads, "idx", "left").withColumn("span", F.floor(F.col("idx") / span))
            .groupBy("span").applyInPandas(_fix_up, _STATE), "fixed")
        heads = state.where(F.col("idx") % span == 0).select((F.col("idx") - 1).alias("idx"), F.col("found").alias("handed"))
        if state.where("goes_on").join(heads, "idx").where("used != handed").isEmpty():
            return state


def _maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Where a piece leads from each state."""
    for pdf in batches:
        pdf["leads"] = [
            [trace(bytes(c), tuple(map(int, u)), s, False)[2] for s in range(4)]
            for c, u in zip(pdf["codes"], pdf["used"])]
        yield pdf[["idx", "goes_on", "leads"]]


def _through(pdf: pd.DataFrame) -> pd.DataFrame:
    """A span as one map from the state before it to the state behind it."""
    ends = list(range(4))
    for on, leads in pdf.sort_values("idx")[["goes_on", "leads"]].itertuples(index=False):
        ends = [int(leads[s]) for s in ends] if on else [START] * 4
    return pd.DataFrame([(int(pdf["span"].iloc[0]), ends)], columns=["span", "ends"])


def _starts(pdf: pd.DataFrame) -> pd.DataFrame:
    state, rows = int(pdf["enters"].iloc[0]), []
    for idx, on, leads in pdf.sort_values("idx")[["idx", "goes_on", "leads"]].itertuples(index=False):
        rows.append((idx, state))
        state = int(leads[state]) if on else START
    return pd.DataFrame(rows, columns=["idx", "state"])


def start_states(state: DataFrame, span: int = SPAN) -> DataFrame:
    """(idx, state) at the start of each piece. One map a span, so one a few million rows, comes
    to the driver."""
    maps = staged(state.mapInPandas(_maps, "idx bigint, goes_on boolean, leads array<int>").withColumn(
        "span", F.floor(F.col("idx") / span)), "maps")
    spans = maps.groupBy("span").applyInPandas(_through, "span bigint, ends array<int>").orderBy("span").collect()
    enters, at = [], START
    for row in spans:
        enters.append((row["span"], at))
        at = row["ends"][at]
    table = state.sparkSession.createDataFrame(enters, "span bigint, enters int")
    return maps.join(F.broadcast(table), "span").groupBy("span").applyInPandas(_starts, "idx bigint, state int")


def _traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for idx, codes, used, on, state, messages in zip(*[pdf[c] for c in ("idx", "codes", "used", "goes_on", "state", "messages")]):
            edits, cost, _ = trace(bytes(codes), tuple(map(int, used)), int(state), not on)
            kept = apply_edits(edits, [m["role"] for m in messages], [m["text"] for m in messages], int(state))
            rows.append((idx, cost, "".join(edits), [{"role": r, "text": t} for r, t in kept]))
        yield pd.DataFrame(rows, columns=["idx", "cost", "edits", "messages"])


FACTS = ("first_turn", "last_turn", "turns", "first_role", "last_role", "illegal")


def repair(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", rows: int = ROWS, size: int = BYTES, span: int = SPAN,
) -> DataFrame:
    """Repaired conversations in pieces, one for all but long ones: conversation, piece (in order),
    alone (it is the only one), facts of the rows before, fault counts, cost, edits (initials) and
    messages, the rows after the edits."""
    pieces = pieces_of(turns, conv_col, turn_col, role_col, text_col, rows, size)
    columns = ["conv", "piece", "alone", *FACTS, "blank", "duplicate", "truncated", "cost", "edits", "messages"]
    alone = pieces.where("alone").withColumn("piece", F.lit(0).cast("bigint")).select(*columns)
    long = staged(_numbered(pieces.where("NOT alone")), "numbered")
    coded = staged(_with_repeats(long), "coded")
    following = long.select((F.col("idx") - 1).alias("idx"), F.col("conv").alias("_next"), F.lit(True).alias("_any"))
    chain = long.select("idx", "conv").join(following, "idx", "left").select(
        "idx", (F.coalesce("_any", F.lit(False)) & F.col("conv").eqNullSafe(F.col("_next"))).alias("goes_on"))
    state = stitched(coded.select("idx", "codes").join(chain, "idx"), span)
    begun = start_states(state, span)
    kind = "idx bigint, cost bigint, edits string, messages array<struct<role:string,text:string>>"
    done = state.select("idx", "used", "goes_on").join(begun, "idx").join(
        coded.select("idx", "codes"), "idx").join(long.select("idx", "messages"), "idx").mapInPandas(_traced, kind)
    solved = (
        long.select("idx", "conv", *FACTS).join(coded.drop("codes"), "idx").join(staged(done, "traced"), "idx")
        .withColumn("piece", F.col("idx")).withColumn("alone", F.lit(False)).select(*columns))
    return alone.unionByName(solved).withColumnRenamed("conv", conv_col)


def _as_text(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")


SUMMARY = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string")


def summaries(pieces: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation: gaps in the turns, faults, illegal neighbours, cost, audit and the
    SHA-256 of the repaired rows. Long conversations pass piece by piece; only their audit, a
    letter an edit, is held."""
    gap = F.coalesce((F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")).cast("bigint"), F.lit(0))
    alone = pieces.where("alone").select(
        conv_col, gap.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
        F.col("edits").alias("audit"), F.sha2(_as_text(F.col("messages")), 256).alias("repaired_sha256"))
    names = alone.columns

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None  # conversation, sums, audit, hash, first and last turn, last role
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                if now is None or now["conv"] != row.conv:
                    if now is not None:
                        out.append(finished(now))
                    now = {"conv": row.conv, "sums": [0] * 5, "audit": [], "sha": hashlib.sha256(), "rows": 0,
                           "first": None, "last": None, "turns": 0, "role": None}
                for i, name in enumerate(("blank", "duplicate", "truncated", "illegal", "cost")):
                    now["sums"][i] += int(getattr(row, name))
                if now["role"] is not None and now["role"] + row.first_role not in ("su", "ua", "au"):
                    now["sums"][3] += 1
                now["role"] = row.last_role
                if row.turns:
                    low, high = int(row.first_turn), int(row.last_turn)
                    now["turns"] += int(row.turns) - (now["last"] == low)
                    now["first"] = low if now["first"] is None else now["first"]
                    now["last"] = high
                now["audit"].append(row.edits)
                if row.n:
                    now["sha"].update((("\n" if now["rows"] else "") + row.repaired).encode())
                    now["rows"] += int(row.n)
            if out:
                yield pd.DataFrame(out, columns=names)
        if now is not None:
            yield pd.DataFrame([finished(now)], columns=names)

    def finished(now: dict) -> tuple:
        gaps = 0 if now["first"] is None else now["last"] - now["first"] + 1 - now["turns"]
        return (now["conv"], gaps, *now["sums"], "".join(now["audit"]), now["sha"].hexdigest())

    rest = pieces.where("NOT alone").select(
        F.col(conv_col).cast("string").alias("conv"), "piece", F.coalesce("first_turn", F.lit(0)).alias("first_turn"),
        F.coalesce("last_turn", F.lit(0)).alias("last_turn"), "turns", "first_role", "last_role",
        "illegal", "blank", "duplicate", "truncated", "cost", "edits", F.size("messages").alias("n"),
        _as_text(F.col("messages")).alias("repaired"))
    streamed = rest.repartition("conv").sortWithinPartitions("conv", "piece").mapInPandas(stream, f"{conv_col} string, {SUMMARY}")
    return alone.unionByName(streamed.withColumn(conv_col, F.col(conv_col).cast(pieces.schema[conv_col].dataType)))
