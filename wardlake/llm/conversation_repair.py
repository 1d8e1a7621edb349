"""Repair of the turn structure of conversations by an auction for shortest paths.

A repair keeps, reroles, deletes or inserts rows until the roles read ``(s?(ua)+)?``. All repairs of a conversation
are the paths of a lattice: node (i, state) stands before row i, the state tells the last role kept, and every
edit is an arc with an integer cost. The auction holds a price for each node, never above the cost of the arc plus
the price at its end. It grows a path from an origin: where the last node's price is below its best arc, the price
rises to it and the path is cut back by one node; otherwise the path is extended by that arc. When it meets a node
whose price is final, so are the prices along the path. Origins are taken backwards in steps of ``STEP`` rows, and
new nodes start at the least price of the rows behind them, so that prices rise a little each and the work grows
with the rows, not with their square. An arc is tight when it costs exactly the difference of two final prices: the
cheapest repairs are the paths of tight arcs, and the first by ASCII takes the least letter at every node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.common import salted_lookup, stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
STEP = 8
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that a state asks for next, as the state it leads to.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
GONE, CUT = 1, 2  # faults: must be deleted; costs extra where it stays
INITIALS = ["s", "u", "a", "", "?"]
END = 3 * len(INITIALS)
LEGAL = {"su", "ua", "au"}


def _arcs(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edits at a node, by letter: (letter, cost, distance to the node it leads to; a row is 4 nodes long)."""
    out = []
    if symbol != END:
        initial, fault = INITIALS[symbol // 3], symbol % 3
        out.append(("D", DELETE, 4))
        more = TRUNCATED if fault == CUT else 0
        if fault != GONE:
            to = {"s": SYSTEM if state == START else None, "u": USER if NEXT[state] == USER else None,
                  "a": ASSISTANT if NEXT[state] == ASSISTANT else None, "": state, "?": None}[initial]
            if to is not None:
                out.append(("K", KEEP + more, 4 + to - state))
            out.append(("R", REROLE + more, 4 + NEXT[state] - state))
    out.append(("I", INSERT, NEXT[state] - state))
    return sorted(out)


ARCS = [[_arcs(symbol, state) for state in range(4)] for symbol in range(END + 1)]


def settle(origin: int, symbols: list[int], price: list[int], final: bytearray) -> None:
    """The auction from one origin: afterwards its price, and those along its path, are final."""
    path = [origin]
    while not final[path[-1]]:
        i = path[-1]
        best, at = None, i
        for _, cost, step in ARCS[symbols[i >> 2]][i & 3]:
            offer = cost + price[i + step]
            if best is None or offer < best:
                best, at = offer, i + step
        if price[i] < best:
            price[i] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(at)
    for i in path:
        final[i] = 1


def repair(symbols: list[int]) -> tuple[int, str]:
    """Cost and letters of the cheapest repair, the least by ASCII among equals. ``symbols``: 3 * initial + fault."""
    n = len(symbols)
    symbols = [*symbols, END]
    price, final = [0] * (4 * (n + 1)), bytearray(4 * (n + 1))
    final[4 * n + START] = final[4 * n + ASSISTANT] = 1
    for row in range(n, -1, -STEP):
        for state in range(4):
            settle(4 * row + state, symbols, price, final)
        low = max(0, row - STEP)
        price[4 * low:4 * row] = [min(price[4 * row:4 * row + 4])] * (4 * (row - low))
    settle(0, symbols, price, final)
    node, letters = 0, []
    while node >> 2 < n or node & 3 not in (START, ASSISTANT):
        for letter, cost, step in ARCS[symbols[node >> 2]][node & 3]:
            if price[node] == cost + price[node + step]:
                settle(node + step, symbols, price, final)
                if price[node] == cost + price[node + step]:
                    break
        letters.append(letter)
        node += step
    return price[0], "".join(letters)


def _symbol(initial: str, fault: str | None) -> int:
    k = INITIALS.index(initial) if initial in INITIALS else len(INITIALS) - 1
    return 3 * k + (0 if fault is None else CUT if fault == "truncated" else GONE)


def _by_conversation(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """Rows of (conv_id, columns...) as they come, sorted by conversation."""
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ["conv_id", *columns]))


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _plan(kind: pa.DataType):
    """One row per conversation from its sorted rows (a head without a row comes first)."""
    def report(conv, turns, initials, faults, symbols):
        cost, audit = repair(symbols)
        gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
        return [conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], initials[1], cost, audit]

    def run(batches):
        out: list[list] = [[] for _ in range(8)]

        def flush():
            got = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, [kind, *[pa.int64()] * 6, pa.string()])],
                names=["conv_id", *REPORT, "audit"])
            for c in out:
                c.clear()
            return got

        state, chars = None, 0
        for conv, is_row, turn, initial, fault in _by_conversation(batches, ["is_row", "turn", "initial", "fault"]):
            if not is_row:  # the head of the next conversation
                if state is not None:
                    row = report(*state)
                    chars += len(row[-1]) + 64
                    for c, v in zip(out, row):
                        c.append(v)
                    if chars > 1 << 22:
                        yield flush()
                        chars = 0
                # turns: least, largest, how many; initials: the last, illegal pairs
                state = conv, [None, None, 0], [None, 0], {"blank": 0, "duplicate": 0, "truncated": 0}, []
                continue
            _, turns, initials, faults, symbols = state
            if turn is not None:
                turns[0] = turn if turns[0] is None else turns[0]
                turns[2] += turn != turns[1]
                turns[1] = turn
            if initials[0] is not None:
                initials[1] += initials[0] + initial not in LEGAL
            initials[0] = initial
            if fault:
                faults[fault] += 1
            symbols.append(_symbol(initial, fault))
        if state is not None:
            for c, v in zip(out, report(*state)):
                c.append(v)
        if out[0]:
            yield flush()
    return run


def _apply(kind: pa.DataType):
    """Edits carried out on the sorted rows: a head (place -1, with the report), then the repaired rows."""
    names = ["conv_id", "place", "edit", "role", "text", *REPORT, "audit"]
    types = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * 6, pa.string()]

    def run(batches):
        out: list[list] = [[] for _ in names]
        held = 0

        def add(*values):
            for c, v in zip(out, values):
                c.append(v)

        def flush():
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)
            for c in out:
                c.clear()
            return got

        conv, audit, at, place, state = None, "", 0, 0, START
        blank = [None] * 7

        def insert():
            nonlocal at, place, state
            while at < len(audit) and audit[at] == "I":
                state = NEXT[state]
                add(conv, place, "I", NAMES[state], "", *blank)
                at, place = at + 1, place + 1

        for c, is_row, role, text, *told in _by_conversation(batches, ["is_row", "role", "text", *REPORT, "audit"]):
            if not is_row:
                insert()
                conv, audit, at, place, state = c, told[-1], 0, 0, START
                add(c, -1, None, None, None, *told)
                insert()
            else:
                insert()
                letter, at = audit[at], at + 1
                if letter == "K":
                    state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role[:1], state)
                    add(conv, place, "K", role, text, *blank)
                elif letter == "R":
                    state = NEXT[state]
                    add(conv, place, "R", NAMES[state], text, *blank)
                place += letter in "KR"
                held += len(text)
            if held > 1 << 24 or len(out[0]) >= 10_000:
                yield flush()
                held = 0
        insert()
        if out[0]:
            yield flush()
    return run


def _digest(kind: pa.DataType):
    """The repaired rows of a conversation, read in order, to one row: its report and a digest."""
    names = ["conv_id", *REPORT, "audit", "repaired_sha256"]
    types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches):
        told, sha = None, None
        for b in batches:
            done = []
            for conv, place, role, text, *more in _by_conversation([b], ["place", "role", "text", *REPORT, "audit"]):
                if place < 0:
                    if told:
                        done.append([*told, sha.hexdigest()])
                    told, sha = [conv, *more], hashlib.sha256()
                else:
                    sha.update(("\n" if place else "").encode() + f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
        if told:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([*told, sha.hexdigest()], types)], names=names)
    return run


_CHARS = r"[^\x20\x09-\x0D]"


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, row; never-null role and text) with digest, initial and fault.

    fault: blank (no character but white space), duplicate (role and text of an earlier row), truncated (the last
    such character ends no sentence), else null. A repeated text is found by the least (turn, row) of its group;
    only groups with several rows go back to the rows.
    """
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    keyed = rows.withColumn("digest", same)
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0).cast("long")).alias("turn"), "row")
    key = [F.col("conv_id").isNotNull().alias("named"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")]
    slim = keyed.select("conv_id", *key, "turn", "role", "digest", "row", F.regexp_extract(
        "text", f"({_CHARS})[\\x20\\x09-\\x0D]*\\z", 1).alias("last"))
    several = slim.groupBy("named", "conv", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter(
        "n > 1").drop("n")
    met = salted_lookup(slim, several, ["named", "conv", "digest"])
    fault = (F.when(F.col("last") == "", "blank").when(place > F.col("first"), "duplicate")
             .when(~F.col("last").isin(".", "!", "?"), "truncated"))
    return met.select("conv_id", "turn", "role", "digest", "row", F.substring("role", 1, 1).alias("initial"),
                      fault.alias("fault"))


def _edited(turns: DataFrame, ids: DataFrame | None, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = stage(turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                              text(role_col).alias("role"), text(text_col).alias("text")).withColumn(
        "row", F.monotonically_increasing_id()), "repair-rows")
    heads = stage((rows if ids is None else ids.select(F.col(conv_col).alias("conv_id"))).select("conv_id").distinct(),
                  "repair-ids")
    kind = rows.schema["conv_id"].dataType
    arrow, sql = to_arrow_type(kind), kind.simpleString()
    order = ["conv_id", "is_row", F.col("turn").asc_nulls_first(), "role", "digest", "row"]
    sorted_rows = lambda df: df.repartition("conv_id").sortWithinPartitions(*order)
    listed = faults(rows).withColumn("is_row", F.lit(True))
    short = heads.withColumn("is_row", F.lit(False)).unionByName(listed, allowMissingColumns=True)
    report = ", ".join(f"{c} long" for c in REPORT)
    plans = stage(sorted_rows(short).select("conv_id", "is_row", "turn", "initial", "fault").mapInArrow(
        _plan(arrow), f"conv_id {sql}, {report}, audit string"), "repair-plans")
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    whole = plans.withColumn("is_row", F.lit(False)).unionByName(
        rows.withColumn("digest", same).withColumn("is_row", F.lit(True)), allowMissingColumns=True)
    return sorted_rows(whole).select("conv_id", "is_row", "role", "text", *REPORT, "audit").mapInArrow(
        _apply(arrow), f"conv_id {sql}, place long, edit string, role string, text string, {report}, audit string")


def repaired(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """The rows after the cheapest repair: conv_id, place (from 0), edit (K, R or I), role, text.

    Rows of a conversation go by turn (null first), then role, then digest of the text; a null role or text is one
    space. Rows without a conversation are one conversation of null id. An empty table gives no rows, and other
    columns are not read.
    """
    return _edited(turns, None, conv_col, turn_col, role_col, text_col).filter("place >= 0").select(
        "conv_id", "place", "edit", "role", "text")


def report(turns: DataFrame, ids: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``ids`` lists the conversations to report where that is more than those with rows. Its symbols and its audit are
    one character a row and lie in one task; its texts are read once, in order, and not held. Order, nulls, ties and
    empty tables are as in ``repaired``; a role without any character leaves the structure as it is when kept.
    """
    edited = _edited(turns, ids, conv_col, turn_col, role_col, text_col)
    from pyspark.sql.pandas.types import to_arrow_type
    kind = edited.schema["conv_id"].dataType
    return edited.mapInArrow(_digest(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, " + ", ".join(
        f"{c} long" for c in REPORT) + ", audit string, repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with known faults, by CRC-32 of ``conv_id:turn`` modulo 20 (a null is one space): 0 drops the
    row, 1 empties its text, 2 takes ``.!?`` from it, 3 repeats it, 4 makes its role user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit: Column = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = (F.when(F.col("hit") == 1, F.lit("")).when(F.col("hit") == 2, F.translate(said("text"), ".!?", ""))
            .otherwise(said("text")))
    rows = turns.select("conv_id", "turn", "role", "text", hit.alias("hit")).filter("hit <> 0")
    times = F.sequence(F.lit(1), F.when(F.col("hit") == 3, F.lit(2)).otherwise(F.lit(1)))
    return rows.withColumn("time", F.explode(times)).select(
        "conv_id", "turn", F.when(F.col("hit") == 4, F.lit("user")).otherwise(said("role")).alias("role"), text.alias("text"))
