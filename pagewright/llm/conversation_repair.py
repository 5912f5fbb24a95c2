"""Conversation structure repair by signatures.

A conversation's rows, in order, become a short string: one character per row
for its role and fault. Conversations with one signature need the same edits,
so each distinct signature is solved once, by memoised recursion, and the edits
are joined back and replayed on every conversation that has it.

Edits cost: keep 0, another role (user or assistant) 2, delete 3, insert an
empty user or assistant row 2; a truncated row that isn't deleted adds 1. The
roles' initials of the result read ``(s?(ua)+)?``. Among the cheapest edits the
audit that sorts first in ASCII is taken. In any state at most one edit has a
given initial, so ties are settled by the next initial alone.

Defined cases: a null role or text is one space, so such a row is blank; null
turns come before all others, and a null conversation id is a conversation;
rows that share a turn are ordered by role, then text; repeated rows all count,
the later ones as duplicates; a conversation without rows has an empty audit;
an empty table gives an empty result. Other columns are not read. A conversation
is the unit of work, since its repaired form is one value: it has to fit in a
task, as a text does; its rows are never compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_SPACE, SPACE, materialize

#: Solutions up to this many signatures are broadcast; beyond it they are joined by shuffle.
BROADCAST_ROWS = 20_000

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States of the result so far: nothing, after system, after user, after assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The symbol of a row that has to go; others are s, u, a or o (any other role), capital if truncated.
GONE = "x"

SOLVED = "signature string, cost long, audit string, plan array<struct<row:int,role:string>>"


def solve(signature: str) -> tuple[int, str, list[tuple[int, str]]]:
    """Cost and audit of the cheapest edits, and the rows they make: a row's number and its role, if that changes; -1 for a new row."""
    memo: dict[tuple[int, int, int], tuple[float, str]] = {}

    def kept(symbol: str, state: int) -> int | None:
        """The state after a row is kept as it is, if it may be."""
        role = symbol.lower()
        if role == "s":
            return SYSTEM if state == NOTHING else None
        return NEXT[state] if role == {USER: "u", ASSISTANT: "a"}[NEXT[state]] else None

    def options(i: int, state: int, added: int) -> list[tuple[int, str, int, int, int]]:
        """Each edit that is open: cost, initial, and where it leads."""
        found = []
        if added < 2:  # a third new row in a row leads to a state that was there before
            found.append((INSERT, "I", i, NEXT[state], added + 1))
        if i < len(signature):
            symbol = signature[i]
            more = TRUNCATED if symbol.isupper() else 0
            found.append((DELETE, "D", i + 1, state, 0))
            if symbol != GONE:
                found.append((REROLE + more, "R", i + 1, NEXT[state], 0))
                if (then := kept(symbol, state)) is not None:
                    found.append((KEEP + more, "K", i + 1, then, 0))
        return found

    def best(i: int, state: int, added: int) -> tuple[float, str]:
        """The least cost from here on and the first edit's initial, empty at the end."""
        at = (i, state, added)
        if at not in memo:
            ends = [(0, "")] if i == len(signature) and state in (NOTHING, ASSISTANT) else []
            memo[at] = min([*ends, *((cost + best(j, s, n)[0], edit) for cost, edit, j, s, n in options(i, state, added))], default=(float("inf"), ""))
        return memo[at]

    for i in range(len(signature), 0, -1):  # from the end, so that recursion never goes deep
        for state in NEXT:
            best(i, state, 0)
    cost, audit, plan, at = best(0, NOTHING, 0)[0], [], [], (0, NOTHING, 0)
    while edit := best(*at)[1]:
        audit.append(edit)
        _, _, *after = next(o for o in options(*at) if o[1] == edit)
        if edit != "D":
            plan.append((-1 if edit == "I" else at[0], "" if edit == "K" else ROLE[after[1]]))
        at = tuple(after)
    return int(cost), "".join(audit), plan


def _solve_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    plan = pa.list_(pa.struct([("row", pa.int32()), ("role", pa.string())]))
    for batch in batches:
        signatures = batch.column(0).to_pylist()
        solved = [solve(s) for s in signatures]
        plans = [[{"row": i, "role": r} for i, r in p] for _, _, p in solved]
        yield pa.record_batch([pa.array(signatures, pa.string()), pa.array([c for c, _, _ in solved], pa.int64()), pa.array([a for _, a, _ in solved], pa.string()), pa.array(plans, plan)], ["signature", "cost", "audit", "plan"])


def initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("o"))


def _fault(text: Column, seen: Column) -> Column:
    """A row's first fault: b(lank), d(uplicate), t(runcated) or none."""
    return F.when(~text.rlike(NOT_SPACE), "b").when(seen, "d").when(~text.rlike(rf"[.!?]{SPACE}*\z"), "t").otherwise("")


def damage(conversations: DataFrame) -> DataFrame:
    """The rows, damaged by a hash of conversation and turn: conv_id, turn, role, text, and how many times a row is there.

    Of 20 remainders, 0 drops the row, 1 empties its text, 2 takes its full
    stops, exclamation and question marks, 3 repeats it, 4 makes its role user.
    """
    shown = lambda c: F.coalesce(conversations[c].cast("string"), F.lit(" "))
    found = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), F.pmod(F.crc32(F.encode(F.concat(shown("conv_id"), F.lit(":"), shown("turn")), "UTF-8")), F.lit(20)).alias("_code"))
    code = found["_code"]
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(found["text"])
    return found.select("conv_id", "turn", F.when(code == 4, "user").otherwise(found["role"]).alias("role"), text.alias("text"), F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"))


def conversations_of(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, rows in order, signature, gaps, and counts of faults and illegal neighbours.

    Rows are brought together once; the window that finds duplicates and the
    grouping share that shuffle.
    """
    times = rows[copies].cast("int") if copies else F.lit(1)
    shown = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    one = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), times.alias("_times"))
    one = one.select("conv_id", "turn", "role", "text", (F.col("_times") > 0).alias("there"), F.explode(F.sequence(F.lit(1), F.greatest("_times", F.lit(1)))).alias("_copy")).drop("_copy")
    earlier = Window.partitionBy("conv_id", "there", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    one = one.repartition("conv_id").withColumn("seen", F.row_number().over(earlier) > 1)
    row = F.struct("turn", "role", "text", "seen", _fault(F.col("text"), F.col("seen")).alias("fault"))
    found = one.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(F.col("there"), row))).alias("rows"), F.max(F.when(F.col("there"), F.col("turn"))).alias("_last"), F.min(F.when(F.col("there"), F.col("turn"))).alias("_first"))
    faults = lambda kind: F.size(F.filter("rows", lambda r: r["fault"] == kind)).cast("long")
    initials = F.transform("rows", lambda r: initial(r["role"]))
    pairs = F.zip_with(initials, F.slice(initials, F.lit(2), F.greatest(F.size("rows"), F.lit(1))), lambda a, b: F.concat(a, b))
    symbol = lambda r: F.when(r["fault"].isin("b", "d"), GONE).when(r["fault"] == "t", F.upper(initial(r["role"]))).otherwise(initial(r["role"]))
    turns = F.size(F.array_distinct(F.filter(F.transform("rows", lambda r: r["turn"]), lambda t: t.isNotNull())))
    return found.select(
        "conv_id",
        F.transform("rows", lambda r: F.struct(r["turn"].alias("turn"), r["role"].alias("role"), r["text"].alias("text"))).alias("rows"),
        F.array_join(F.transform("rows", symbol), "").alias("signature"),
        F.coalesce(F.col("_last") - F.col("_first") + 1 - turns, F.lit(0)).cast("long").alias("gaps"),
        faults("b").alias("blank"),
        faults("d").alias("duplicate"),
        faults("t").alias("truncated"),
        F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("long").alias("illegal"),
    )


def repair(rows: DataFrame, copies: str | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Conversations with their audits and repaired rows.

    ``rows`` has conv_id, turn, role and text; ``copies`` may name a column
    with the number of times that each row is there. Returns conv_id, signature,
    gaps, blank, duplicate, truncated, illegal, cost, audit, and ``repaired``, an
    array of role and text. Any number of conversations may share a signature:
    solutions are broadcast after a count, or joined by a shuffle whose hot
    signatures Spark splits.
    """
    found = materialize(conversations_of(rows, copies), "conversations")
    solved = materialize(found.select("signature").distinct().mapInArrow(_solve_batches, SOLVED), "signatures")
    few = solved.count() <= broadcast_rows
    joined = found.join(F.broadcast(solved) if few else solved.hint("merge"), "signature")
    own = lambda p: F.get("rows", p["row"])
    repaired = F.transform("plan", lambda p: F.struct(F.when(p["role"] == "", own(p)["role"]).otherwise(p["role"]).alias("role"), F.when(p["row"] < 0, "").otherwise(own(p)["text"]).alias("text")))
    return joined.select("conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", repaired.alias("repaired"))


def transcript(turns: Column) -> Column:
    """``role:text`` of each row, one after the other."""
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
