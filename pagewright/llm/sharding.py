"""Sharding by balanced label propagation.

Documents that share a link key are neighbours. Each linked document moves
towards the shard that holds most of its neighbours, as long as that shard has
room; documents without neighbours fill what is left, so that row counts end
at most one apart.

A round is two aggregates and two equi-joins: neighbours are counted per
(link, shard), never listed as pairs, and a hot link's rows are summed before
they are shuffled. Links of more than ``HOT`` rows, of which there are at most
one in ``HOT`` rows, meet their rows by a broadcast, so that no task gets all
rows of a link. Who moves, when more want to than there is room, is settled by
a hash against the fraction that fits, and rounds go on until no move is
accepted or none helps. The exact evening out at the end ranks rows in small buckets that are
ranges of the link's hash, so what leaves a shard leaves by whole links.

Defined cases: a null key or a key of one row is no link; null ids and repeated
rows are rows like any others (they are told apart by the number written with
them); a link larger than a shard is split over as few shards as have room; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, with_rank

#: A link of more rows is split over tasks; rows of a bucket when rows are ranked.
HOT = 20_000
#: Hot links and their moves are broadcast up to so many rows; Spark chooses the join beyond that.
BROADCAST_ROWS = 1_000_000


def _fraction(*parts) -> F.Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 20)) / float(1 << 20)


def quotas(flows: dict[tuple[int, int], int], room: dict[int, int], shards: int) -> list[float]:
    """The share of those who want to enter each shard that may: what its room and its own leavers allow."""
    share = [1.0] * shards
    for _ in range(30):
        left, come = [0.0] * shards, [0.0] * shards
        for (s, t), n in flows.items():
            left[s] += n * share[t]
            come[t] += n
        share = [min(1.0, max(0.0, room[t] + left[t]) / come[t]) if come[t] else 1.0 for t in range(shards)]
    return share


def small(df: DataFrame) -> DataFrame:
    """``df``, a written table, with a broadcast hint if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def linked_rows(slim: DataFrame, hot: int) -> DataFrame:
    """(row, link, parts) of the rows that share their link; a link of more than ``hot`` rows has several parts."""
    sizes = slim.where(F.col("link").isNotNull()).groupBy("link").agg(F.count("*").alias("n")).where("n > 1")
    sizes = materialize(sizes.select(F.col("link").alias("l_link"), F.ceil(F.col("n") / hot).cast("int").alias("parts")), "links")
    same = F.col("link") == F.col("l_link")
    marked = slim.select("row", "link").join(small(sizes.where("parts > 1")), same, "left").drop("l_link")
    others = marked.where("parts is null").drop("parts").join(sizes.where("parts = 1"), same)
    columns = ["row", "link", "parts"]
    return marked.where("parts is not null").select(*columns).unionByName(others.select(*columns))


def wanted_moves(state: DataFrame, room: dict[int, int]) -> DataFrame:
    """(link, parts, shard, to, n): the rows of a link that are outside the shard with most of them, and where to.

    Best is the shard with most of their neighbours among those with room, if it
    holds more than their own; ties fall to the same shard for a whole link.
    Otherwise they want to the shard with most neighbours, room or not: full
    shards exchange rows as far as quotas let them.
    """
    shards = len(room)
    free = F.element_at(F.array(*[F.lit(max(0, room[s])).cast("long") for s in range(shards)]), F.col("shard") + 1)
    counts = state.groupBy("link", "shard").agg(F.count("*").alias("n"), F.max("parts").alias("parts")).withColumn("free", free)
    rank = F.struct("n", F.xxhash64("link", "shard").alias("tie"), "shard")
    best = F.max(F.when(F.col("free") > 0, rank)).alias("open"), F.max(rank).alias("any")
    choice = counts.groupBy("link").agg(*best)
    fewer = F.struct("n", F.xxhash64("link", "shard")) < F.struct("open.n", F.xxhash64("link", F.col("open.shard")))
    better = F.col("open").isNotNull() & (F.col("shard") != F.col("open.shard")) & fewer
    outside = counts.join(choice, "link").where(F.col("shard") != F.col("any.shard"))
    to = F.when(better, F.col("open.shard")).otherwise(F.col("any.shard"))
    return outside.select("link", "parts", "shard", to.alias("to"), "n")


def apply_moves(state: DataFrame, moves: DataFrame, number: int) -> DataFrame:
    """``state`` after the moves that a hash accepts; ``moves`` has m_link, m_shard, parts, to, fits, large."""
    on = (F.col("link") == F.col("m_link")) & (F.col("shard") == F.col("m_shard"))
    hot, other = moves.where("parts > 1").drop("parts"), moves.where("parts = 1").drop("parts")
    joined = state.where("parts > 1").join(small(hot), on, "left").unionByName(state.where("parts = 1").join(other, on, "left"))
    drawn = F.when(F.col("large"), _fraction("row", F.lit(number))).otherwise(_fraction("link", F.lit(number)))
    goes = F.col("m_link").isNotNull() & (drawn < F.col("fits"))
    return joined.select("row", "link", "parts", F.when(goes, F.col("to")).otherwise(F.col("shard")).alias("shard"))


def propagate(linked: DataFrame, total: int, shards: int, rounds: int = 40, slack: float = 0.03, patience: int = 3) -> DataFrame:
    """Give each (row, link, parts) row a shard; return (row, link, parts, shard).

    A row belongs to one link here; rows of a link see each other's shards.
    Room is what a shard's share of all ``total`` rows, and a little ``slack``
    that the evening out takes back, leaves beside the linked rows it holds.
    Rounds end when less than one move would be accepted, or when ``patience``
    rounds brought no fewer rows outside their link's shard; ``rounds`` is only
    a guard.
    """
    room_each = int(total / shards * (1 + slack))
    first = F.pmod(F.xxhash64("row", F.lit("first")), F.lit(shards)).cast("int")
    state = materialize(linked.withColumn("shard", first), "shards")
    cuts: list[int] = []
    for number in range(rounds):
        held = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        room = {s: room_each - held.get(s, 0) for s in range(shards)}
        moves = materialize(wanted_moves(state, room), "moves")
        flows = {(r["shard"], r["to"]): r["n"] for r in moves.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}
        accepted = quotas(flows, room, shards)
        cuts.append(sum(flows.values()))
        stuck = len(cuts) > patience and min(cuts[-patience:]) >= min(cuts[:-patience])
        if stuck or sum(n * accepted[t] for (_, t), n in flows.items()) < 1:
            break
        to = F.col("to") + 1
        fits = F.element_at(F.array(*[F.lit(a) for a in accepted]), to)
        # Whole parts of links move together where they fit, so the hash is of the link unless the part alone is larger than the room.
        limit = F.element_at(F.array(*[F.lit(float(max(1, room[s])) / 20) for s in range(shards)]), to)
        moves = moves.select(F.col("link").alias("m_link"), F.col("shard").alias("m_shard"), "parts", "to", fits.alias("fits"), (F.col("n") > limit).alias("large"))
        state = materialize(apply_moves(state, moves, number), "shards")
    return state


def shard_documents(docs: DataFrame, link: F.Column, shards: int = 16, rounds: int = 40, carry: dict[str, F.Column] | None = None, hot: int = HOT) -> DataFrame:
    """One row per document: the columns in ``carry``, its ``link``, its ``shard`` and its ``slot`` in the shard, from 0 without gaps."""
    carry = carry or {}
    own = [c.alias(f"c_{k}") for k, c in carry.items()]
    slim = materialize(docs.select(*own, link.alias("link"), F.monotonically_increasing_id().alias("row")), "documents")
    total = slim.count()
    state = propagate(linked_rows(slim, hot), total, shards, rounds)

    # Even out: a shard keeps its linked rows up to its quota; the rest join the rows without neighbours and fill the gaps.
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    of_link = F.xxhash64("link")
    ranked = with_rank(state, "place", [of_link, F.col("row")], by=["shard"], rows=hot, run=of_link, parts=F.col("parts"))
    stays = F.col("place") < F.element_at(F.array(*[F.lit(q).cast("long") for q in quota]), F.col("shard") + 1)
    kept = ranked.select(F.col("row").alias("k_row"), F.col("parts").alias("k_parts"), F.when(stays, F.col("shard")).alias("k_shard"))
    kept = materialize(kept, "kept")
    held = {r["k_shard"]: r["n"] for r in kept.groupBy("k_shard").agg(F.count("*").alias("n")).collect()}
    merged = materialize(slim.join(kept, F.col("row") == F.col("k_row"), "left").drop("k_row"), "merged")
    run = F.when(F.col("k_parts").isNotNull(), of_link).otherwise(F.xxhash64("row"))
    loose = with_rank(merged.where("k_shard is null"), "place", [run, F.col("row")], rows=hot, run=run, parts=F.col("k_parts"))
    ends, at = [], 0
    for s in range(shards):
        at += quota[s] - held.get(s, 0)
        ends.append(at)
    fill = F.lit(shards - 1)
    for s in reversed(range(shards)):
        fill = F.when(F.col("place") < ends[s], F.lit(s)).otherwise(fill)
    columns = [c for c in merged.columns if c not in ("k_shard", "k_parts")]
    stayed = merged.where("k_shard is not null").select(*columns, F.col("k_shard").alias("shard"))
    placed = materialize(stayed.unionByName(loose.select(*columns, fill.cast("int").alias("shard"))), "placed")
    out = with_rank(placed, "slot", [F.xxhash64("row"), F.col("row")], by=["shard"], total=total)
    return out.select(*[F.col(f"c_{k}").alias(k) for k in carry], "link", "shard", "slot")


def cut_rows(sharded: DataFrame) -> DataFrame:
    """One row (linked, cut): rows that share their link, and those of them outside the shard that holds most of it."""
    counts = sharded.where(F.col("link").isNotNull()).groupBy("link", "shard").agg(F.count("*").alias("n"))
    links = counts.groupBy("link").agg(F.sum("n").alias("all"), F.max("n").alias("most")).where(F.col("all") > 1)
    return links.agg(F.coalesce(F.sum("all"), F.lit(0)).alias("linked"), F.coalesce(F.sum(F.col("all") - F.col("most")), F.lit(0)).alias("cut"))
