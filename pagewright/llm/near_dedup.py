"""Near-duplicate classes by DartMinHash, banding and exact checks.

One pass over the texts gives each document its set of word shingles and its
DartMinHash: every weighted element throws darts from a Poisson process that
all documents share, over the element's weight and a rank; darts above a
document's rank limit are not looked at; each dart belongs to one of k
coordinates, and the earliest dart of a coordinate is that coordinate's value.
Two documents agree in a coordinate with a probability equal to their weighted
Jaccard similarity, and the work grows with the number of darts, not with
elements times coordinates.

Copies of a word sequence are one representative from there on. Bands of the
signatures are joined to buckets. A bucket never lists its pairs: its leader,
the member that meets most others, is compared exactly with the members that
are not yet in its class, and then leaves the bucket; this goes on, with more
leaders at a time, while a bucket has members of different classes. Links are
contracted by alternating stars after each round, so groups of near copies
are settled by their first leader or two.

Defined cases: a null text is empty; texts without words are one class; a text
with fewer words than a shingle has one shingle, all its words; null ids sort
last and repeated rows are rows of the same class; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 24, 6
#: Beyond so many rows a set of row numbers is joined by a shuffle, not broadcast.
BROADCAST_ROWS = 1_000_000

U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = 0x9E3779B97F4A7C15
_powers = [np.ones(1, dtype=U), np.ones(1, dtype=U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    if len(_powers[0]) < n:
        m = max(n, 1 << 16)
        for i, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            full = np.full(m, base, dtype=U)
            full[0] = 1
            _powers[i] = np.multiply.accumulate(full)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word, from prefix sums of a polynomial over the bytes."""
    b = np.frombuffer(text, dtype=np.uint8)
    if not len(b):
        return np.empty(0, dtype=U)
    up, down = powers(len(b) + 1)
    sums = np.zeros(len(b) + 1, dtype=U)
    np.cumsum((b.astype(U) + U(1)) * up[: len(b)], out=sums[1:])
    solid = np.r_[False, ~_SPACE[b], False]
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    return mix((sums[ends] - sums[starts]) * down[starts])


_FACTORS = mix(np.arange(1, 65, dtype=U)) | U(1)


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all windows of words, with repeats; one window if there are fewer words."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(size, n)
    out = np.zeros(n - size + 1, dtype=U)
    for i in range(size):
        out += hashes[i : n - size + 1 + i] * _FACTORS[i % 64]
    return mix(out + U(size))


_CDF = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, i + 1)) for i in range(20)])


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> U(11)).astype(np.float64) * 2.0**-53


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, in a row."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def dart_min_hash(elements: list[np.ndarray], k: int, weights: list[np.ndarray] | None = None, seed: int = 1) -> np.ndarray:
    """Signatures (documents x k) of non-empty weighted sets.

    An element of weight w covers ceil(w) unit columns, and each unit of weight
    and rank holds a Poisson(1) number of darts that depends on the element and
    the unit alone. A document looks at ranks up to a limit at which about
    k ln k + 2k darts fall; where a coordinate stays empty, the limit doubles.
    """
    out = np.zeros((len(elements), k), dtype=U)
    todo, limit = np.arange(len(elements)), (k * np.log(k) + 2 * k) if k > 1 else 4.0
    total = np.array([float(w.sum()) for w in weights]) if weights else np.array([float(len(x)) for x in elements])
    while len(todo):
        sizes = np.array([len(elements[d]) for d in todo])
        x, doc = np.concatenate([elements[d] for d in todo]), np.repeat(np.arange(len(todo)), sizes)
        w = np.concatenate([weights[d] for d in todo]) if weights else np.ones(len(x))
        top = limit / total[todo]
        units = np.ceil(w).astype(np.int64)
        column = _ranges(units)
        x, doc, w = mix(np.repeat(x, units) + mix(column.astype(U) + U(seed << 32))), np.repeat(doc, units), np.repeat(w, units) - column
        cells = np.ceil(top).astype(np.int64)[doc]
        rank = _ranges(cells)
        h = mix(np.repeat(x, cells) ^ mix(rank.astype(U) + U(77)))
        doc, w = np.repeat(doc, cells), np.repeat(w, cells)
        darts = np.searchsorted(_CDF, _unit(h))
        number = _ranges(darts)
        h, doc, w, rank = mix(np.repeat(h, darts) + number.astype(U) * U(_P) + U(5)), np.repeat(doc, darts), np.repeat(w, darts), np.repeat(rank, darts)
        at = rank + _unit(h)
        h = mix(h + U(9))
        inside = (at <= top[doc]) & ((w >= 1) | (_unit(mix(h + U(3))) <= w))
        h, doc, at = h[inside], doc[inside], at[inside]
        place = doc * k + (h % U(k)).astype(np.int64)
        order = np.argsort(-at, kind="stable")
        place, h = place[order], h[order]
        found = np.zeros(len(todo) * k, dtype=U)
        full = np.zeros(len(todo) * k, dtype=bool)
        found[place], full[place] = mix(h + U(13)), True  # the last one written, the earliest dart, stays
        done = full.reshape(-1, k).all(axis=1)
        out[todo[done]] = found.reshape(-1, k)[done]
        todo, limit = todo[~done], limit * 2
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per document and band."""
    s = signatures.reshape(len(signatures), bands, rows)
    out = np.broadcast_to(mix(np.arange(bands, dtype=U) + U(1000)), s.shape[:2]).copy()
    for i in range(rows):
        out = mix(out * U(_P) + s[:, :, i])
    return out


def sketch(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int, weighted: bool) -> DataFrame:
    """id, row, digest of the word sequence, shingles (32-bit hashes, a set), keys of the bands."""
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(docs[id_col].alias("id"), F.monotonically_increasing_id().alias("row"), F.encode(text_of(docs, text_col), "UTF-8").alias("text"))

    def lists(parts: list[np.ndarray], kind) -> pa.ListArray:
        flat = np.concatenate([np.empty(0, dtype=np.int64), *parts]) if not parts else np.concatenate(parts)
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int32)), pa.array(flat, kind))

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, sets, masses = [], [], []
        for text in batch.column("text").to_pylist():
            hashes = word_hashes(text)
            digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
            found, counts = np.unique(shingles(hashes, size), return_counts=True)
            sets.append(found)
            masses.append(counts.astype(np.float64))
        some = [i for i, s in enumerate(sets) if len(s)]
        keys = [np.empty(0, dtype=np.int64)] * len(sets)
        if some:
            signed = dart_min_hash([sets[i] for i in some], bands * rows, [masses[i] for i in some] if weighted else None)
            for i, row in zip(some, band_keys(signed, bands, rows).view(np.int64)):
                keys[i] = row
        small = [np.unique((s >> U(32)).astype(np.uint32)).view(np.int32) for s in sets]
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), pa.array(digests, pa.binary()), lists(small, pa.int32()), lists(keys, pa.int64())], ["id", "row", "digest", "shingles", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                yield part(batch.slice(at, 64))

    return slim.mapInArrow(run, f"id {kind}, row long, digest binary, shingles array<int>, keys array<long>")


def is_settled(edges: DataFrame) -> bool:
    """Whether edges (u, v) are stars: each u has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def contract(links: DataFrame) -> DataFrame:
    """Connected components of (a, b) by alternating large and small stars: (node, root), root the least node."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    while not is_settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.withColumnRenamed("u", "c"), F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(low.select("u", F.col("m").alias("v")))
        edges = materialize(small.distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have at least this Jaccard similarity, exactly."""
    one = sets.select(F.col("row").alias("b_row"), F.col("shingles").alias("b_set"))
    two = sets.select(F.col("row").alias("a_row"), F.col("shingles").alias("a_set"))
    joined = pairs.join(one, F.col("b") == F.col("b_row")).join(two, F.col("a") == F.col("a_row"))
    shared = F.size(F.array_intersect("a_set", "b_set"))
    both = joined.select("a", "b", shared.alias("n"), (F.size("a_set") + F.size("b_set")).alias("total"))
    return both.where(F.col("n") >= F.lit(threshold) * (F.col("total") - F.col("n")) - 1e-9).select("a", "b")


#: Leaders per bucket in each round; what is not settled then is compared in tiles.
LEADERS = (1, 4)
#: Rows in a block of a tile.
BLOCK = 512


def link_classes(met: DataFrame, sets: DataFrame, threshold: float) -> DataFrame | None:
    """(node, root) for the rows that have links, from (key, row, n, meets): rows that meet in buckets.

    A round's leaders are, first, the member that meets most others, and then
    members that are still alone: one that has no links must be held against
    all others anyway, while a class needs no member to be compared for it.
    A leader that has been compared with its whole bucket leaves it, and pairs
    are made once however many buckets two rows share. Buckets that still hold
    several classes after these rounds are compared exactly, tile by tile.
    """
    classes = None
    for number, count in enumerate(LEADERS):
        active = with_class(met, classes)
        # The members are dealt to ``count`` parts by a hash that is the same in every bucket; each part gives one leader.
        seeds = [F.max(F.when(F.pmod(F.xxhash64("row", F.lit(number)), F.lit(count)) == i, F.struct("alone", "meets", "row", "n", "class"))).alias(f"l{i}") for i in range(count)]
        buckets = active.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), *seeds).where("low != high")
        given = F.filter(F.array(*[F.col(f"l{i}") for i in range(count)]), lambda x: x.isNotNull())
        buckets = buckets.select(F.col("key").alias("b_key"), F.transform(given, lambda x: F.struct(x["row"].alias("row"), x["n"].alias("n"), x["class"].alias("class"))).alias("leaders"))
        inside = materialize(active.join(buckets, F.col("key") == F.col("b_key")).select("key", "row", "n", "meets", "class", "leaders"), "active")
        if inside.isEmpty():
            return classes
        per_row = inside.groupBy("row", "n", "class").agg(F.array_distinct(F.flatten(F.collect_set("leaders"))).alias("leaders"))
        fits = lambda x: (F.col("class") != x["class"]) & (F.col("n") >= F.lit(threshold) * x["n"] - 1e-9) & (x["n"] >= F.lit(threshold) * F.col("n") - 1e-9)
        each = per_row.select("row", F.explode(F.transform(F.filter("leaders", fits), lambda x: x["row"])).alias("leader"))
        pairs = each.select(F.least("row", "leader").alias("a"), F.greatest("row", "leader").alias("b")).distinct()
        links = materialize(similar(pairs, sets, threshold), "links")
        met = inside.where(~F.exists("leaders", lambda x: x["row"] == F.col("row"))).select("key", "row", "n", "meets")
        if not links.isEmpty():
            classes = merged(classes, links)
    links = materialize(tiled_links(with_class(met, classes), sets, threshold), "links")
    return classes if links.isEmpty() else merged(classes, links)


def merged(classes: DataFrame | None, links: DataFrame) -> DataFrame:
    known = links if classes is None else links.unionByName(classes.select(F.col("node").alias("a"), F.col("root").alias("b")))
    return contract(known)


def with_class(met: DataFrame, classes: DataFrame | None) -> DataFrame:
    """``met`` with each row's class so far and whether it is alone."""
    if classes is None:
        return met.withColumn("class", F.col("row")).withColumn("alone", F.lit(1))
    # A root is no node of its own: it stands for itself.
    known = classes.select(F.col("node").alias("c_row"), F.col("root").alias("c_root")).unionByName(classes.select(F.col("root").alias("c_row"), F.col("root").alias("c_root")).distinct())
    return met.join(known, F.col("row") == F.col("c_row"), "left").select(*met.columns, F.coalesce("c_root", "row").alias("class"), F.col("c_root").isNull().cast("int").alias("alone"))


def tiled_links(active: DataFrame, sets: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between rows of different classes that share a bucket, all pairs held against each other in tiles.

    A row's home is the largest bucket among its own and its neighbours'; a
    home's rows are dealt to blocks, those that are alone apart from those in
    classes. Two blocks that meet in any
    bucket are one tile, compared once. A task gets two blocks and returns only
    links, so neither the rows moved nor those made grow with the pairs.
    """
    mixed = active.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("size")).where("low != high").select(F.col("key").alias("m_key"), "size")
    inside = materialize(active.join(mixed, F.col("key") == F.col("m_key")).select("key", "row", "class", "alone", "size"), "active")
    # The home of a bucket is the largest home of its rows; a row then moves to the largest home of its buckets.
    home = inside.groupBy("row").agg(F.max(F.struct("size", "key")).alias("home")).withColumnRenamed("row", "r_row")
    shared = inside.join(home, F.col("row") == F.col("r_row")).groupBy("key").agg(F.max("home").alias("home")).withColumnRenamed("key", "s_key")
    homes = inside.join(shared, F.col("key") == F.col("s_key")).groupBy("row").agg(F.max("home").alias("home"), F.first("class").alias("class"), F.first("alone").alias("alone"))
    homes = homes.select(F.col("row").alias("h_row"), "class", "home.key", "alone")
    counts = homes.groupBy("key", "alone").agg(F.count("*").alias("n")).select(F.col("key").alias("k"), F.col("alone").alias("a"), F.ceil(F.col("n") / block).alias("parts"))
    placed = homes.join(counts, (F.col("key") == F.col("k")) & (F.col("alone") == F.col("a"))).select("h_row", "class", F.xxhash64("key", "alone", F.pmod(F.xxhash64("h_row"), F.col("parts"))).alias("block"))
    placed = materialize(placed, "blocks")
    uniform = placed.groupBy("block").agg(F.min("class").alias("low"), F.max("class").alias("high")).withColumnRenamed("block", "u_block")
    meet = inside.join(placed, F.col("row") == F.col("h_row")).select("key", "block").distinct()
    one, two = meet.withColumnRenamed("block", "one"), meet.select(F.col("key").alias("key2"), F.col("block").alias("two"))
    tiles = one.join(two, (F.col("key") == F.col("key2")) & (F.col("one") <= F.col("two"))).select("one", "two").distinct()
    # Two blocks of one and the same class have nothing to tell.
    tiles = tiles.join(uniform, F.col("one") == F.col("u_block")).select("one", "two", F.col("low").alias("low1"), F.col("high").alias("high1")).join(uniform, F.col("two") == F.col("u_block"))
    tiles = tiles.where("least(low, low1) != greatest(high, high1)").select("one", "two", F.xxhash64("one", "two").alias("tile"))
    sides = tiles.select("tile", F.explode(F.array_distinct(F.array("one", "two"))).alias("side"))
    sized = placed.join(sets.select(F.col("row").alias("s_row"), "shingles"), F.col("h_row") == F.col("s_row"))
    members = sides.join(sized, F.col("side") == F.col("block")).select("tile", "side", F.col("h_row").alias("row"), "class", "shingles")

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows, classes = table.column("row").to_numpy(), table.column("class").to_numpy()
        side = table.column("side").to_numpy()
        lists = table.column("shingles").combine_chunks()
        tokens = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
        sizes = np.asarray(lists.value_lengths())
        owner = np.repeat(np.arange(len(rows)), sizes)
        left = np.flatnonzero(side == side.min())
        right = np.flatnonzero(side == side.max())
        shared = np.zeros((len(left), len(right)), dtype=np.float32)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        width = 4096
        for at in range(0, int(tokens[-1]) + 1 if len(tokens) else 0, width):
            cut = slice(*np.searchsorted(tokens, [at, at + width]))
            part = np.zeros((len(rows), width), dtype=np.float32)
            part[owner[cut], tokens[cut] - at] = 1
            shared += part[left] @ part[right].T
        total = sizes[left][:, None] + sizes[right][None, :] - shared
        i, j = np.nonzero((shared >= threshold * total - 1e-9) & (classes[left][:, None] != classes[right][None, :]))
        a, b = rows[left[i]], rows[right[j]]
        ca, cb = classes[left[i]], classes[right[j]]
        # One link for each pair of classes is enough to join them.
        first = np.unique(np.stack([np.minimum(ca, cb), np.maximum(ca, cb)]), axis=1, return_index=True)[1] if len(a) else np.empty(0, dtype=np.int64)
        return pa.table({"a": pa.array(np.minimum(a, b)[first], pa.int64()), "b": pa.array(np.maximum(a, b)[first], pa.int64())})

    return members.groupBy("tile").applyInArrow(compare, "a long, b long")


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, one of each class, with all their columns."""
    laid = materialize(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("document"), F.monotonically_increasing_id().alias("place")), "laid")
    column = options.pop("text_col", "text")
    found = near_duplicates(laid.select("place", F.col(f"document.{column}").alias("text")), "place", "text", **options)
    gone = materialize(found.where("NOT kept").select(F.col("place").alias("g_place")), "gone")
    few = gone.count() <= options.get("broadcast_rows", BROADCAST_ROWS)
    return laid.join(F.broadcast(gone) if few else gone, F.col("place") == F.col("g_place"), "left_anti").select("document.*")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, weighted: bool = False, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: id, class_id (the least id of its class), class_size, kept (one row of each class)."""
    sketched = materialize(sketch(docs, id_col, text_col, size, bands, rows, weighted), "sketch")
    copies = materialize(sketched.groupBy("digest").agg(F.min("row").alias("rep"), F.count("*").alias("copies")).where("copies > 1").select(F.col("digest").alias("c_digest"), F.col("rep").alias("c_rep")), "copies")
    held = lambda df: F.broadcast(df) if df.count() <= broadcast_rows else df
    reps = sketched.select("id", "row", "digest").join(held(copies), F.col("digest") == F.col("c_digest"), "left").select("id", "row", F.coalesce("c_rep", "row").alias("rep"))
    reps = materialize(reps, "reps")
    others = materialize(reps.where("row != rep").select(F.col("row").alias("o_row")), "others")

    firsts = sketched.join(held(others), F.col("row") == F.col("o_row"), "left_anti")
    listed = firsts.select("row", F.size("shingles").alias("n"), F.explode("keys").alias("key"))
    buckets = materialize(listed.groupBy("key").agg(F.count("*").alias("meets")).where("meets > 1").withColumnRenamed("key", "b_key"), "buckets")
    met = materialize(listed.join(held(buckets), F.col("key") == F.col("b_key")).select("key", "row", "n", "meets"), "met")
    degrees = met.groupBy("row").agg(F.sum("meets").alias("degree")).withColumnRenamed("row", "d_row")
    met = met.join(degrees, F.col("row") == F.col("d_row")).select("key", "row", "n", F.col("degree").alias("meets"))
    wanted = met.select(F.col("row").alias("w_row")).distinct()
    wanted, classes = materialize(wanted, "wanted"), None
    if not wanted.isEmpty():
        sets = materialize(sketched.select("row", "shingles").join(held(wanted), F.col("row") == F.col("w_row"), "left_semi"), "sets")
        classes = link_classes(materialize(met, "met"), sets, threshold)
    if classes is None:
        rooted = reps.select("id", "row", F.col("rep").alias("root"))
    else:
        rooted = reps.join(classes, F.col("rep") == F.col("node"), "left").select("id", "row", F.coalesce("root", "rep").alias("root"))
    rooted = materialize(rooted, "rooted")
    groups = rooted.groupBy("root").agg(F.count("*").alias("class_size"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("best")).withColumnRenamed("root", "g_root")
    out = rooted.join(groups, F.col("root") == F.col("g_root"))
    return out.select(F.col("id").alias(id_col), F.col("best.id").alias("class_id"), "class_size", (F.col("row") == F.col("best.row")).alias("kept"), F.col("row").alias("row_number"))
