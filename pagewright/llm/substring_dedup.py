"""Repeated passages across documents: seed and extend.

Seeds. Words are hashed, and of each 13 words (a window) one run of six is
chosen as its anchor, the one with the least hash: winnowing, so two equal
windows choose the same anchor at the same place, and only about two of nine
positions are anchors. Anchors that occur in one document only go no further.

Join. The first document with an anchor leads it. Every other occurrence is
joined with its leader alone, never with all others. Occurrences with one
leader and one distance to it, within a block of either text, are one piece.

Extension. A piece's words, to both sides of its anchors, are compared with the
leader's, word by word. Windows that agree belong to a repeat with the smallest
document that has them, and adjoining windows make up maximal repeats. A window
that doesn't agree may still repeat in others of its group. All its occurrences
disagree with the leader likewise, so they are settled by a second seed, the
window as a whole, whose smallest document is a partial aggregate.

Within a document a window is looked at once; its other occurrences share its
fate when the text is cut. Windows are judged on the input, so no cut changes
what others are compared with.

Defined cases: a null text is empty; texts shorter than a window are left as
they are; rows without an id neither lose words nor cost others any, since no
order is between them; rows that share an id never cost each other words, and
each is cut alike; an empty table gives an empty result. Ids are whole numbers.
Other columns are not read. A text is one task's work, in pieces of a megabyte; nothing else is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of
from .near_dedup import shingles, word_hashes

#: Words of a window, and of an anchor.
WINDOW, ANCHOR = 13, 6
#: Positions in which an anchor can start, in a window.
PLACES = WINDOW - ANCHOR + 1
BLOCK = 128
#: Keys and numbers up to these are broadcast to the texts; beyond, texts are shuffled to them.
BROADCAST_ROWS, BROADCAST_ITEMS = 400_000, 4_000_000
PIECE = 1 << 20
_WHITE = b" \t\n\x0b\x0c\r"


def hashes_of(text: bytes) -> np.ndarray:
    """A hash of each word; a long text is cut at white space, so that memory follows its words and not its bytes."""
    if len(text) <= PIECE:
        return word_hashes(text)
    parts, at = [], 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and text[end] not in _WHITE:
            end += 1
        parts.append(word_hashes(text[at:end]))
        at = end
    return np.concatenate(parts)


def anchors_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and position of each anchor, and the first and last + 1 of the windows that chose it.

    Left out are anchors all of whose windows came before in the same text.
    """
    words = hashes_of(text)
    if len(words) < WINDOW:
        return (np.empty(0, np.int64),) * 4
    grams = shingles(words, ANCHOR)
    view = np.lib.stride_tricks.sliding_window_view(grams, PLACES)
    chosen = np.arange(len(view)) + view.argmin(axis=1)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    last = np.r_[first[1:], len(chosen)]
    at = chosen[first]
    found = grams[at]
    if len(np.unique(found)) < len(found):
        new = np.zeros(len(view), dtype=np.int64)
        new[np.unique(shingles(words, WINDOW), return_index=True)[1]] = 1
        fresh = np.add.reduceat(new, first) > 0
        found, at, first, last = found[fresh], at[fresh], first[fresh], last[fresh]
    return found.view(np.int64), at, first, last


ANCHORS = "anchor long, doc_id long, ver long, pos int, lo int, hi int"


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "doc_id", "ver", "pos", "lo", "hi"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        n = [len(r[2][0]) for r in rows]
        keys = [pa.array(np.repeat(np.array([r[i] for r in rows], np.int64), n)) for i in (0, 1)]
        found = [np.concatenate([r[2][i] for r in rows]) for i in range(4)]
        return pa.record_batch([pa.array(found[0]), *keys, *[pa.array(x.astype(np.int32)) for x in found[1:]]], names)

    for b in batches:
        rows, size = [], 0
        for doc_id, ver, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            found = anchors_of(text.as_py().encode())
            if len(found[0]):
                rows.append((doc_id, ver, found))
                size += len(found[0])
            if size > 100_000:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)


def versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, and a hash of the text, which tells rows of one id apart."""
    text = text_of(docs, text_col)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("ver"), text.alias("text"))


def anchors(texts: DataFrame) -> DataFrame:
    return texts.where("doc_id IS NOT NULL").select("doc_id", "ver", "text").mapInArrow(_anchor_batches, ANCHORS)


def pieces(texts: DataFrame) -> DataFrame:
    """Occurrences of shared anchors with their leaders, by piece: both keys, blocks, distance, and the windows to look at."""
    found = anchors(texts)
    led = found.groupBy("anchor").agg(F.min(F.struct("doc_id", "ver", "pos")).alias("led"), F.max("doc_id").alias("_last")).where("led.doc_id < _last")
    led = materialize(led.select("anchor", F.col("led.doc_id").alias("l_doc"), F.col("led.ver").alias("l_ver"), F.col("led.pos").alias("l_pos")), "leaders")
    met = found.join(led.hint("merge"), "anchor").where("NOT (doc_id = l_doc AND ver = l_ver AND pos = l_pos)")
    by = [F.col("doc_id"), F.col("ver"), F.floor(F.col("pos") / BLOCK).cast("int").alias("block"), F.col("l_doc"), F.col("l_ver"), F.floor(F.col("l_pos") / BLOCK).cast("int").alias("l_block"), (F.col("pos") - F.col("l_pos")).alias("shift")]
    return met.groupBy(*by).agg(F.collect_set(F.struct("lo", "hi")).alias("windows"))


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the blocks that are asked for, with those that its anchors' windows take on either side."""
    names = ["doc_id", "ver", "block", "words"]
    for b in batches:
        out: list[list] = [[], [], [], []]
        size = 0
        for doc_id, ver, text, asked in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
            words = text.as_py().encode().split()
            for block in asked:
                part = b" ".join(words[max(0, block * BLOCK - PLACES + 1) : (block + 1) * BLOCK + WINDOW])
                for column, value in zip(out, (doc_id, ver, block, part.decode())):
                    column.append(value)
                size += len(part)
                if size > 4 << 20:
                    yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.string())], names)
                    out, size = [[], [], [], []], 0
        yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.string())], names)


def _beside_texts(texts: DataFrame, asked: DataFrame, items: str, how: str, broadcast_rows: int, broadcast_items: int) -> DataFrame:
    """Texts joined with what is asked of them: few requests go to the texts, many meet them in a shuffle."""
    n = asked.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size(items)), F.lit(0)).alias("items")).first()
    few = n["rows"] <= broadcast_rows and n["items"] <= broadcast_items
    return texts.join(F.broadcast(asked) if few else asked.hint("merge"), ["doc_id", "ver"], how)


def _base(block: int) -> int:
    return max(0, block * BLOCK - PLACES + 1)


EXTENDED = "doc_id long, ver long, start int, stop int, source long, source_start int, gram string"


def _extend_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of windows that agree with the leader's, and the text of each window that doesn't."""
    schema = pa.schema([("doc_id", pa.int64()), ("ver", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("source", pa.int64()), ("source_start", pa.int32()), ("gram", pa.string())])
    for b in batches:
        out: list[tuple] = []
        for p in b.to_pylist():
            mine, theirs = p["words"].encode().split(b" "), p["l_words"].encode().split(b" ")
            base, l_base, shift = _base(p["block"]), _base(p["l_block"]), p["shift"]
            windows = sorted((w["lo"], w["hi"]) for w in p["windows"])
            begin, end = windows[0][0], max(hi for _, hi in windows) + WINDOW - 1
            # how many words agree from each place on, to the right
            same, agree = 0, {}
            for i in range(end - 1, begin - 1, -1):
                j = i - shift - l_base
                same = same + 1 if 0 <= j < len(theirs) and mine[i - base] == theirs[j] else 0
                agree[i] = same
            run, at = -1, -1
            for s in (s for lo, hi in windows for s in range(lo, hi)):
                whole = agree[s] >= WINDOW
                if run >= 0 and (not whole or s != at + 1):
                    out.append((p["doc_id"], p["ver"], run, at + 1, p["l_doc"], run - shift, None))
                    run = -1
                if whole:
                    run, at = (s, s) if run < 0 else (run, s)
                else:
                    out.append((p["doc_id"], p["ver"], s, s + 1, None, None, b" ".join(mine[s - base : s - base + WINDOW]).decode()))
            if run >= 0:
                out.append((p["doc_id"], p["ver"], run, at + 1, p["l_doc"], run - shift, None))
            if len(out) > 20_000:
                yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS, broadcast_items: int = BROADCAST_ITEMS) -> DataFrame:
    """Windows that also start in a document with a smaller id, as runs: doc_id, ver, start, stop (of the windows' first words), source."""
    texts = versions(docs, id_col, text_col)
    parts = materialize(pieces(texts), "pieces")
    mine = parts.select("doc_id", "ver", "block")
    led = parts.select(F.col("l_doc").alias("doc_id"), F.col("l_ver").alias("ver"), F.col("l_block").alias("block"))
    asked = materialize(mine.union(led).groupBy("doc_id", "ver").agg(F.collect_set("block").alias("blocks")), "asked")
    beside = _beside_texts(texts, asked, "blocks", "inner", broadcast_rows, broadcast_items)
    # rows that repeat whole give each block several times
    blocks = beside.select("doc_id", "ver", "text", "blocks").mapInArrow(_block_batches, "doc_id long, ver long, block int, words string")
    blocks = materialize(blocks.dropDuplicates(["doc_id", "ver", "block"]), "blocks")
    l_blocks = blocks.select(F.col("doc_id").alias("l_doc"), F.col("ver").alias("l_ver"), F.col("block").alias("l_block"), F.col("words").alias("l_words"))
    both = parts.join(blocks.hint("merge"), ["doc_id", "ver", "block"]).join(l_blocks.hint("merge"), ["l_doc", "l_ver", "l_block"])
    both = both.select("doc_id", "ver", "block", "words", "l_doc", "l_block", "l_words", "shift", "windows")
    extended = materialize(both.mapInArrow(_extend_batches, EXTENDED), "extended")
    left = extended.where("gram IS NOT NULL")
    least = left.groupBy("gram").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("_last")).where("source < _last")
    least = materialize(least.select(F.col("gram"), F.col("source")), "seconds")
    again = left.select("doc_id", "ver", "start", "stop", "gram").join(least.hint("merge"), "gram")
    runs = extended.where("gram IS NULL").select("doc_id", "ver", "start", "stop", "source")
    return runs.unionByName(again.select("doc_id", "ver", "start", "stop", "source")).where("source < doc_id")


CUT = "doc_id long, n_words long, n_removed long, kept string"


def _covered(words: list[bytes], hashes: np.ndarray, runs: list[tuple[int, int]]) -> np.ndarray:
    """Which words lie in a window of the runs, or in one with the same words."""
    hit = np.zeros(len(words) - WINDOW + 1, dtype=bool)
    for start, stop in runs:
        hit[start:stop] = True
    grams = shingles(hashes, WINDOW)
    like: dict[int, int] = {}
    for s in np.flatnonzero(hit):
        like.setdefault(int(grams[s]), int(s))
    for s in np.flatnonzero(~hit & np.isin(grams, grams[hit])):
        first = like[int(grams[s])]
        hit[s] = words[s : s + WINDOW] == words[first : first + WINDOW]
    step = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(hit)
    step[starts] += 1  # each start comes once
    np.subtract.at(step, starts + WINDOW, 1)
    return np.cumsum(step[:-1]) > 0


def _cut(digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for text, runs in zip(b.column(1), b.column(2).to_pylist()):
                words = (whole := text.as_py().encode()).split()
                kept, removed = words, 0
                if runs:
                    gone = _covered(words, hashes_of(whole), [(r["start"], r["stop"]) for r in runs])
                    kept, removed = [w for w, g in zip(words, gone.tolist()) if not g], int(gone.sum())
                left = b" ".join(kept)
                out.append((len(words), removed, hashlib.sha256(left).hexdigest() if digests else left.decode()))
            n, removed, kept = zip(*out) if out else ((), (), ())
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return run


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False, broadcast_rows: int = BROADCAST_ROWS, broadcast_items: int = BROADCAST_ITEMS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, and the kept words, joined by one space (or their SHA-256)."""
    found = repeats(docs, id_col, text_col, broadcast_rows, broadcast_items)
    runs = materialize(found.groupBy("doc_id", "ver").agg(F.collect_set(F.struct("start", "stop")).alias("runs")), "runs")
    beside = _beside_texts(versions(docs, id_col, text_col), runs, "runs", "left", broadcast_rows, broadcast_items)
    return beside.select("doc_id", "text", "runs").mapInArrow(_cut(digests), CUT)
