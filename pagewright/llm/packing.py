"""Packing by first-fit decreasing over randomised groups of documents.

Documents are dealt to groups by a hash of the row number written with them;
each group is tokenised and packed on its own in one task, so the only shuffle
is the deal. The tokenizer's added tokens in a text are those tokens. A document
is cut into full sequences and a rest; the rests of a group are placed longest
first, each into the first sequence with room, which a tournament tree of bin
capacities finds in logarithmic time.

Defined cases: a null text is empty, and an empty document is its end token
alone; a document longer than a sequence is cut, whatever its length; rows that
repeat an id are packed as documents of their own; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_of

LENGTH, END, GROUP = 4096, 2, 3_000_000


class Tournament:
    """Bins of equal capacity; each inner node holds the largest room below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put an item into the first bin with room; return the bin."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        room[at] -= size
        found = at - self.leaves
        while at > 1:
            at //= 2
            left, right = room[2 * at], room[2 * at + 1]
            top = left if left > right else right
            if room[at] == top:
                break
            room[at] = top
        return found


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item, bins in order of opening. Ties keep their order."""
    tree, out = Tournament(len(sizes), capacity), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = tree.place(sizes[i])
    return out


def pieces(lengths: list[int], capacity: int) -> list[tuple[int, int, int]]:
    """(document, start, length): full sequences first, then the rest."""
    return [(d, at, min(capacity, n - at)) for d, n in enumerate(lengths) for at in range(0, n, capacity)]


#: Letters alone, then marks alone: the tokenizer parts these, so each has ids of its own.
PLAIN = re.compile("([a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?]*)")


class Ids:
    """Token ids of texts by a tokenizer file.

    White space ends tokens in this vocabulary and case is dropped, so a text's
    ids are those of its lower-case words, and words repeat. The ids of the
    first ``most`` words met are kept, among them all common ones; other words
    are encoded as they come, those of letters many at a time: in a run of such
    words each ends at an id that the vocabulary marks as a word's end. A text
    that holds an added token, in any case, is encoded as a whole.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.most = most
        self.added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.final = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
        self.final[[i for w, i in self.tokenizer.get_vocab().items() if w.endswith("</w>")]] = True

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(e.ids, dtype="<u4")

    def plain(self, words: list[str], run: int = 256) -> Iterator[bytes]:
        """Ids of words of letters alone, encoded ``run`` at a time."""
        for at in range(0, len(words), run):
            part = words[at : at + run]
            ids = next(self.encode([" ".join(part)]))
            ends = (np.flatnonzero(self.final[ids]) + 1).tolist()
            if len(ends) != len(part):  # not a vocabulary of such ends
                yield from (x.tobytes() for x in self.encode(part))
                continue
            whole, first = ids.tobytes(), 0
            for last in ends:
                yield whole[4 * first : 4 * last]
                first = last

    def fresh(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of different words that are not kept yet."""
        found = [(w, PLAIN.fullmatch(w.decode())) for w in words]
        other = [w for w, m in found if not m]
        out = dict(zip(other, (x.tobytes() for x in self.encode([w.decode() for w in other]))))
        cores = {m[1]: m[1].encode() for _, m in found if m}
        new = [c for c, b in cores.items() if b not in self.known]
        made = dict(zip(new, self.plain(new)))
        tails = list({m[2] for _, m in found if m and m[2]})
        marks = dict(zip(tails, (x.tobytes() for x in self.encode(tails))))
        marks[""] = b""
        for w, m in found:
            if m:
                core = made.get(m[1])
                out[w] = (self.known[cores[m[1]]] if core is None else core) + marks[m[2]]
        return out

    def of(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Each text's ids, with the end token."""
        end = array("I", [END]).tobytes()
        for at in range(0, len(texts), 64):
            words, ends, whole = [], [], {}
            for i, text in enumerate(texts[at : at + 64]):
                lower = text.encode().lower()
                if any(a in lower for a in self.added):
                    whole[i] = next(self.encode([text])).tobytes()
                else:
                    words += lower.split()
                ends.append(len(words))
            parts = list(map(self.known.get, words))
            if None in parts:
                places = [i for i, p in enumerate(parts) if p is None]
                fresh = self.fresh(list({words[i] for i in places}))
                for i in places:
                    parts[i] = fresh[words[i]]
                if len(self.known) + len(fresh) <= self.most:
                    self.known.update(fresh)
            first = 0
            for i, last in enumerate(ends):
                yield np.frombuffer((whole[i] if i in whole else b"".join(parts[first:last])) + end, dtype="<u4")
                first = last


_ids: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """One tokenizer per worker and file."""
    if path not in _ids:
        _ids[path] = Ids(path)
    return _ids[path]


SCHEMA = "id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, group: int = GROUP, seed: int = 0, digests: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``tokenizer`` is a file that every executor has. ``group`` is how many bytes
    of text a group has on average. With ``digests`` the pieces' ids are given
    as their CRC-32 instead, so that they needn't leave the task.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    written = materialize(slim.withColumn("row", F.monotonically_increasing_id()), "pack-rows")
    weight = written.select(F.sum(F.octet_length("text") + 8).alias("bytes")).first()["bytes"] or 0
    groups = max(1, -(-weight // group))
    dealt = written.select("id", "text", F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(groups)).alias("bin"))
    schema = SCHEMA.format(id=kind).replace("ids binary", "ids_crc32 long" if digests else "ids binary")

    def one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        number = key[0].as_py()
        docs_ids = table.column("id")
        columns = {"id": [], "start": [], "length": [], "ids": [], "doc_tokens": [], "at": []}
        at = 0
        for chunk in table.column("text").chunks:
            for found in ids_of(tokenizer).of(chunk.to_pylist()):
                for start in range(0, len(found), length):
                    part = found[start : start + length]
                    columns["at"].append(at)
                    columns["start"].append(start)
                    columns["length"].append(len(part))
                    columns["ids"].append(zlib.crc32(part.tobytes()) if digests else part.tobytes())
                    columns["doc_tokens"].append(len(found))
                at += 1
        placed = np.array(first_fit_decreasing(columns["length"], length), dtype=np.int64)
        sizes = np.array(columns["length"], dtype=np.int64)
        order = np.lexsort((np.arange(len(placed)), placed))
        ends = np.cumsum(sizes[order])
        firsts = np.r_[True, placed[order][1:] != placed[order][:-1]]
        base = np.maximum.accumulate(np.where(firsts, ends - sizes[order], 0))
        offset = np.empty(len(placed), dtype=np.int64)
        offset[order] = ends - sizes[order] - base
        return pa.table(
            {
                "id": docs_ids.take(pa.array(columns["at"], pa.int64())),
                "start": pa.array(columns["start"], pa.int64()),
                "length": pa.array(columns["length"], pa.int64()),
                "ids_crc32" if digests else "ids": pa.array(columns["ids"], pa.int64() if digests else pa.binary()),
                "doc_tokens": pa.array(columns["doc_tokens"], pa.int64()),
                "sequence_id": pa.array((number << 32) + placed, pa.int64()),
                "offset": pa.array(offset, pa.int64()),
            }
        )

    return dealt.groupBy("bin").applyInArrow(one, schema).withColumnRenamed("id", id_col)
