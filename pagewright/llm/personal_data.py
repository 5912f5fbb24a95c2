"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans in time linear in the text. The field's nodes are
the words that could belong to an entity: those with a digit or an at sign, and
those equal to the local part of an address in the same text. Neighbouring
nodes share a chain edge; nodes with the same letters and digits, the same last
seven digits or the same local part share a skip edge, however far apart, so
that one clear mention speaks for the others. Each node of a group is tied to
the one before it and to the first, so edges grow with the nodes. Loopy
sum-product messages give each node's label; a node outside the base spans that
is surely part of an entity becomes a span of its own.

The field runs in every text that has a digit or an at sign, whether or not the
patterns find anything there. Its weights come from all documents, labelled by
the patterns: a softmax regression of the node features, and log-ratios of label
pairs for the two kinds of edges. What is gathered is a table of feature
patterns and labels, not texts.

Defined cases: a null or empty text has no spans; any length is read whole; a
null id is a row like any other; repeated rows get equal results; an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# Fixed patterns of the base spans, without the local part of an address; a
# digit before it can't begin an ip, as the run's first digit would have.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ANY = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign is tried once: its local part runs left, at most to the last match."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    """By start, then kind."""
    out = [(0, s, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return [(KINDS[k], s, e) for s, k, e in sorted((s, k, e) for k, s, e in out)]



FEATURES = 14


def features(word: str) -> int:
    """Bits of a node's features."""
    digits = sum(c.isdigit() for c in word)
    letters = sum(c.isalpha() for c in word)
    tests = ("@" in word, "@" in word and "." in word.partition("@")[2], word.startswith("+"), digits == 0, 1 <= digits <= 3, 4 <= digits <= 6, 7 <= digits <= 11, 12 <= digits <= 19, digits > 19, letters > 0, word.count(".") == 3 and digits > 3, "-" in word, word.startswith("("), letters > digits)
    return sum(1 << i for i, t in enumerate(tests) if t)


@dataclass
class Graph:
    words: list[tuple[int, int]]
    masks: np.ndarray
    labels: np.ndarray  # 0 none, else 1 + kind, by the base spans
    chain: np.ndarray
    skip: np.ndarray


def graph(text: str, spans: list[Span]) -> Graph:
    """Nodes and edges of a text."""
    locals_ = {text[s:e].partition("@")[0].lower() for k, s, e in spans if k == "email"}
    locals_ = {x for x in locals_ if len(x) >= 4}
    words, masks, keys, places = [], [], defaultdict(list), []
    for place, m in enumerate(WORD.finditer(text)):
        word = m[0]
        bare = word.strip("\"'()[]{}<>,;:!?.").lower()
        if not (ANY.search(word) or bare in locals_):
            continue
        node = len(words)
        words.append(m.span())
        masks.append(features(word))
        places.append(place)
        key = "".join(c for c in bare if c.isalnum())
        digits = "".join(c for c in key if "0" <= c <= "9")
        if len(key) >= 4:
            keys["same", key].append(node)
        if len(digits) >= 7:
            keys["tail", digits[-7:]].append(node)
        local = bare.partition("@")[0]
        if local in locals_:
            keys["local", local].append(node)
    labels, at = np.zeros(len(words), dtype=np.int64), 0
    for k, s, e in spans:
        while at and words[at - 1][1] > s:
            at -= 1
        while at < len(words) and words[at][1] <= s:
            at += 1
        i = at
        while i < len(words) and words[i][0] < e:
            if not labels[i]:
                labels[i] = 1 + KINDS.index(k)
            i += 1
    chain = [(i - 1, i) for i in range(1, len(words)) if places[i] == places[i - 1] + 1]
    skip = {(a, b) for group in keys.values() for i, b in enumerate(group) for a in {group[0], group[max(0, i - 1)]} if a != b}
    edges = lambda x: np.array(sorted(x), dtype=np.int64).reshape(-1, 2)
    return Graph(words, np.array(masks, dtype=np.int64), labels, edges(chain), edges(skip))


LABELS = 1 + len(KINDS)


@dataclass
class Field:
    nodes: np.ndarray  # (FEATURES + 1) x LABELS
    chain: np.ndarray  # LABELS x LABELS
    skip: np.ndarray


def _bits(masks: np.ndarray) -> np.ndarray:
    return np.c_[(masks[:, None] >> np.arange(FEATURES)) & 1, np.ones(len(masks), dtype=np.int64)].astype(np.float64)


def fit(table: list[tuple[str, int, int, int]], rounds: int = 400) -> Field:
    """A field from counts: ("node", mask, label, n), ("chain" or "skip", label, label, n)."""
    pairs = {"chain": np.full((LABELS, LABELS), 0.5), "skip": np.full((LABELS, LABELS), 0.05)}
    nodes = [(m, y, n) for what, m, y, n in table if what == "node"]
    for what, a, b, n in table:
        if what != "node":
            pairs[what][a, b] += n / 2
            pairs[what][b, a] += n / 2
    ratio = {k: np.log(v * v.sum() / np.outer(v.sum(1), v.sum(0))).clip(-4, 4) for k, v in pairs.items()}
    weights = np.zeros((FEATURES + 1, LABELS))
    if nodes:
        x, y, n = _bits(np.array([m for m, _, _ in nodes])), np.array([y for _, y, _ in nodes]), np.array([n for _, _, n in nodes], dtype=np.float64)
        n /= n.sum()
        truth, speed = np.eye(LABELS)[y], np.zeros_like(weights)
        for _ in range(rounds):
            e = x @ weights
            p = np.exp(e - e.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            speed = 0.9 * speed - 0.5 * (x.T @ ((p - truth) * n[:, None]) + 1e-4 * weights)
            weights = weights + speed
    else:
        weights[-1, 0] = 5.0
    return Field(weights, ratio["chain"], ratio["skip"])


def beliefs(field: Field, g: Graph, rounds: int = 12) -> np.ndarray:
    """Label probabilities of each node by damped loopy sum-product; base labels are observed."""
    node = _bits(g.masks) @ field.nodes
    seen = g.labels > 0
    node[seen] = -30.0
    node[seen, g.labels[seen]] = 0.0
    edges = np.concatenate([g.chain, g.skip])
    if len(edges):
        kind = np.r_[np.zeros(len(g.chain), dtype=np.int64), np.ones(len(g.skip), dtype=np.int64)]
        both = np.concatenate([edges, edges[:, ::-1]])
        potential = np.stack([field.chain, field.skip])[np.r_[kind, kind]]
        m, half = np.zeros((len(both), LABELS)), len(edges)
        for _ in range(rounds):
            total = node.copy()
            np.add.at(total, both[:, 1], m)
            rest = total[both[:, 0]] - np.r_[m[half:], m[:half]]
            rest -= rest.max(1, keepdims=True)
            new = np.log(np.einsum("ea,eab->eb", np.exp(rest), np.exp(potential)) + 1e-300)
            m = 0.5 * m + 0.5 * (new - new.max(1, keepdims=True))
        np.add.at(node, both[:, 1], m)
    p = np.exp(node - node.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(text: str, spans: list[Span], field: Field, least: float) -> list[Span]:
    """Nodes outside the base spans that share a skip edge and are surely part of an entity."""
    g = graph(text, spans)
    if not len(g.words) or not len(g.skip) or (g.labels > 0).all():
        return []
    p = beliefs(field, g)
    linked = np.zeros(len(g.words), dtype=bool)
    linked[g.skip.ravel()] = True
    out = []
    for i in np.flatnonzero(linked & (g.labels == 0) & (p[:, 1:].max(1) >= least)):
        s, e = g.words[i]
        while e > s + 1 and text[e - 1] in ".,;:!?)]}>\"'":
            e -= 1
        while s < e - 1 and text[s] in "([{<\"'":
            s += 1
        out.append((KINDS[int(p[i, 1:].argmax())], s, e))
    return out


def gather(docs: DataFrame) -> list[tuple[str, int, int, int]]:
    """The table for ``fit``, from all documents: a row per feature pattern and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int, int], int] = defaultdict(int)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if ANY.search(text):
                    g = graph(text, base_spans(text))
                    for m, y in zip(g.masks.tolist(), g.labels.tolist()):
                        counts["node", m, y] += 1
                    for what, edges in (("chain", g.chain), ("skip", g.skip)):
                        for a, b in edges.tolist():
                            counts[what, int(g.labels[a]), int(g.labels[b])] += 1
        yield pa.RecordBatch.from_pylist([{"what": w, "a": a, "b": b, "n": n} for (w, a, b), n in counts.items()], pa.schema([("what", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]))

    found = docs.select("text").mapInArrow(run, "what string, a long, b long, n long").groupBy("what", "a", "b").agg(F.sum("n").alias("n"))
    return sorted((r["what"], r["a"], r["b"], r["n"]) for r in found.collect())  # bounded: 2^14 patterns, 5 labels


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.9, redacted: bool = False) -> DataFrame:
    """One row per document: id, base and added (arrays of kind, start, end), and with ``redacted`` the text with spans replaced by their kinds."""
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    field = fit(gather(slim))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def hidden(text: str, spans: list[Span]) -> str:
        out, at = [], 0
        for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
            if s >= at:
                out += [text[at:s], f"<{k.upper()}>"]
            at = max(at, e)
        return "".join(out) + text[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, added, texts = [], [], []
            for text in batch.column("text").to_pylist():
                some = ANY.search(text)
                b = base_spans(text) if some else []
                a = added_spans(text, b, field, least) if some else []
                base.append([dict(zip(("kind", "start", "end"), x)) for x in b])
                added.append([dict(zip(("kind", "start", "end"), x)) for x in a])
                if redacted:
                    texts.append(hidden(text, b + a))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(base, span), pa.array(added, span), *([pa.array(texts, pa.string())] if redacted else [])], ["id", "base", "added", *(["redacted"] if redacted else [])])

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    out = slim.mapInArrow(run, f"id {kind}, base {spans}, added {spans}" + (", redacted string" if redacted else ""))
    return out.withColumnRenamed("id", id_col)


def digest(spans: F.Column) -> F.Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.array_position(order, x["kind"]).alias("k"), x["end"].alias("end"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
