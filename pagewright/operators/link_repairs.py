"""Repairs of targets and links of documents: unique targets, merged anchors, links in text.

Tags become rows with offsets. What is renamed, retargeted or merged is settled
by windows over those rows; the documents are put together again from their
offsets, so that all that no change covers stays as it is, byte by byte.

Defined cases: a null document stays null and has nothing to repair; rows that
repeat whole are told apart by their keys alone, which have to be unique.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import escape, unescape
from typing import NamedTuple
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import LongType, StringType, StructType

from pagewright.functions import markup, urls
from pagewright.sources import shared

#: Attributes that name targets by their ids, and what stays as it is in a link's fragment.
IDREFS = frozenset("for headers list form itemref aria-activedescendant aria-controls aria-describedby aria-details aria-errormessage aria-flowto aria-labelledby aria-owns".split())
LOCAL = frozenset(("href", "xlink:href", "usemap"))
CHUNK, PAGES, RENAMED, SAFE = "data-zotero-worker-chunk", "data-pages", "--z2m-", "!$&'()*+,;=:@/?-._~"

_TAG = re.compile(r"<!--[\s\S]*?-->|<(/?)([A-Za-z][\w:.-]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*)>")
_VALUE = re.compile(r"""(?<![\w:-])([\w:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)')""")
_CSS = re.compile(r"""url\(\s*(['"]?)#([^)'"\s]+)\1\s*\)""", re.IGNORECASE)


def _chunk(attrs: str) -> str | None:
    """The key of the part of a document that a section says it is."""
    found = markup.attributes(attrs)
    if not found.get(CHUNK):
        return None
    key = f"p{found[PAGES]}" if found.get(PAGES) else f"c{found[CHUNK]}"
    return (re.sub("[^A-Za-z0-9_.-]+", "-", key).strip("-.") or "chunk")[:64]


def opened(html: str) -> Iterator[tuple[int, str, str, int, str | None]]:
    """Opening tags outside of comments, scripts and styles: start, name, attributes, where they start, part of the document."""
    sections: list[str | None] = []
    inside = None
    for m in _TAG.finditer(html):
        if m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if inside:
            inside = None if closing and name == inside else inside
        elif closing:
            if name == "section" and sections:
                sections.pop()
        else:
            whole = m[3].rstrip().endswith("/")
            part = sections[-1] if sections else None
            if name == "section":
                part = _chunk(m[3]) or part
                if not whole:
                    sections.append(part)
            yield m.start(), name, m[3], m.start(3), part
            if name in ("script", "style") and not whole:
                inside = name


def fragments(html: str) -> Iterator[tuple[str, str, int, str | None, int, int, int]]:
    """Targets of a document, and what refers to them: href, idref (one for each of its words) and css. Role, value, where the tag is, part of the document, start, stop, number of the word."""
    for at, name, attrs, base, chunk in opened(html):
        for m in _VALUE.finditer(attrs):
            attribute, group = m[1].lower(), 2 if m[2] is not None else 3
            value, span = unescape(m[group]), (base + m.start(group), base + m.end(group))
            if attribute == "id" or attribute == "name" and name in ("a", "map"):
                if value:
                    yield "target", value, at, chunk, *span, 0
            elif attribute in LOCAL and value.startswith("#"):
                yield "href", unquote(value[1:]), at, chunk, *span, 0
            elif attribute in IDREFS:
                for part, word in enumerate(value.split()):
                    yield "idref", word, at, chunk, *span, part
        for m in _CSS.finditer(attrs):
            yield "css", unquote(unescape(m[2])), at, chunk, base + m.start(2), base + m.end(2), 0


@udtf(returnType="role: string, value: string, at: int, chunk: string, start: int, stop: int, part: int")
class FragmentTokens:
    """``fragments`` as a table function."""

    def eval(self, html: str) -> Iterator[tuple]:
        yield from fragments(html or "")


def _nearest(rows: DataFrame, by: list[str]) -> Column:
    """For a reference the nearest target of its name in ``by``: of two equally near the one behind. A merge of two sorted lists, not pairs."""
    before = Window.partitionBy(*by).orderBy("at", "is_target").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(*by).orderBy("at", "is_target").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    target = F.when(F.col("is_target") == 1, F.struct("at", "assigned"))
    left, right = F.last(target, ignorenulls=True).over(before), F.first(target, ignorenulls=True).over(after)
    nearer = left.isNull() | (right["at"] - F.col("at") <= F.col("at") - left["at"])
    return F.when(right.isNotNull() & nearer, right["assigned"]).otherwise(left["assigned"])


def with_values(html: str | None, changes: list | None) -> str | None:
    """A document with its changed attributes' values."""

    def value(role: str, names: list[str]) -> str:
        return escape({"target": " ".join(names), "idref": " ".join(names), "href": "#" + quote(names[0], safe=SAFE), "css": quote(names[0], safe=SAFE)}[role], quote=True)

    return html if html is None or changes is None else markup.rebuilt(html, {(x["start"], x["stop"]): value(x["role"], x["names"]) for x in changes})


_REBUILT = F.udf(with_values, StringType(), useArrow=False)


def unique_targets(df: DataFrame, keys: list[str], html: str) -> DataFrame:
    """Documents whose targets are unique, and whose local references lead to the nearest target that had the name.

    The first target keeps a name; a later one is called after the part of the
    document it is in, or by its number. References prefer targets of their own
    part. Adds ``duplicate_targets``, ``renamed_targets`` and
    ``rewritten_references``; ``html`` is replaced.
    """
    tokens = df.select(*keys, html).lateralJoin(FragmentTokens(F.col(html).outer())).drop(html)
    tokens = shared.materialize(tokens, "fragments")  # targets and references are read several times, documents once
    name = [*keys, "value"]
    found = tokens.where("role = 'target'").groupBy(*name, "at", "chunk").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    numbered = found.withColumn("nth", F.row_number().over(Window.partitionBy(*name).orderBy("at"))).withColumn("_of", F.count("*").over(Window.partitionBy(*name)))
    numbered = numbered.withColumn("_since", F.min("at").over(Window.partitionBy(*name)))
    base = F.concat("value", F.lit(RENAMED), F.coalesce("chunk", F.concat(F.lit("d"), F.col("nth").cast("string"))))
    numbered = numbered.withColumn("_base", F.when(F.col("nth") > 1, base))
    # of the names that could be given, those that the document has already are left out
    used = found.groupBy(*keys).agg(F.collect_set("value").alias("_used"))
    kth = F.row_number().over(Window.partitionBy(*keys, "_base").orderBy("_since", "value", "nth"))
    numbered = numbered.where("_of > 1").withColumn("_k", kth).join(used, keys)
    free = F.filter(F.transform(F.sequence(F.lit(1), F.col("_k") + F.size("_used")), lambda i: F.when(i == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("-"), i.cast("string")))), lambda c: ~F.array_contains("_used", c))
    clash = F.exists("_used", lambda u: u.startswith(F.col("_base")))
    given = F.when(clash, F.element_at(free, F.col("_k"))).when(F.col("_k") == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("-"), F.col("_k").cast("string")))
    assigned = numbered.select(*name, "at", "chunk", "spans", "nth", F.when(F.col("nth") == 1, F.col("value")).otherwise(given).alias("assigned"))

    refs = tokens.where("role != 'target'")
    events = assigned.select(*name, "at", "chunk", F.lit(1).alias("is_target"), "assigned", F.lit("").alias("role"), F.lit(0).alias("start"), F.lit(0).alias("stop"), F.lit(0).alias("part"))
    events = events.unionByName(refs.select(*name, "at", "chunk", F.lit(0).alias("is_target"), F.lit(None).cast("string").alias("assigned"), "role", "start", "stop", "part"))
    near = events.withColumn("_same", F.when(F.col("chunk").isNotNull(), _nearest(events, [*name, "chunk"]))).withColumn("_any", _nearest(events, name))
    near = near.where("is_target = 0").withColumn("to", F.coalesce("_same", "_any", "value"))
    spans = near.groupBy(*keys, "role", "start", "stop").agg(F.sort_array(F.collect_list(F.struct("part", "to", "value"))).alias("words"))
    changed = spans.where(F.exists("words", lambda w: w["to"] != w["value"])).select(*keys, "role", "start", "stop", F.transform("words", lambda w: w["to"]).alias("names"), F.lit(0).alias("nth"), F.lit(None).cast("string").alias("value"))
    renamed = assigned.select(*name, "nth", F.array("assigned").alias("names"), F.explode("spans").alias("s")).select(*keys, F.lit("target").alias("role"), "s.start", "s.stop", "names", "nth", "value")
    every = changed.unionByName(renamed)
    ledger = every.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("nth") != 1, F.struct("start", "stop", "role", "names")))).alias("_changes"),
        F.countDistinct(F.when(F.col("nth") == 1, F.col("value"))).alias("duplicate_targets"),
        F.countDistinct(F.when(F.col("nth") > 1, F.struct("value", "nth"))).alias("renamed_targets"),
        F.count(F.when(F.col("nth") == 0, 1)).alias("rewritten_references"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    joined = df.join(ledger, keys, "left")
    return joined.select(*[c for c in df.columns if c != html], _REBUILT(html, "_changes").alias(html), zero("duplicate_targets"), zero("renamed_targets"), zero("rewritten_references"))


def without_broken_links(html: str | None) -> tuple[str | None, int]:
    """A document without the anchors that lead to targets it doesn't have, and how many they were."""
    found = list(fragments(html or ""))
    targets = {value for role, value, *_ in found if role == "target"}
    broken = Counter(at for role, value, at, *_ in found if role == "href" and value and value not in targets)
    if not broken:
        return html, 0
    anchors = [a for a in markup.spans(html, ("a",)) if a[0] in broken]
    tags = {span: "" for start, stop, body_start, body_stop, *_ in anchors for span in ((start, body_start), (body_stop, stop))}
    return markup.rebuilt(html, tags), sum(broken[a[0]] for a in anchors)


_UNWRAP = F.udf(without_broken_links, StructType().add("html", StringType()).add("unwrapped_links", LongType()), useArrow=False)


def unwrap_broken_links(df: DataFrame, keys: list[str], html: str) -> DataFrame:
    """Documents without links to targets that they don't have: the links go, what they show stays. Adds ``unwrapped_links``.

    All that settles a link is in its own document, so nothing is joined or
    shuffled. Documents come to Python a hundred at a time, whatever Arrow's
    batches are, so that what a worker holds doesn't grow with the table.
    """
    done = df.withColumn("_done", _UNWRAP(html))
    return done.select(*[F.col("_done.html").alias(html) if c == html else c for c in df.columns], "_done.unwrapped_links")


# --- runs of anchors -------------------------------------------------------------------------------------------

#: The host of reference anchors, how much text may stand in and between them, and two words that their splits break.
HUB, BODY, MIDDLE, WEB_BODY, MAIL_BODY = "refhub.", 1200, 320, 260, 160
_HREF = re.compile(r"""(?i)(?<![\w:-])href\s*=\s*(?:"[^"]*"|'[^']*')""", re.ASCII)
BROKEN_WORDS = ((r"\baccu\s+racy\b", "accuracy"), (r"\bfl\s+uoroscopic\b", "fluoroscopic"))


class Anchor(NamedTuple):
    start: int
    body_start: int
    body_stop: int
    stop: int


def _hub(html: str, parts: list[Anchor]) -> str:
    first, last = parts[0], parts[-1]
    body = markup.rebuilt(html[first.body_start : last.body_stop], {(a.body_stop - first.body_start, b.start - first.body_start): html[a.stop : b.start] for a, b in zip(parts, parts[1:])})
    for a in parts[1:]:
        body = body.replace(html[a.start : a.body_start], "", 1)
    for wrong, right in BROKEN_WORDS:
        body = re.sub(wrong, right, body, flags=re.IGNORECASE)
    return f"{html[first.start : first.body_start]}{body}</a>"


def _run_value(html: str, kind: str, parts: list[Anchor]) -> str | None:
    if kind == "hub":
        return _hub(html, parts)
    shown = [html[a.start : a.stop] for a in parts]
    gaps = [html[a.stop : b.start] for a, b in zip(parts, parts[1:])]
    return urls.merged_run(shown, gaps) if kind == "web" else urls.merged_mail(shown)


def _target(tag: str) -> str:
    literal = _HREF.search(tag)
    return re.sub(r"""^[\s"']+|[\s"']+\Z""", "", re.sub(r"(?i)^href\s*=\s*", "", literal[0], flags=re.ASCII), flags=re.ASCII) if literal else ""


def _tight(target: str) -> str:
    return re.sub(r"\s+", "", target, flags=re.ASCII).replace("&amp;", "&")


def _link_kind(targets: tuple[str, str], lengths: tuple[int, int], middle: str) -> str | None:
    """What makes one anchor and the next parts of one, from their targets, the lengths of their contents and the text between them."""
    (a, b), longest = targets, max(lengths)
    if a == b and HUB in b.lower() and longest <= BODY and len(middle) <= MIDDLE and re.search("[A-Za-z]", middle) and "<" not in middle:
        return "hub"
    if not re.fullmatch(r"\s+", middle, re.ASCII):
        return None
    if longest <= WEB_BODY and b.lower().startswith(("http://", "https://")) and _tight(a) == _tight(b):
        return "web"
    return "mail" if longest <= MAIL_BODY and b.lower().startswith("mailto:") and a.lower() == b.lower() else None


def runs_of_anchors(html: str, kinds: tuple[str, ...]) -> list[tuple[str, list[Anchor]]]:
    """Runs of neighbouring anchors of one document, each of one kind. Only two anchors are looked at together."""
    runs: list[tuple[str | None, list[Anchor]]] = []
    last = last_target = last_kind = None
    for start, stop, body_start, body_stop, *_ in markup.spans(html, ("a",)):
        anchor, target = Anchor(start, body_start, body_stop, stop), _target(html[start:body_start])
        kind = last and _link_kind((last_target, target), (last.body_stop - last.body_start, body_stop - body_start), html[last.stop : start])
        kind = kind if kind in kinds else None
        # the link to the anchor before makes a run; a run is of one kind
        if kind is None or last_kind not in (None, kind):
            runs.append((kind, [anchor]))
        else:
            runs[-1] = (kind, runs[-1][1])
            runs[-1][1].append(anchor)
        last, last_target, last_kind = anchor, target, kind
    return [(kind, parts) for kind, parts in runs if kind and len(parts) > 1]


@udtf(returnType="kind: string, parts: array<struct<start: int, body_start: int, body_stop: int, stop: int>>")
class AnchorRuns:
    """``runs_of_anchors`` as a table function; kinds are joined by spaces."""

    def eval(self, html: str, kinds: str) -> Iterator[tuple]:
        yield from runs_of_anchors(html or "", tuple(kinds.split()))


def anchor_runs(df: DataFrame, keys: list[str], html: str, kinds: tuple[str, ...] = ("web", "mail", "hub")) -> DataFrame:
    """Runs of neighbouring anchors with one target: keys, kind (hub, web, mail), and the anchors' offsets in order.

    Anchors of a reference hub may have a little text with letters between
    them; other anchors only white space.
    """
    return df.select(*keys, html).lateralJoin(AnchorRuns(F.col(html).outer(), F.lit(" ".join(kinds)))).drop(html)


def merged_runs(html: str | None) -> str | None:
    """A document whose split anchors are one again."""
    for kinds in (("web", "mail"), ("hub",)):
        values = {(parts[0].start, parts[-1].stop): _run_value(html, kind, parts) for kind, parts in runs_of_anchors(html or "", kinds)}
        if values:
            html = markup.rebuilt(html, {span: value for span, value in values.items() if value is not None})
    return html


_MERGE = F.udf(merged_runs, StringType(), useArrow=False)


def merge_anchor_runs(df: DataFrame, keys: list[str], html: str) -> DataFrame:
    """Documents whose split anchors are one again: those of a web or mail address, then those of a reference hub.

    A document is settled by itself, as in ``unwrap_broken_links``: its text
    isn't repeated for each anchor, joined or shuffled.
    """
    return df.withColumn(html, _MERGE(html))


def linked(html: str | None) -> str | None:
    return html if html is None else urls.linked(html)


_LINKED = F.udf(linked, StringType(), useArrow=False)


def autolinked(html: Column | str) -> Column:
    """Documents with links on the URLs and DOIs of their running text. Texts of any length; linking again changes nothing."""
    return _LINKED(html)
