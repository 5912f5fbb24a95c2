"""Bibliographies of paged texts: entries from lines, starts in columns, targets by place.

Lines are classified by column expressions; the fold over a document's ordered
lines is a table function with a partitioned and ordered table argument, which
holds one open entry at a time, however long the document is. Columns of starts
and nearest targets are joins, windows and aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from pagewright.sources import shared

#: What counts as a heading, as the start of an entry, and as an entry's text.
HEADING = r"(?i)^(?:References|Bibliography|Notes and references|R\s+E\s+F\s+E\s+R\s+E\s+N\s+C\s+E\s+S)$"
BRACKETED = r"^\[([1-9]\d{0,3})\]\s*(.*)$"
PUNCTUATED = r"^([1-9]\d{0,3})[.)]\s*(.*)$"
SPACED = r"^([1-9]\d{0,3})[\s\u200b]+(.*)$"
TIGHT = r"^([1-9]\d{0,3})([A-Z].*)$"
BARE = r"^([1-9]\d{0,3})$"
TAIL = r"([1-9]\d{0,3})\u200b+$"
BODY_START = r"^[\[(\"'A-ZÀ-Þ]"
BODY_SIGNS = (
    r"(?i)\b(?:18|19|20)\d{2}\b|\bdoi\b|https?://",
    r"^(?:[A-Z]\.\s*){1,3}[A-ZÀ-Þ]",
    r"^[A-ZÀ-Þ][A-Za-zÀ-ÖØ-öø-ÿ'’.-]+(?:\s+[A-Z]\.?|,\s)",
    r"(?i)\b(?:journal|proceedings?|press|university|patent|science|nature|med(?:icine)?|physiol)\b",
)
BODY_WORD = r"[A-Za-zÀ-ÖØ-öø-ÿ]{3,}"
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"
FURNITURE_WORD = r"(?i)\b(?:journal|surgery)\b"
#: An unheaded list needs so many entries; gaps of at most so many numbers are passed over.
FALLBACK_ENTRIES, PASSED_OVER = 4, 2
#: How far starts of one column are apart, how many make a column, and from which number a few do.
COLUMN_WIDTH, COLUMN_STARTS, HIGH_NUMBER = 24, 4, 20
#: How far from its target a start may be, sidewards, above and at all.
SIDE, ABOVE, FAR = 80, 16, 40
#: Into how many groups cells of heights are dealt, and whether a link is settled, has only starts above it in reach, or no height.
BUCKETS, SETTLED, OVER, FLOATING = 4096, 0, 1, 2


def looks_like_body(text: Column) -> Column:
    """Whether a text looks like the entry of a bibliography."""
    signs = [text.rlike(p) for p in BODY_SIGNS]
    prose = text.rlike("^[A-ZÀ-Þ]") & text.rlike("[,.;:]") & (F.regexp_count(text, F.lit(BODY_WORD)) >= 3)
    found = prose
    for sign in signs:
        found = found | sign
    return (F.char_length(text) >= 8) & text.rlike(BODY_START) & found


def classified(pages: DataFrame, keys: list[str], page: str, text: str) -> DataFrame:
    """One row per line: keys, page, at, line (trimmed), number, body, kind, and what the line looks like.

    ``kind`` is body, punct_only, bare, tail or empty; ``furniture`` marks lines
    that belong to the page and not to the text.
    """
    lines = pages.select(*keys, F.col(page).alias("page"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), LINE_END)).alias("at", "_line"))
    line = F.regexp_replace("_line", r"(?U)^\s+|\s+$", "")
    lines = lines.select(*keys, "page", "at", line.alias("line"))
    group = lambda p, i: F.regexp_extract("line", p, i)
    number = lambda p: F.when(F.col("line").rlike(p), F.struct(group(p, 1).alias("number"), F.regexp_replace(group(p, 2) if p not in (BARE, TAIL) else F.lit(""), r"^[ \t\u200b]+|[ \t\u200b]+$", "").alias("body"), F.lit({BARE: "bare", TAIL: "tail"}.get(p, "body")).alias("kind")))
    start = F.coalesce(*[number(p) for p in (BRACKETED, PUNCTUATED, SPACED, TIGHT, BARE, TAIL)])
    lines = lines.withColumn("_start", start)
    kind = F.when((F.col("_start.kind") == "body") & (F.col("_start.body") == ""), "punct_only").otherwise(F.coalesce("_start.kind", F.lit("")))
    furniture = (F.col("line") == "") | (F.col("line") == F.col("page").cast("string")) | ((F.char_length("line") <= 80) & ~F.col("line").rlike("[,.;:]") & F.col("line").rlike(FURNITURE_WORD))
    return lines.select(*keys, "page", "at", "line", F.col("_start.number").cast("long").alias("number"), F.coalesce("_start.body", F.lit("")).alias("body"), kind.alias("kind"), looks_like_body(F.coalesce(F.col("_start.body"), F.lit(""))).alias("body_like"), looks_like_body(F.col("line")).alias("line_like"), F.col("line").rlike(HEADING).alias("heading"), furniture.alias("furniture"))


class _Fold:
    """The open entry of one reading of a document, and the number that waits for its text."""

    def __init__(self, headed: bool) -> None:
        self.headed, self.inside = headed, not headed
        self.open: list | None = None
        self.pending: tuple[int, int] | None = None
        self.made = self.run = 0
        self.numbers: tuple[int, int] | None = None

    def _run_of(self, number: int) -> int | None:
        """The run of following numbers that an entry is in; none for a number that its run has already."""
        if self.numbers and self.numbers[0] <= number <= self.numbers[1]:
            return None
        if self.numbers and number == self.numbers[1] + 1:
            self.numbers = (self.numbers[0], number)
        else:
            self.run, self.numbers = self.run + 1, (number, number)
        return self.run

    def closed(self) -> list[tuple]:
        entry, self.open = self.open, None
        text = " ".join(entry[2]).strip() if entry else ""
        if not text:
            return []
        self.made += 1
        return [(self.headed, self.made, self._run_of(entry[1]), entry[0], entry[1], text)]

    def read(self, r: Row) -> list[tuple]:
        if not self.inside:
            if r["heading"]:
                self.inside, self.open, self.pending = True, None, None
            return []
        return self._numbered(r) if r["kind"] else self._continued(r)

    def _numbered(self, r: Row) -> list[tuple]:
        number, kind, last = r["number"], r["kind"], self.open and self.open[1]
        if kind != "body":
            if kind == "bare" and self.open and number != last + 1:
                return []
            done = self.closed()
            self.pending = (number, r["page"])
            return done
        if not self.headed and not r["body_like"]:
            if self.open:
                self.open[2].append(r["line"])
            self.pending = None
            return []
        self.pending = None
        if self.open and not last < number <= last + 1 + PASSED_OVER:
            return []
        done = self.closed()
        self.open = [r["page"], number, [r["body"]]]
        return done

    def _continued(self, r: Row) -> list[tuple]:
        if r["furniture"]:
            return []
        if self.pending:
            (number, page), self.pending = self.pending, None
            if r["line_like"]:
                self.open = [page, number, [r["line"]]]
        elif self.open:
            self.open[2].append(r["line"])
        return []


def _fold(keys: list[str], types: list[str]):
    shape = ", ".join(f"{k}: {t}" for k, t in zip(keys, types, strict=True))

    @udtf(returnType=f"{shape}, headed: boolean, nth: int, run: int, page: int, number: long, text: string")
    class Entries:
        """Entries of one document, whose lines come in order: those behind a heading, and those of all its lines."""

        def __init__(self):
            self.folds = (_Fold(True), _Fold(False))
            self.key = ()

        def eval(self, row: Row) -> Iterator[tuple]:
            self.key = tuple(row[k] for k in keys)
            for fold in self.folds:
                for entry in fold.read(row):
                    yield *self.key, *entry

        def terminate(self) -> Iterator[tuple]:
            for fold in self.folds:
                for entry in fold.closed():
                    yield *self.key, *entry

    return Entries


def collected(pages: DataFrame, keys: list[str], page: str, text: str) -> DataFrame:
    """Every entry of every document in both readings: keys, headed, nth, run, page, number, text."""
    lines = classified(pages, keys, page, text)
    types = dict(lines.dtypes)
    entries = _fold(keys, [types[k] for k in keys])
    return entries(lines.asTable().partitionBy(*keys).orderBy("page", "at"))


def entries(pages: DataFrame, keys: list[str], page: str, text: str) -> DataFrame:
    """The bibliography of each document.

    ``pages`` has a row per page. Entries behind a heading count; a document
    without them has its longest run of following numbers, if that is long
    enough. A null text is empty; a document without entries has no rows.
    """
    found = collected(pages, keys, page, text)
    found = found.withColumn("_any", F.max("headed").over(Window.partitionBy(*keys)))
    headed = found.where("headed").select(*keys, "nth", "page", "number", "text")
    loose = found.where("NOT _any AND run IS NOT NULL").withColumn("_size", F.count("*").over(Window.partitionBy(*keys, "run")))
    best = F.max(F.struct("_size", -F.col("run"))).over(Window.partitionBy(*keys))
    loose = loose.withColumn("_best", best).where((F.struct("_size", -F.col("run")) == F.col("_best")) & (F.col("_size") >= FALLBACK_ENTRIES))
    return headed.unionByName(loose.select(*headed.columns))


def column_starts(starts: DataFrame, page: list[str]) -> DataFrame:
    """Starts of references that make up columns: those whose numbers follow each other down the page.

    ``starts`` has the page's keys, number, x and y. From left to right, the
    first start of a column is its seed and the column takes what lies within
    ``COLUMN_WIDTH`` of the seed, so a column's place depends on the order. The
    seeds come from a page's distinct places alone; starts are windows from
    there on, all of them over one order. Starts that are dealt by page already
    are dealt no more, so their partitions bound what a task sorts. Of a column the longest run of steps of one or two stays if it
    has ``COLUMN_STARTS`` starts, the first of equal ones; the whole column
    stays for a number of ``HIGH_NUMBER`` or more.
    """
    seeded = F.aggregate(F.sort_array(F.collect_set("x")), F.array().cast("array<double>"), lambda seeds, x: F.when((F.size(seeds) > 0) & (x - F.element_at(seeds, -1) <= COLUMN_WIDTH), seeds).otherwise(F.concat(seeds, F.array(x))))
    starts = starts.withColumns({"x": F.col("x").cast("double"), "y": F.col("y").cast("double")})
    pages = starts.groupBy(*page).agg(seeded.alias("_seeds"), F.count("*").alias("_n"), F.max("number").alias("_top"))
    pages = pages.where((F.col("_n") >= COLUMN_STARTS) | (F.col("_top") >= HIGH_NUMBER))
    found = starts.join(pages.select(*page, "_seeds"), page).withColumn("column", F.size(F.filter("_seeds", lambda s: s <= F.col("x"))))
    column = [*page, "column"]
    down = Window.partitionBy(*column).orderBy("y", "number", "x")
    step = F.col("number") - F.lag("number").over(down)
    found = found.withColumn("_new", F.when(step.isin(1, 2), 0).otherwise(1))
    found = found.withColumn("_at", F.row_number().over(down))
    # a run is called after the place of its first start
    found = found.withColumn("_run", F.max(F.when(F.col("_new") == 1, F.col("_at"))).over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = Window.partitionBy(*column)
    found = found.withColumns({"_best": F.max(F.struct((F.col("_at") - F.col("_run") + 1).alias("_size"), (-F.col("_run")).alias("_first"))).over(whole), "_high": F.max("number").over(whole)})
    longest = F.col("_best._size") >= COLUMN_STARTS
    found = found.where((longest & (F.col("_run") == -F.col("_best._first"))) | (~longest & (F.col("_high") >= HIGH_NUMBER)))
    return found.select(*page, "column", "number", "x", "y")


def _cells(value: Column, width: int) -> Column:
    cell = F.floor(value / width)
    return F.explode(F.array(cell - 1, cell, cell + 1))


def _nearest(links: pa.Table, starts: pa.Table) -> pa.Table:
    """Links of some cells with ``number``, the nearest start within reach, and ``state``.

    Starts stand in order of height, once for each three columns that they may
    be beside and once for links whose x is unknown. A link goes from its own
    height up and down to the first start that is beside it, and on while a
    further one could be as near, so that dense pages cost no more than sparse
    ones. Behind a link without any, those more than ``ABOVE`` above it are
    looked at.
    """
    x, y = links["x"].to_numpy(), links["y"].to_numpy()
    states = np.where(y == 0, FLOATING, SETTLED).astype("int32")
    numbers = np.zeros(len(x), "int64")
    found = np.full(len(x), -1)
    asked = np.flatnonzero(y != 0)
    if len(asked) and starts.num_rows:
        sx, sy, number = (starts[c].to_numpy() for c in ("sx", "sy", "number"))
        pages = pd.factorize(pd.concat([links["page"].to_pandas(), starts["page"].to_pandas()], ignore_index=True))[0]
        # the stretches that links look through: a page's cell of heights, and of x or of all
        cell = lambda v: np.floor(v / SIDE)
        shifts = [cell(sx) + k for k in (-1, 0, 1)] + ([np.full(len(sx), np.nan)] if (x[asked] == 0).any() else [])
        row = np.tile(np.arange(len(sx)), len(shifts))
        rows = {"page": [pages[asked], pages[len(x) :][row]], "cy": [links["cy"].to_numpy()[asked], starts["cy"].to_numpy()[row]], "cx": [np.where(x[asked] == 0, np.nan, cell(x[asked])), np.concatenate(shifts)]}
        code = pd.DataFrame({k: np.concatenate(v) for k, v in rows.items()}).groupby(["page", "cy", "cx"], dropna=False, sort=False).ngroup().to_numpy()
        own, row_code = code[: len(asked)], code[len(asked) :]
        order = np.lexsort((number[row], sx[row], sy[row], row_code))
        row, row_code = row[order], row_code[order]
        heights = np.concatenate([y[asked], sy[row]])
        merged = np.lexsort((np.arange(len(heights)) >= len(asked), heights, np.concatenate([own, row_code])))
        is_start = merged >= len(asked)
        at = np.empty(len(asked), "int64")
        at[merged[~is_start]] = np.cumsum(is_start)[~is_start]
        first, last = np.searchsorted(row_code, own), np.searchsorted(row_code, own, side="right")
        stretch = _Stretch(x[asked], y[asked], sx[row], sy[row], number[row], first, last)
        best = stretch.best(at, over=False)
        missed = np.flatnonzero(best < 0)
        higher = stretch.best(at, over=True, of=missed)
        states[asked[missed[higher >= 0]]] = OVER
        best[missed] = higher
        found[asked] = np.where(best >= 0, row[np.maximum(best, 0)], -1)
        numbers = np.where(found >= 0, number[np.maximum(found, 0)], 0)
    keep = pa.array(states == SETTLED)
    bare = lambda c: pc.if_else(keep, pa.scalar(None, links.schema.field(c).type), links[c])
    return pa.table([links.column(0), pa.array(numbers, mask=found < 0), pa.array(states), bare("page"), bare("x"), bare("y")], names=[links.column_names[0], "number", "state", "page", "x", "y"])


class _Stretch:
    """Links and the starts of their stretches, in order of height."""

    def __init__(self, x, y, sx, sy, number, first, last) -> None:
        self.x, self.y, self.sx, self.sy, self.number, self.first, self.last = x, y, sx, sy, number, first, last

    def best(self, at: np.ndarray, over: bool, of: np.ndarray | None = None) -> np.ndarray:
        """The start that each link (of ``of``) points to, -1 for none: those more than ABOVE above it, or the others."""
        of = np.arange(len(self.x)) if of is None else of
        best, off = np.full(len(of), -1), np.full(len(of), float(FAR))
        for step in (-1,) if over else (-1, 1):
            live, place = np.arange(len(of)), at[of] - (step < 0)
            while len(live):
                inside = (place[live] >= self.first[of[live]]) & (place[live] < self.last[of[live]])
                live = live[inside]
                link, start = of[live], place[live]
                high = self.sy[start] < self.y[link] - ABOVE
                away = np.abs(self.sy[start] - self.y[link])
                reached = (away <= off[live]) & (over | ~high)
                live, link, start, high, away = (v[reached] for v in (live, link, start, high, away))
                beside = (self.x[link] == 0) | (np.abs(self.sx[start] - self.x[link]) <= SIDE)
                met = beside & (high if over else True)
                better = live[met][self._before(link[met], start[met], best[live[met]])]
                best[better], off[better] = place[better], np.abs(self.sy[place[better]] - self.y[of[better]])
                place[live] += step
        return best

    def _before(self, link: np.ndarray, start: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Whether a start comes before the best one so far: by distance in height, distance below, distance sidewards, place, number."""
        less, same = best < 0, best >= 0
        x, y = self.x[link], self.y[link]
        beside = lambda s: np.where(x == 0, 0.0, np.abs(self.sx[s] - x))
        for rank in (lambda s: np.abs(self.sy[s] - y), lambda s: np.maximum(0.0, self.sy[s] - y), beside, lambda s: self.sx[s], lambda s: self.sy[s], lambda s: self.number[s]):
            a, b = rank(start), rank(best)
            less, same = less | (same & (a < b)), same & (a == b)
        return less


def located_targets(links: DataFrame, starts: DataFrame, link: str) -> DataFrame:
    """For each link the number of the start that it points to, or null: link, number.

    ``links`` has ``link``, page, x and y; ``starts`` has page, number, x, y.
    A place of zero is unknown. Of the page's starts within ``SIDE`` sidewards,
    those not more than ``ABOVE`` above the link come first; of these the
    nearest in height, then the lower distance below, then the nearest
    sidewards, then the first by place and number. None that is more than
    ``FAR`` away in height counts.

    A link goes once to its page's cell of heights, and starts go to the three
    cells within reach; there both are merged in order of height, and no pairs
    are listed. Only links that have nothing but starts above them in reach ask
    whether there are any below, however far; links whose height is unknown
    meet each place's best.
    """
    # one start for each place; of several the lowest number
    s = starts.groupBy("page", F.col("x").cast("double").alias("sx"), F.col("y").cast("double").alias("sy")).agg(F.min("number").cast("long").alias("number"))
    s = s.where("page IS NOT NULL AND sx IS NOT NULL AND sy IS NOT NULL")
    l = links.select(link, "page", F.coalesce(F.col("x").cast("double"), F.lit(0.0)).alias("x"), F.coalesce(F.col("y").cast("double"), F.lit(0.0)).alias("y"))
    bucket = F.pmod(F.xxhash64("page", "cy"), F.lit(BUCKETS)).alias("bucket")
    asking = l.withColumn("cy", F.floor(F.col("y") / FAR)).select(link, "page", "x", "y", "cy", bucket)
    giving = s.withColumn("cy", _cells(F.col("sy"), FAR)).select("page", "sx", "sy", "number", "cy", bucket)
    types = dict(l.dtypes)
    near = asking.groupBy("bucket").cogroup(giving.groupBy("bucket")).applyInArrow(_nearest, f"`{link}` {types[link]}, number long, state int, page {types['page']}, x double, y double")
    near = shared.materialize(near, "nearest")  # most links are settled here

    # what the places beside a link have below it and at the top
    known = F.col("x") != 0
    beside = F.abs(F.col("sx") - F.col("x"))
    top = F.min(F.struct((F.col("sy") < -ABOVE).alias("over"), F.abs("sy").alias("off"), F.greatest(F.lit(0.0), F.col("sy")).alias("below"), "sy", "number")).alias("top")
    place = s.groupBy("page", "sx").agg(F.max("sy").alias("lowest"), top)
    wide = place.groupBy("page").agg(F.max("lowest").alias("lowest"), F.min(F.struct("top.over", "top.off", "top.below", F.lit(0.0).alias("beside"), "sx", "top.sy", "top.number")).alias("top"))
    open_links = near.where(F.col("state") != SETTLED)
    aside = open_links.where(known).withColumn("cx", _cells(F.col("x"), SIDE)).join(place.withColumn("cx", F.floor(F.col("sx") / SIDE)), ["page", "cx"]).where(beside <= SIDE)
    aside = aside.groupBy(link, "state", "y").agg(F.max("lowest").alias("lowest"), F.min(F.struct("top.over", "top.off", "top.below", beside.alias("beside"), "sx", "top.sy", "top.number")).alias("top"), F.max("number").alias("number"))
    aside = aside.unionByName(open_links.where(~known).join(wide, "page").select(link, "state", "y", "lowest", "top", "number"))
    number = F.when(F.col("state") == FLOATING, F.col("top.number")).when(F.col("lowest") < F.col("y") - ABOVE, F.col("number"))
    told = aside.select(link, number.alias("number"))
    settled = near.where(F.col("state") == SETTLED).select(link, "number")
    rest = open_links.select(link).join(told, link, "left")
    return settled.unionByName(rest)
