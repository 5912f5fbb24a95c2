"""Text expressions: white space, markup, entities, keys and slugs. All are column expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it.
SPACES = r"(?U)\s+"

#: Names of the commonest entities; the others are those of HTML 5, by the standard library's table.
COMMON = ("amp", "lt", "gt", "quot", "nbsp", "apos", "ndash", "mdash", "hellip", "copy", "middot")

#: Tags that end a line of visible text.
BLOCK_TAGS = "article|section|div|p|br|h[1-6]|li|ol|ul|table|thead|tbody|tfoot|tr|td|th"
#: Elements whose content isn't text.
HIDDEN_TAGS = ("script", "style", "svg", "math")


def squeezed(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def unescaped(text: Column) -> Column:
    """Entities decoded, each once: named ones that end in a semicolon, and numeric ones, with or without it. Others stay."""
    names = [n for n in COMMON] + sorted(n[:-1] for n in html5 if n.endswith(";") and n[:-1] not in COMMON)
    table = F.from_json(F.lit(json.dumps({n: html5[f"{n};"] for n in names})), "map<string,string>")  # one literal for the planner

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]*);", 1)
        number = F.regexp_extract(part, "^#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?", 1)
        hexed = number.rlike("^[xX]")
        code = F.when(hexed, F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number).try_cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")
        rest = F.regexp_replace(part, "^#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?", "")
        named = F.when(name != "", F.concat(F.element_at(table, name), F.substring(part, F.char_length(name) + 2, F.char_length(part))))
        return F.coalesce(named, F.when(valid, F.concat(character, rest)), F.concat(F.lit("&"), part))

    parts = F.split(text, "&")
    return F.when(~text.contains("&"), text).otherwise(F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), decoded), "")))


def stripped_tags(html: Column) -> Column:
    return squeezed(unescaped(F.regexp_replace(html, "<[^>]+>", " ")))


def visible_lines(html: Column) -> Column:
    """Text with a line break where a block tag stood; hidden elements, comments and URLs are gone."""
    for tag in HIDDEN_TAGS:
        html = F.regexp_replace(html, rf"(?is)<{tag}\b.*?</{tag}>", " ")
    html = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    html = F.regexp_replace(html, rf"(?i)</?(?:{BLOCK_TAGS})\b[^>]*>", "\n")
    text = unescaped(F.regexp_replace(html, "<[^>]+>", " "))
    return F.regexp_replace(text, r"(?i)\b(?:https?://|www\.)\S+", " ")


def visible(html: Column) -> Column:
    return squeezed(visible_lines(html))


def diagnostic(text: Column) -> Column:
    """For comparisons: no tags, dashes alike, lower case."""
    return F.lower(F.translate(stripped_tags(text), "‐‑‒–—−", "------"))


def diagnostic_words(text: Column) -> Column:
    return F.regexp_extract_all(diagnostic(text), F.lit("[a-z0-9]+"), F.lit(0))


def observation_key(text: Column, most: int = 120) -> Column:
    """A text with its numbers hidden, so that like observations agree."""
    return F.left(F.regexp_replace(F.lower(stripped_tags(text)), r"\d+", "#"), F.lit(most))


def shortened(text: Column, most: int) -> Column:
    return F.when(F.char_length(text) > most, F.concat(F.rtrim(F.left(text, F.lit(most - 3))), F.lit("..."))).otherwise(text)


def cleaned(text: Column) -> Column:
    """Word characters of any script, dots and dashes; all else becomes one underscore. Nothing left is ``article``."""
    one = F.regexp_replace(text, r"(?U)[^\w.-]+", "_")
    one = F.regexp_replace(F.regexp_replace(one, r"^[._]+|[._]+$", ""), "_+", "_")
    return F.when(one == "", "article").otherwise(one)


def slug(text: Column, most: int = 80) -> Column:
    return F.left(cleaned(text), F.lit(most))


def stable_slug(text: Column, most: int = 24) -> Column:
    """A slug that, where it is cut, ends in a hash of the whole."""
    whole = cleaned(text)
    return F.when(F.char_length(whole) <= most, whole).otherwise(F.concat(F.left(whole, F.lit(most - 9)), F.lit("_"), F.left(F.sha1(F.encode(whole, "UTF-8")), F.lit(8))))


def collapsed_phrases(text: Column) -> Column:
    """A phrase of one to eight words that stands three times or more in a row, once."""
    return F.regexp_replace(text, r"\b((?:\w+ ){0,7}?\w+)(?: \1\b){2,}", "$1")


def joined_addresses(text: Column) -> Column:
    """Mail addresses whose at sign got a space beside it, whole again."""
    return F.regexp_replace(text, r"\b([A-Za-z0-9._%+-]+)(?: @ ?|@ )([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})\b", "$1@$2")


def url_and_rest(url: Column) -> Column:
    """(url, rest): punctuation at the end isn't part of a URL, nor is a bracket that was not opened in it."""
    bare = F.regexp_replace(url, r"[.,;:!?'\"]+$", "")
    count = lambda c: F.char_length(bare) - F.char_length(F.replace(bare, F.lit(c), F.lit("")))
    bare = F.when(bare.endswith(")") & (count(")") > count("(")), F.regexp_replace(bare, r"\)$", "")).otherwise(bare)
    return F.struct(bare.alias("url"), F.substr(url, F.char_length(bare) + 1).alias("rest"))


def url_key(url: Column) -> Column:
    """URLs that differ in scheme, case or a last slash agree."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(url)), r"^https?://(www\.)?", ""), r"/+$", "")
