"""Characters that were decoded with a wrong table, once or twice, put right again."""

from __future__ import annotations

import re

#: Characters that wrong decodings are known for, by the table that they were read with.
CYRILLIC, WESTERN = "—–’“”©°µμΩ×−", "—–’“”…äöüßéèñ°±"
#: Fixed value: a twice decoded apostrophe whose last part was changed on its way.
IRREGULAR = {"РІР‚вЄў": "’"}


def misread(text: str, table: str) -> str:
    """UTF-8 read with another table; bytes that the table doesn't have stay as they are."""
    return "".join(_character(b, table) for b in text.encode())


def _character(byte: int, table: str) -> str:
    try:
        return bytes([byte]).decode(table)
    except UnicodeDecodeError:
        return chr(byte)


def pairs() -> dict[str, str]:
    """What each character became after one and after two wrong decodings."""
    found = dict(IRREGULAR)
    for known, table in ((CYRILLIC, "cp1251"), (WESTERN, "cp1252")):
        for c in known:
            once = misread(c, table)
            found |= {once: c, misread(once, table): c}
    return found


PAIRS = pairs()
#: Longer ones first, so that no part of one is taken for another.
_WRONG = re.compile("|".join(map(re.escape, sorted(PAIRS, key=lambda w: (-len(w), w)))))


def mended(text: str) -> str:
    """The text after replacements until nothing changes."""
    before = None
    while text != before:
        before, text = text, _WRONG.sub(lambda m: PAIRS[m[0]], text)
    return text
