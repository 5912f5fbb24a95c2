"""Images inside of documents: data URLs decoded, their ends and headers read."""

from __future__ import annotations

import base64
import re
import struct
from html.parser import HTMLParser
from typing import NamedTuple

#: How base64 of each format begins, how its bytes begin and end, and where a JPEG tells its size.
BARE = {"/9j/": "image/jpeg", "iVBOR": "image/png", "R0lGODlh": "image/gif", "R0lGODdh": "image/gif", "UklGR": "image/webp"}
STARTS = {"image/jpeg": (b"\xff\xd8",), "image/png": (b"\x89PNG\r\n\x1a\n",), "image/gif": (b"GIF87a", b"GIF89a"), "image/webp": (b"RIFF",), "image/svg+xml": (b"<svg", b"<?xml")}
ENDS = {"image/jpeg": b"\xff\xd9", "image/png": b"IEND\xaeB`\x82", "image/gif": b";"}
FRAMES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
SVG_TEXT = ("<svg", "<?xml", "%3csvg", "%3c?xml")
SKIPPED = "data-z2m-inline-skip"
STRIP_WIDTH, STRIP_HEIGHT, STRIP_RATIO = 500, 96, 8.0

_BASE64 = re.compile(r"[A-Za-z0-9+/]+={0,2}")


class Payload(NamedTuple):
    mime: str
    data: bytes | None


def payload(src: str) -> Payload | None:
    """Format and bytes of an embedded image, bytes none if they don't decode; none for what isn't embedded as base64."""
    src = src.strip()
    if src.lower().startswith("data:image/"):
        meta, comma, coded = src.partition(",")
        if not comma or ";base64" not in meta.lower():
            return None
        mime = meta.lower().removeprefix("data:").split(";", 1)[0]
    else:
        coded = src
        mime = next((m for start, m in BARE.items() if re.sub(r"\s+", "", src[:24]).startswith(start)), "")
        if not mime:
            return None
    coded = re.sub(r"\s+", "", coded)
    letters = len(coded.rstrip("="))
    if not _BASE64.fullmatch(coded) or len(coded) % 4 == 1 or (letters < len(coded) and len(coded) % 4):
        return Payload(mime, None)
    try:
        return Payload(mime, base64.b64decode(coded + "=" * (-len(coded) % 4), validate=True))
    except ValueError:
        return Payload(mime, None)


def renderable(src: str) -> bool:
    """Whether an embedded image has its format's beginning and end; anything that isn't embedded passes."""
    found = payload(src)
    if found is None:
        low = src.strip().lower()
        if not low.startswith("data:image/"):
            return True
        meta, comma, text = low.partition(",")
        return bool(comma) and meta.removeprefix("data:").split(";", 1)[0] == "image/svg+xml" and text[:256].lstrip().startswith(SVG_TEXT)
    mime, data = found
    if not data:
        return False
    if mime == "image/webp":
        return len(data) >= 12 and data.startswith(STARTS[mime]) and data[8:12] == b"WEBP"
    if mime == "image/svg+xml":
        return data.lstrip(b"\xef\xbb\xbf \t\r\n").startswith(STARTS[mime])
    return data.startswith(STARTS.get(mime, (b"",))) and data.rstrip(b" \t\r\n").endswith(ENDS.get(mime, b""))


def pixel_size(data: bytes | None) -> tuple[int, int] | None:
    """Width and height of a PNG or JPEG, from its header alone."""
    if not data:
        return None
    if data.startswith(STARTS["image/png"]) and data[12:16] == b"IHDR" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if not data.startswith(STARTS["image/jpeg"]) or len(data) < 12:
        return None
    at = 2
    while at + 9 < len(data):
        if data[at] != 0xFF:
            at += 1
            continue
        marker, at = data[at + 1], at + 2
        while marker == 0xFF and at < len(data):  # fill bytes
            marker, at = data[at], at + 1
        if marker in (0xD8, 0xD9):
            continue
        length = int.from_bytes(data[at : at + 2], "big")
        if len(data) < at + 2 or length < 2 or at + length > len(data):
            return None
        if marker in FRAMES:
            return struct.unpack(">HH", data[at + 3 : at + 7])[::-1] if length >= 7 else None
        at += length
    return None


def is_page_strip(width: int, height: int) -> bool:
    """A wide, low image, such as a rule or a running head."""
    return width >= STRIP_WIDTH and 0 < height <= STRIP_HEIGHT and width / height >= STRIP_RATIO


class _Images(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, bool]] = []

    def handle_starttag(self, tag, attrs):
        if tag == "img":
            named = dict(attrs)
            self.found.append(((named.get("src") or "").strip(), SKIPPED in named))


def sources(html: str) -> list[tuple[str, bool]]:
    """Each live image's source, and whether it was left out on purpose."""
    parser = _Images()
    parser.feed(html)
    parser.close()
    return parser.found


def state(src: str) -> str:
    """missing, broken, unsupported, remote or embedded."""
    low = src.lower()
    if not low:
        return "missing"
    if low.startswith("data:image/"):
        return "embedded" if renderable(src) else "broken"
    return "remote" if low.startswith(("http://", "https://")) else "unsupported"
