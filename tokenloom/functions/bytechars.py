"""Printable stand-ins for bytes, as used by byte-level vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The byte ranges that print as themselves; the other bytes take
# the characters from U+0100 on, in ascending order.
PLAIN_RANGES = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))


def byte_chars() -> list[str]:
    """Character of every byte 0..255."""
    plain = {b for low, high in PLAIN_RANGES for b in range(low, high + 1)}
    moved = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(0x100 + moved.index(b)) for b in range(256)]


_SHOWN = byte_chars()
_MOVED = [b for b in range(256) if _SHOWN[b] != chr(b)]
MOVED_FROM = "".join(chr(b) for b in _MOVED)
MOVED_TO = "".join(_SHOWN[b] for b in _MOVED)


def to_byte_chars(text: Column) -> Column:
    """One printable character per UTF-8 byte, without leaving the JVM."""
    return F.translate(F.decode(text.cast("binary"), "ISO-8859-1"), MOVED_FROM, MOVED_TO)


def from_byte_chars(shown: Column) -> Column:
    """Back to text; bytes that are not valid UTF-8 become U+FFFD."""
    # translate would delete a character that maps to NUL, so that one is replaced by itself
    latin = F.replace(F.translate(shown, MOVED_TO[1:], MOVED_FROM[1:]), F.lit(MOVED_TO[0]), F.lit(MOVED_FROM[0]))
    raw = F.encode(latin, "ISO-8859-1")
    return F.make_valid_utf8(raw.cast("string"))
