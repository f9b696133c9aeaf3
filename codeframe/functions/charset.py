"""Bytes to text for lines that Spark's text source hands over undecoded.

``spark.read.text`` keeps raw bytes whatever ``encoding`` says, so a Latin-1 line is broken
UTF-8. In a one-byte charset a character position is a byte position: the field is cut from
the *bytes* (constant cost, no scan from the start of the line) and only text fields are
decoded. Numbers need no decoding at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_CHARSET = "ISO-8859-1"

# Names under which codebooks give each charset.
_ALIASES = {
    "LATIN1": "ISO-8859-1", "LATIN-1": "ISO-8859-1", "ISO8859-1": "ISO-8859-1", "ISO_8859-1": "ISO-8859-1",
    "CP1252": "WINDOWS-1252", "ANSI 1252": "WINDOWS-1252", "ANSI_1252": "WINDOWS-1252",
    "UTF8": "UTF-8", "ASCII": "US-ASCII",
}
_NEAR = 64  # positions up to here are counted in characters without more ado
_ONE_BYTE = {"ISO-8859-1", "WINDOWS-1252", "US-ASCII"}


def canonical(charset: str | None) -> str:
    """Charset name; an absent one is Latin-1."""
    name = (charset or DEFAULT_CHARSET).strip().upper()
    return _ALIASES.get(name, name)


def is_one_byte(charset: str | None) -> bool:
    return canonical(charset) in _ONE_BYTE


def decode(raw: Column, charset: str | None) -> Column:
    """Binary column to text."""
    name = canonical(charset)
    if name == "UTF-8":
        return raw.cast("string")
    if name == "US-ASCII":
        name = DEFAULT_CHARSET  # the same for ASCII bytes, and a stray byte does not stop the job
    if name == "WINDOWS-1252":
        # Differs from Latin-1 only in 0x80-0x9F; the table comes from Python's codec.
        high = [(chr(b), bytes([b]).decode("cp1252", errors="ignore")) for b in range(0x80, 0xA0)]
        pairs = [(a, b) for a, b in high if b]
        return F.translate(F.decode(raw, "ISO-8859-1"), "".join(a for a, _ in pairs), "".join(b for _, b in pairs))
    return F.decode(raw, name)


def slice_field(line: Column, start: int, width: int, charset: str | None, as_text: bool) -> Column:
    """Field at 1-based ``start``: cut, and decoded where the bytes are needed as text."""
    if is_one_byte(charset):
        raw = F.substring(line.cast("binary"), start, width)
        return decode(raw, charset) if as_text else raw.cast("string")
    if canonical(charset) == "UTF-8":
        chars = F.substring(line, start, width)
        if start <= _NEAR:
            return chars
        # Counting characters starts at the head of the line; in a pure ASCII line bytes do.
        ascii_line = F.octet_length(line) == F.length(line)
        return F.when(ascii_line, F.substring(line.cast("binary"), start, width).cast("string")).otherwise(chars)
    return F.substring(decode(line.cast("binary"), charset), start, width)
