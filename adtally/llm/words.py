"""Words of whole texts as bytes, for the operators that count them in Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes worked on at once; longer texts go through in pieces cut between words.
PIECE = 1 << 20


def word_table(upper: bool = True) -> bytes:
    """A table for ``bytes.translate``: A-Z become a-z, other ASCII than letters and digits a blank.

    Bytes of characters beyond ASCII stay as they are, so words of UTF-8 text stay whole.
    """
    out = bytearray(b" " * 128 + bytes(range(128, 256)))
    for span in (b"09", b"az"):
        for c in range(span[0], span[1] + 1):
            out[c] = c
    if upper:
        for c in range(ord("A"), ord("Z") + 1):
            out[c] = c + 32
    return bytes(out)


TABLE = word_table()


def lowered(text: str | None) -> bytes:
    """The text as bytes with blanks for all that parts words; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE)


def pieces(text: bytes, overlap: int = 0, size: int = PIECE) -> Iterator[tuple[bytes, int]]:
    """(part, own): parts of about ``size`` bytes cut at blanks, the first ``own`` bytes of each its own.

    A part goes on for ``overlap`` words beyond its own bytes, so that runs of words which
    begin in it are whole. A longer word is never cut.
    """
    start = 0
    while start < len(text) or not start:
        stop = text.find(b" ", start + size)
        stop = len(text) if stop < 0 else stop
        end = stop
        for _ in range(overlap):
            while end < len(text) and text[end] == 32:
                end += 1
            after = text.find(b" ", end)
            end = len(text) if after < 0 else after
        yield text[start:end], stop - start
        if stop >= len(text):
            return
        start = stop
