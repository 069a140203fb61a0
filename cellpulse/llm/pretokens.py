"""Splitting text into the words that byte-level BPE encodes one by one.

Equal to matching the published pattern ('s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|
\\s+(?!\\S)|\\s+) from left to right, computed on arrays of code points: a word starts where the class of
character changes, the last white space before other text starts a word, and a plain space joins what follows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

SPACE, LETTER, NUMBER, OTHER = range(4)
# The code points with the Unicode property White_Space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Characters handled at once; longer texts are cut where the pattern is sure to start a word.
CHUNK = 1 << 20


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    text = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "" for c in range(0x110000))
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, text):
            table[found.start() : found.end()] = kind
    table[WHITE] = SPACE
    return table


def starts(points: np.ndarray) -> np.ndarray:
    """Positions in an array of code points at which a word starts."""
    n = len(points)
    kind = classes()[points]
    start = np.ones(n, bool)
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    white = kind == SPACE
    last = np.flatnonzero(white[:-1] & ~white[1:])
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    quote = np.flatnonzero(points == 39)
    if len(quote):
        quote = quote[quote + 1 < n]
        quote = quote[start[quote] & (kind[quote + 1] == LETTER)]
        one = points[quote + 1]
        two = points[np.minimum(quote + 2, n - 1)]
        short = (one == 115) | (one == 116) | (one == 109) | (one == 100)  # s t m d
        long = (((one == 114) | (one == 118)) & (two == 101)) | ((one == 108) & (two == 108))  # re ve ll
        long &= quote + 2 < n
        for taken, length in ((short, 2), (long, 3)):
            at = quote[taken]
            start[at + 1] = False
            start[at[at + length < n] + length] = True
    return np.flatnonzero(start)


def chunks(text: str) -> Iterator[str]:
    """The text in pieces of about CHUNK characters, cut before a single space between other characters."""
    begin = 0
    while len(text) - begin > CHUNK:
        cut = text.find(" ", begin + CHUNK)
        while cut > 0 and cut + 1 < len(text) and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut + 1 >= len(text):
            break
        yield text[begin:cut]
        begin = cut
    yield text[begin:]


def words(text: str) -> list[str]:
    """The words of a text in order; their concatenation is the text."""
    found: list[str] = []
    for piece in chunks(text) if len(text) > CHUNK else (text,):
        if piece:
            at = starts(np.frombuffer(piece.encode("utf-32-le"), np.uint32)).tolist()
            at.append(len(piece))
            found += [piece[a:b] for a, b in zip(at, at[1:])]
    return found
