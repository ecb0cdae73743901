"""Cutting texts where a byte-level BPE cannot join, and remembering recent pieces.

The splitting rule of such a tokenizer lets a token begin with one space but
never go from another character into white space, so right before a space that
follows a non-space every text may be cut: the tokens of the pieces are the
tokens of the text. Pieces repeat, texts do not.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

CUT = re.compile(r"(?<=\S)(?= )")
ODD = re.compile(r"\s ")
AT_A_TIME = 1_500_000  # characters whose pieces are held at once


def segments(text: str, length: int = AT_A_TIME) -> Iterator[tuple[bool, str]]:
    """(whether a space was cut off before it, segment) of at most about ``length`` characters."""
    at, spaced = 0, False
    while len(text) - at > length:
        cut = CUT.search(text, at + length)
        if cut is None:
            break
        yield spaced, text[at:cut.start()]
        at, spaced = cut.start() + 1, True
    yield spaced, text[at:]


def pieces(segment: str) -> list[str]:
    """The segment at its cuts, the space at the head of all but the first left off."""
    if ODD.search(segment) is None:
        return segment.split(" ")
    first, *rest = CUT.split(segment)
    return [first, *(p[1:] for p in rest)]


def keys(segment: str, spaced: bool) -> list[str]:
    """The pieces as keys: bare after a space, after NUL as they stand."""
    ps = pieces(segment)
    if "\x00" in segment:
        ps[1:] = ["\x00 " + p if p[:1] == "\x00" else p for p in ps[1:]]
        if spaced and ps[0][:1] == "\x00":
            ps[0] = "\x00 " + ps[0]
    if not spaced:
        ps[0] = "\x00" + ps[0]
    return ps


class Recent:
    """Values of the keys of about the last ``2 * limit`` different keys."""

    def __init__(self, compute: Callable[[list[str]], Iterable], limit: int = 150_000):
        self.compute, self.limit, self.young, self.old, self.long = compute, limit, {}, {}, []

    def of(self, keys: set[str]) -> dict[str, object]:
        """A table with a value for each of ``keys``, good until the next call.
        What is not remembered is computed together."""
        for k in self.long:  # not worth remembering
            self.young.pop(k, None)
        self.long.clear()
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        missing = keys - self.young.keys()
        known = missing & self.old.keys()
        self.young.update(zip(known, map(self.old.__getitem__, known), strict=True))
        unknown = list(missing - known)
        if unknown:
            self.young.update(zip(unknown, self.compute(unknown), strict=True))
            self.long.extend(k for k in unknown if len(k) > 100)
        return self.young


def by_text(texts: Iterable[str], recent: Recent, fold: Callable[[Iterable], object], length: int = AT_A_TIME) -> Iterator[list]:
    """For each text, the list of ``fold``-ed values of its segments' pieces, in order.

    ``recent`` computes values of pieces with a leading space; a text's first
    piece, which has none, is asked for as ``"\\x00" + piece``.
    """
    held: list[list[str]] = []
    size = 0

    def flush():
        value = recent.of(set().union(*held)).__getitem__
        for ps in held:
            yield [fold(map(value, ps))]
        held.clear()

    for text in texts:
        if len(text) > length:  # a long text alone, segment by segment
            yield from flush()
            size = 0
            out = []
            for spaced, segment in segments(text, length):
                ps = keys(segment, spaced)
                out.append(fold(map(recent.of(set(ps)).__getitem__, ps)))
            yield out
            continue
        held.append(keys(text, False))
        size += len(text)
        if size >= length:
            yield from flush()
            size = 0
    yield from flush()


def as_text(piece: str) -> str:
    """The piece as it stood in its text."""
    return piece[1:] if piece[:1] == "\x00" else " " + piece
