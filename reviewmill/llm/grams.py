"""Hashed words and character n-grams of whole texts, as numpy arrays over bounded slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE = 1 << 19  # characters held as arrays at a time
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash
_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))
_TABLES: dict = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _TABLES or len(_TABLES["up"]) < n:
        for name, base in (("up", _STEP), ("down", _INVERSE)):
            steps = np.full(max(n, 2 * SLICE), base, np.uint64)
            steps[0] = 1
            _TABLES[name] = np.cumprod(steps)
    return _TABLES["up"], _TABLES["down"]


def slices(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(document numbers, pieces of text) with about SLICE characters in all.

    A long text is cut at blanks, so no word is split unless it alone is longer than a slice.
    """
    where: list[int] = []
    parts: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        at, text = 0, text or ""
        while at < len(text):
            end = min(len(text), at + SLICE)
            if end < len(text):
                blank = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
                end = blank + 1 if blank > at else end
            where.append(i)
            parts.append(text[at:end])
            size += end - at
            at = end
            if size >= SLICE:
                yield np.array(where), parts
                where, parts, size = [], [], 0
    if parts:
        yield np.array(where), parts


def codes(where: np.ndarray, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, document number of each), a blank before, between and after the parts."""
    joined = " " + " ".join(parts) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(where, [len(p) + 1 for p in parts])
    return points, np.concatenate([where[:1], doc])


def blanks(points: np.ndarray) -> np.ndarray:
    return (points == 32) | ((points >= 9) & (points <= 13))


def letters(points: np.ndarray) -> np.ndarray:
    """Whether a code point is a letter, by a table."""
    if "alpha" not in _TABLES:
        _TABLES["alpha"] = np.array([chr(i).isalpha() for i in range(0x30000)])
    table = _TABLES["alpha"]
    return table[np.minimum(points, len(table) - 1)]


def spans(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs between gaps; the first and last entry must be gaps."""
    turn = np.diff(gap.astype(np.int8))
    return np.flatnonzero(turn == -1) + 1, np.flatnonzero(turn == 1) + 1


def span_hash(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, by prefix sums of one rolling hash."""
    up, down = _powers(len(points) + 1)
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def gram_hash(points: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the n code points from each position on."""
    last = len(points) - n + 1
    h = np.full(max(last, 0), n, np.uint64)
    for k in range(n):
        h = h * _STEP + points[k : k + len(h)]
    return mix(h)
