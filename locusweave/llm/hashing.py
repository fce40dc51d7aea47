"""Words of many texts as 64-bit numbers, without a Python step per word."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Fixed parameters of the hashes.
BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of text that are worked on at once.
SLAB = 1 << 19


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(n + 1, BASE, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_POWERS = _powers(1 << 12)


def _word_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    if lower:
        data = _LOWER[data]
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = (edge[0::2], edge[1::2]) if space[0] else (np.concatenate([[0], edge[1::2]]), edge[0::2])
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    counts = np.diff(np.searchsorted(starts, bounds))
    out = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    with np.errstate(over="ignore"):
        # position within the word, so that equal words have equal powers
        if len(starts):
            where = np.arange(len(data))
            where[: starts[0]] = 0
            where[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(data))))
            power = _POWERS if lengths.max() < len(_POWERS) else _powers(int(lengths.max()))
            value = _TABLE[data]
            value[space] = 0
            value *= power.take(where, mode="clip")
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)])
            out = mix64(total[ends] - total[starts] + lengths.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
    return out, counts


def pieces(text: bytes) -> list[bytes]:
    """A long text cut at white space into parts of about SLAB bytes; a word is never cut."""
    if len(text) <= 2 * SLAB:
        return [text]
    out, at = [], 0
    while at < len(text):
        m = _GAP.search(text, min(len(text), at + SLAB))
        end = m.end() if m else len(text)
        out.append(text[at:end])
        at = end
    return out


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words `[^\\x20\\x09-\\x0D]+` of the texts in order, and how many each text has.

    A word's hash sums random values of its bytes times powers of an odd number; as prefix sums wrap around, a word's
    sum is a difference of two of them, brought to the same power by the inverse. Long texts are hashed piece by piece.
    """
    if sum(map(len, texts)) <= 2 * SLAB:
        return _word_hashes(texts, lower)
    found, counts = [], []
    for text in texts:
        parts = [_word_hashes([p], lower) for p in pieces(text)]
        found += [h for h, _ in parts]
        counts.append(sum(int(n.sum()) for _, n in parts))
    return np.concatenate(found), np.array(counts, np.int64)


def slabs(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Whole texts in UTF-8, in runs of about SLAB bytes; each with the number of its first text."""
    run, size, first = [], 0, 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace")
        if run and size + len(data) > SLAB:
            yield first, run
            run, size, first = [], 0, i
        run.append(data)
        size += len(data)
    if run:
        yield first, run


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """Per text its set of shingles, as sorted distinct hashes: runs of so many words; the whole sequence if it has fewer; none without words."""
    for _, run in slabs(texts):
        hashes, counts = word_hashes(run)
        at = 0
        with np.errstate(over="ignore"):
            if len(hashes) >= words:
                rolled = np.zeros(len(hashes) - words + 1, np.uint64)
                for k in range(words):
                    rolled = mix64(rolled * np.uint64(BASE) + hashes[k : len(hashes) - words + 1 + k])
            for n in counts.tolist():
                if n >= words:
                    yield np.unique(rolled[at : at + n - words + 1])
                elif n:
                    short = np.zeros(1, np.uint64)
                    for h in hashes[at : at + n]:
                        short = mix64(short * np.uint64(BASE) + h + np.uint64(n))
                    yield short
                else:
                    yield np.zeros(0, np.uint64)
                at += n


_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_PUNCT = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)], np.int64)
SHAPES = 2048


def word_shapes(texts: list[bytes]) -> np.ndarray:
    """A number under SHAPES for each word of the texts, in the order of word_hashes: its length, case, digits, punctuation and last character."""
    if sum(map(len, texts)) > 2 * SLAB and (cut := [p for t in texts for p in pieces(t)]) != texts:
        return np.concatenate([word_shapes([p]) for p in cut])
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not len(data) or (space[0] and not len(edge)):
        return np.zeros(0, np.int64)
    starts, ends = (edge[0::2], edge[1::2]) if space[0] else (np.concatenate([[0], edge[1::2]]), edge[0::2])
    totals = [np.concatenate([[0], np.cumsum(t[data])]) for t in (_UPPER, _DIGIT, _PUNCT)]
    upper, digit, punct = (t[ends] - t[starts] for t in totals)
    length = ends - starts
    case = np.where(upper == 0, 0, np.where((upper == 1) & (length > 1), 1, np.where(2 * upper >= length - punct, 3, 2)))
    last = data[ends - 1]
    last = np.where(_PUNCT[last] == 1, last % 29 + 1, 0)
    return ((np.minimum(1, length // 8) * 4 + case) * 2 + (digit > 0)) * 128 + np.minimum(3, punct) * 32 + last
