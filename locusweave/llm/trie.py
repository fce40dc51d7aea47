"""Double-array tries over phrases of word numbers; built and walked by numpy, many states at a time."""

from __future__ import annotations

import numpy as np

#: Nodes with at least so many children get a stretch of slots of their own; others go into what is left free.
WIDE = 8


def digits_of(words: int) -> int:
    """Bytes that number any of so many words."""
    return max(1, (max(words - 1, 1).bit_length() + 7) // 8)


class _Slots:
    """The slots of a double array while it grows."""

    def __init__(self, first: int):
        self.base, self.check, self.end = np.zeros(first, np.int32), np.full(first, -1, np.int32), first
        self.low = first

    def room(self, end: int) -> None:
        if end > len(self.check):
            more = max(end, len(self.check) * 5 // 4) - len(self.check)
            self.base, self.check = np.append(self.base, np.zeros(more, np.int32)), np.append(self.check, np.full(more, -1, np.int32))

    def place(self, parents: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Puts the distinct edges (parent state, symbol under 256), sorted by parent and symbol, into slots; the children's states."""
        states, first, fan = np.unique(parents, return_index=True, return_counts=True)
        low, high = symbols[first], symbols[first + fan - 1]
        bases = np.zeros(len(states), np.int64)
        wide = fan >= WIDE
        span = np.where(wide, high - low + 1, 0).astype(np.int64)
        bases[wide] = (self.end + np.cumsum(span) - span - low)[wide]
        self.end += int(span.sum())
        self.room(self.end + 256)
        of = np.repeat(np.arange(len(states)), fan)
        self._fill(states, bases, wide, of, parents, symbols)
        rng, left = np.random.default_rng(len(states)), np.flatnonzero(~wide)
        while len(left):
            # every node left proposes a random place; those go in whose slots are free and claimed first
            slots = self.end - self.low
            taken = int(np.count_nonzero(self.check[self.low : self.end] >= 0))
            if slots < 2 * taken + 2 * len(left) // 8 + 256:
                self.end += max(256, len(left) // 2)
                self.room(self.end + 256)
            guess = rng.integers(self.low, max(self.low + 1, self.end - 255), len(left)) - low[left]
            bases[left] = guess
            edge = np.flatnonzero(np.isin(of, left)) if len(left) < len(states) else np.arange(len(of))
            slot = bases[of[edge]] + symbols[edge]
            _, winner = np.unique(slot, return_index=True)
            good = np.zeros(len(edge), bool)
            good[winner] = True
            good &= (self.check[slot] < 0) & (slot < self.end)
            lost = np.zeros(len(states), bool)
            lost[of[edge[~good]]] = True
            done = np.zeros(len(states), bool)
            done[left] = True
            done &= ~lost
            self._fill(states, bases, done, of, parents, symbols)
            left = left[lost[left]]
        return bases[of] + symbols

    def _fill(self, states, bases, which, of, parents, symbols) -> None:
        self.base[states[which]] = bases[which]
        edge = which[of]
        self.check[(bases[of] + symbols)[edge]] = parents[edge]


def build(phrases: np.ndarray, words: int) -> dict[str, np.ndarray]:
    """The trie of phrases, rows of word numbers under `words` with -1 behind the shorter ones: base, check and, per state, the phrase that ends there (or -1).

    The state of a first word is its number. Any further word is as many steps as it has bytes, so that no node has over 256
    children and they pack closely.
    """
    slots, digits = _Slots(words), digits_of(words)
    state = phrases[:, 0].astype(np.int64)
    ends = []
    for level in range(1, phrases.shape[1]):
        on = np.flatnonzero(phrases[:, level] >= 0)
        if not len(on):
            break
        for k in range(digits - 1, -1, -1):
            pair = state[on] << 8 | (phrases[on, level].astype(np.int64) >> (8 * k) & 255)
            edges, which = np.unique(pair, return_inverse=True)
            state[on] = slots.place(edges >> 8, edges & 255)[which]
        last = on if level + 1 == phrases.shape[1] else on[phrases[on, level + 1] < 0]
        ends.append((state[last], last))
    slots.room(slots.end + 256)
    accept = np.full(len(slots.check), -1, np.int32)
    for where, which in ends:
        accept[where] = which
    return {"base": slots.base, "check": slots.check, "accept": accept}


def step(trie: dict[str, np.ndarray], states: np.ndarray, word: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Advances all states by a word each; which of them got on, and their new states."""
    alive = np.arange(len(states))
    for k in range(digits - 1, -1, -1):
        to = trie["base"][states] + (word >> (8 * k) & 255)
        good = trie["check"][to] == states
        alive, states, word = alive[good], to[good], word[good]
    return alive, states
