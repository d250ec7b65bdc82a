"""FM-index over a set of delimited words, both ways round, searched for words one edit away.

The rows of an index are all suffixes of all words (a closing delimiter ends each), in order, ties by word
number. For each row it keeps the symbol before the suffix; the rows of one symbol are found
by binary search in its sorted row numbers, so ``rank`` costs one search and no sampled table. A
pattern is matched from its end towards its start, and its matches are an interval of rows. Words are
sorted, so the interval of a whole word, opened by the delimiter, is the word's number.

The second index holds the reversed words: there the same steps extend a match to the right. Two
halves of a word share one error at most in one of them, hence the two searches of the scheme: match the
right half exactly from the closing delimiter and go on leftwards with one error (first index), or match the left
half exactly from the opening delimiter and go on rightwards with one error (second index).

Symbols are bytes 1 to 255; the delimiter is 0.
"""

from __future__ import annotations

import numpy as np

_WIDE = 64  # an interval of fewer rows is read row by row, a wider one symbol by symbol


def ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place within the owner) of all elements of lists with these sizes."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Words:
    """Words as one buffer: word i is data[offs[i]:offs[i + 1]]."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs = data, offs
        self.size = np.diff(offs)

    @classmethod
    def of(cls, words: list[bytes]) -> Words:
        return cls(np.frombuffer(b"".join(words), np.uint8), np.append(0, np.cumsum([len(w) for w in words])).astype(np.int64))

    def reversed(self) -> Words:
        owner, k = ragged(self.size)
        return Words(self.data[self.offs[owner + 1] - 1 - k], self.offs)

    def take(self, which: np.ndarray) -> Words:
        owner, k = ragged(self.size[which])
        return Words(self.data[self.offs[which][owner] + k], np.append(0, np.cumsum(self.size[which])))


class Index:
    """FM-index of distinct words. ``number`` gives the word, as numbered by the caller, of each rank."""

    def __init__(self, words: Words):
        n = len(words.size)
        owner, k = ragged(words.size + 1)
        first = np.cumsum(words.size + 1) - (words.size + 1)
        at_end = k == words.size[owner]
        here = words.offs[owner] + k
        text = np.zeros(len(owner), np.uint8)
        text[~at_end] = words.data[here[~at_end]]
        rank = text.astype(np.int64)  # by the first 1, 2, 4, ... symbols; suffixes of one word end at its delimiter
        step, longest = 1, int(words.size.max(initial=0)) + 1
        while step < longest:
            ahead = np.where(k + step <= words.size[owner], rank[np.minimum(np.arange(len(rank)) + step, len(rank) - 1)] + 1, 0)
            key = rank * (int(ahead.max(initial=0)) + 1) + ahead
            values, rank = np.unique(key, return_inverse=True)
            step *= 2
            if len(values) == len(rank):
                break
        order = np.lexsort((owner, rank))
        before = np.where(k[order] > 0, text[order - 1], 0)
        self.rows, self.n = len(order), n
        self.number = owner[order[before == 0]]
        by_symbol = np.argsort(before, kind="stable")
        self._key = before[by_symbol].astype(np.int64) * (self.rows + 1) + by_symbol
        self._first = np.searchsorted(before[by_symbol], np.arange(257))  # rows with a lesser symbol before them
        self.start = np.searchsorted(text[order], np.arange(257))  # rows that begin with a lesser symbol
        self.before = before
        self.symbols = np.flatnonzero(np.diff(self._first))
        self.symbols = self.symbols[self.symbols > 0]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How many of the first ``row`` rows have ``symbol`` before them."""
        return np.searchsorted(self._key, symbol.astype(np.int64) * (self.rows + 1) + row) - self._first[symbol]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of symbol + pattern from that of the pattern."""
        base = self.start[symbol]
        return base + self.rank(symbol, low), base + self.rank(symbol, high)

    def choices(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, symbol) of all symbols, but for the delimiter, that stand before rows of the intervals."""
        narrow = high - low < _WIDE
        owner, k = ragged(np.where(narrow, high - low, 0))
        symbol = self.before[low[owner] + k].astype(np.int64)
        pair = np.unique(owner[symbol > 0] * 256 + symbol[symbol > 0])
        wide = np.flatnonzero(~narrow)
        return (np.concatenate([pair >> 8, np.repeat(wide, len(self.symbols))]),
                np.concatenate([pair & 255, np.tile(self.symbols, len(wide))]))


def one_error(index: Index, queries: Words, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) pairs, each once: the words that equal the query in its last ``exact`` symbols and are one
    inserted, deleted or replaced symbol away in what stands before them."""
    n = len(queries.size)
    size, ends = queries.size, queries.offs[1:]
    low, high = np.zeros(n, np.int64), np.full(n, index.n)  # the rows of the closing delimiter alone
    live = np.arange(n)
    for k in range(int(exact.max(initial=0))):
        live = live[(exact[live] > k) & (high[live] > low[live])]
        low[live], high[live] = index.extend(queries.data[ends[live] - 1 - k].astype(np.int64), low[live], high[live])
    # states with one error: (query, symbols of it still to match, interval)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    live, left = np.flatnonzero(high > low), (size - exact)
    states = [np.zeros(0, np.int64)] * 4
    while len(live) or len(states[0]):
        if len(states[0]):
            q, todo, lo, hi = states
            done = todo == 0
            opened, closed = index.rank(np.zeros(done.sum(), np.int64), lo[done]), index.rank(np.zeros(done.sum(), np.int64), hi[done])
            owner, k = ragged(closed - opened)
            found.append((q[done][owner], index.number[opened[owner] + k]))
            q, todo, lo, hi = q[~done], todo[~done], lo[~done], hi[~done]
            symbol = queries.data[queries.offs[q] + todo - 1].astype(np.int64)
            lo, hi = index.extend(symbol, lo, hi)
            on = hi > lo
            states = [q[on], todo[on] - 1, lo[on], hi[on]]
        if len(live):  # the error comes here: before the symbol left[live] - 1 of the query
            lo, hi, todo = low[live], high[live], left[live]
            owner, symbol = index.choices(lo, hi)
            more_lo, more_hi = index.extend(symbol, lo[owner], hi[owner])
            on = more_hi > more_lo
            owner, symbol, more_lo, more_hi = owner[on], symbol[on], more_lo[on], more_hi[on]
            q, ahead = live[owner], todo[owner]
            other = ahead > 0
            other[other] = queries.data[queries.offs[q[other]] + ahead[other] - 1] != symbol[other]
            skip = todo > 0
            new = [np.concatenate([q, q[other], live[skip]]), np.concatenate([ahead, ahead[other] - 1, todo[skip] - 1]),
                   np.concatenate([more_lo, more_lo[other], lo[skip]]), np.concatenate([more_hi, more_hi[other], hi[skip]])]
            states = _distinct([np.concatenate(x) for x in zip(states, new, strict=True)])
            live, todo = live[skip], todo[skip]
            symbol = queries.data[queries.offs[live] + todo - 1].astype(np.int64)
            low[live], high[live] = index.extend(symbol, lo[skip], hi[skip])
            left[live] -= 1
            live = live[high[live] > low[live]]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)]), axis=1)
    return pair[0], pair[1]


def _distinct(states: list[np.ndarray]) -> list[np.ndarray]:
    """States met twice (one word found by several edits) go on once."""
    q, todo, lo, _ = states
    order = np.lexsort((lo, todo, q))
    same = np.ones(len(order), bool)
    same[1:] = False
    for x in (q, todo, lo, states[3]):
        y = x[order]
        same[1:] |= y[1:] != y[:-1]
    return [x[order[same]] for x in states]
