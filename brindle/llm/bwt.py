"""BWT and LCP array of a collection of byte strings, built column by column.

Round j inserts, for every string that is long enough, the suffix of length j. A suffix's place follows from the place
of the suffix that is one shorter: it goes behind as many suffixes as the last-first mapping of the BWT counts. The
common prefix with the suffix before it is one more than the least common prefix between the two shorter ones. Each
round reads and rewrites the BWT and the LCP array in sequence; nothing else is kept but each string's place. Beyond
``spill_bytes`` both live in unnamed files instead of memory.
"""

from __future__ import annotations

import tempfile

import numpy as np


class Column:
    """An array that each round rewrites in sequence: in memory, or in an unnamed file from ``spill`` bytes on."""

    def __init__(self, dtype: type, spill: int):
        self.values, self.spill = np.zeros(0, dtype), spill

    def insert(self, at: np.ndarray, values: np.ndarray) -> None:
        """at: places in the array as it is afterwards, ascending."""
        n = len(self.values) + len(at)
        if n * self.values.itemsize <= self.spill:
            new = np.empty(n, self.values.dtype)
        else:
            with tempfile.TemporaryFile() as f:  # the mapping keeps it; nothing stays on disk afterwards
                f.truncate(n * self.values.itemsize)
                new = np.memmap(f, self.values.dtype, "r+", shape=(n,))
        old = np.ones(n, bool)
        old[at] = False
        new[at] = values
        new[old] = self.values
        self.values = new


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as one array of symbols and their lengths."""
    return np.frombuffer(b"".join(strings), np.uint8), np.fromiter(map(len, strings), np.int64, len(strings))


def build(raw: np.ndarray, lengths: np.ndarray, cap: int = 1 << 30, spill_bytes: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bwt, lcp, owner, start): sorted suffixes of all strings, with the symbol before each (one more than the largest
    at a string's start), the common prefix with the one before (at most ``cap``), its string and where it starts.

    ``raw`` holds the strings one after another, as integers. Ends differ from every symbol and rank below; equal
    suffixes are in the strings' order.
    """
    m = len(lengths)
    letters, flat = np.unique(raw, return_inverse=True)
    start = len(letters)  # the symbol of a string's start
    flat = flat.astype(np.uint8 if start < 1 << 8 else np.uint16 if start < 1 << 16 else np.uint32)
    base = np.cumsum(lengths) - lengths
    bwt, lcp = Column(flat.dtype, spill_bytes), Column(np.int16 if cap < 1 << 15 else np.int32, spill_bytes)
    # round 0: the empty suffixes
    some = lengths > 0
    before = np.full(m, start, flat.dtype)
    before[some] = flat[(base + lengths - 1)[some]]
    bwt.insert(np.arange(m), before)
    lcp.insert(np.arange(m), np.zeros(m, lcp.values.dtype))
    live = np.flatnonzero(some)
    places = live
    symbols = before[live]
    done = 0
    while len(live):
        done += 1
        order = np.argsort(bwt.values, kind="stable")  # positions by symbol: the last-first mapping, in sequence
        edges = np.concatenate([[0], np.cumsum(np.bincount(bwt.values, minlength=start + 1))])
        n = len(order)
        by_symbol = bwt.values[order].astype(np.int64) * n + order
        spot = np.searchsorted(by_symbol, symbols.astype(np.int64) * n + places)  # place in ``order``
        sort = np.argsort(spot)
        spot, live, symbols = spot[sort], live[sort], symbols[sort]
        after = spot + 1 < edges[symbols + 1]
        new_lcp = _common(lcp.values, order, spot, spot > edges[symbols], cap)
        next_lcp = _common(lcp.values, order, spot + 1, after, cap)
        at = spot + m  # behind the m empty suffixes
        more = lengths[live] > done
        symbols = np.where(more, flat[np.maximum(base[live] + lengths[live] - done - 1, 0)], flat.dtype.type(start))
        bwt.insert(at, symbols)
        lcp.insert(at, new_lcp)
        lcp.values[(at + 1)[after]] = next_lcp[after]
        live, places, symbols = live[more], at[more], symbols[more]
    # each string's suffixes from the shortest on, by the finished last-first mapping
    n = len(bwt.values)
    owner, first = np.empty(n, np.int32), np.empty(n, np.int32)
    forward = np.empty(n, np.int64)
    forward[np.argsort(bwt.values, kind="stable")] = np.arange(n)
    at, who = np.arange(m), np.arange(m)
    for j in range(done + 1):
        owner[at], first[at] = who, lengths[who] - j
        more = lengths[who] > j
        who, at = who[more], forward[at[more]] + m
    return np.append(letters, letters[-1] + 1 if start else 0)[bwt.values], lcp.values, owner, first


def _common(lcp: np.ndarray, order: np.ndarray, spot: np.ndarray, inside: np.ndarray, cap: int) -> np.ndarray:
    """One more than the least common prefix between the entries at spot - 1 and spot of ``order``, 0 if not inside."""
    out = np.zeros(len(spot), np.int32)
    some = np.flatnonzero(inside)
    if len(some):
        a, b = order[spot[some] - 1] + 1, order[spot[some]] + 1
        pairs = np.empty(2 * len(some), np.int64)
        pairs[::2], pairs[1::2] = a, b
        padded = np.append(lcp, 0)
        out[some] = np.minimum(np.minimum.reduceat(padded, pairs)[::2] + 1, cap)
    return out


def repeated(raw: np.ndarray, lengths: np.ndarray, length: int, spill_bytes: int = 1 << 20) -> list[np.ndarray]:
    """For each string, whether its substring of ``length`` at each start is also at another start or in another string."""
    _, lcp, who, start = build(raw, lengths, length, spill_bytes)
    hit = lcp >= length
    hit |= np.append(hit[1:], False)
    sizes = np.maximum(0, lengths - length + 1)
    base = np.cumsum(sizes) - sizes
    flags = np.zeros(int(sizes.sum()), bool)
    some = hit & (start <= lengths[who] - length) if len(lengths) else hit
    flags[base[who[some]] + start[some]] = True
    return np.split(flags, base[1:]) if len(lengths) else []
