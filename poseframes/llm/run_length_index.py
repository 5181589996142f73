"""A run-length compressed Burrows-Wheeler index with sampled run ends.

Of the transform only its runs are kept: where each starts and its symbol, how many of that symbol
stand before, and the text positions (samples) of its first and last row. A pattern is streamed
from its end: while the row's symbol is the next one, the row moves by LF; else it moves to the
nearest run of that symbol above or below, whichever sample agrees longer with what is matched so
far. This gives the matching statistics of the pattern: for each position, the length of its
longest match, and a row of such a match. Many patterns are streamed side by side.

For matches of ``k`` symbols or more, rows that agree in k symbols and belong to two strings or
more are kept as intervals with the least owner in each.
"""

from __future__ import annotations

import numpy as np

_SEP = 0  # ends each string; bytes are 1 to 256


class RunLengthIndex:
    def __init__(self, strings: list[bytes], owners: np.ndarray, k: int):
        """``owners``: a number for each string; the index answers with the least of a match."""
        sizes = np.array([len(s) for s in strings], np.int64)
        ends = np.cumsum(sizes + 1)
        text = np.zeros(int(ends[-1]), np.int16)
        at = np.arange(len(text))
        inside = np.ones(len(text), bool)
        inside[ends - 1] = False
        text[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int16) + 1
        self.k, self.text, n = k, text, len(text)
        self.ends, self.owners = ends, np.asarray(owners, np.int64)
        string = np.repeat(np.arange(len(strings)), sizes + 1)
        rows, prefix, self.packed = _suffix_order(text, k)
        self.ranks = np.append(prefix, -1)
        bwt = text[rows - 1]  # row of position 0 gets the last symbol
        heads = np.flatnonzero(np.r_[True, bwt[1:] != bwt[:-1]])
        self.heads, self.symbol = heads, bwt[heads].astype(np.int64)
        self.bounds = np.append(heads, n)
        lengths = np.diff(self.bounds)
        # a bit for each row that begins a run, and how many do before each word of 64
        bits = np.zeros((n // 64 + 1) * 64, bool)
        bits[heads] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words))].astype(np.int64)
        self.first, self.last = rows[heads], rows[heads + lengths - 1]
        # runs by symbol: key of each and the rank and position that LF gives its first row
        order = np.argsort(self.symbol, kind="stable")
        self.keys = (self.symbol[order] << 40) + heads[order]
        self.runs = order
        self.targets = np.empty(len(heads), np.int64)
        self.targets[order] = np.cumsum(lengths[order]) - lengths[order]
        # intervals of rows that agree in k symbols
        whole = (ends - 1)[string] - at >= k
        agree = np.zeros(n + 1, bool)
        a, b = rows[1:], rows[:-1]
        agree[1:n] = whole[a] & whole[b] & (prefix[a] == prefix[b])
        if k > DEPTH:
            fits = agree[1:n]
            fits[fits] &= prefix[a[fits] + k - DEPTH] == prefix[b[fits] + k - DEPTH]
        start = np.flatnonzero(agree[1:] & ~agree[:-1])
        self.starts, self.stops = start, np.flatnonzero(agree[:-1] & ~agree[1:]) + 1
        self.least = np.empty(len(start), np.int64)
        if len(start):
            bounds = np.column_stack([self.starts, self.stops]).reshape(-1)
            own = np.append(self.owners[string[rows]], np.iinfo(np.int64).max)
            self.least = np.minimum.reduceat(own, bounds)[::2]

    def least_owner(self, rows: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """The least owner among the matches of k symbols at these rows and text positions."""
        out = self.owners[np.searchsorted(self.ends, positions, side="right")]
        if len(self.starts):
            i = np.searchsorted(self.starts, rows, side="right") - 1
            inside = (i >= 0) & (rows < self.stops[np.maximum(i, 0)])
            out[inside] = self.least[i[inside]]
        return out

    def stream(self, patterns: list[bytes]):
        """Matching statistics, from the last position of the patterns to the first.

        Yields (pattern numbers, position in each, length of the longest match, row and text position of it)."""
        sizes = np.array([len(p) for p in patterns], np.int64)
        order = np.argsort(-sizes, kind="stable")
        flat = np.frombuffer(b"".join(patterns), np.uint8).astype(np.int64) + 1
        stop = np.cumsum(sizes)[order]
        sizes = sizes[order]
        lanes = len(order)
        row, pos, length = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        n_runs = len(self.heads)
        for step in range(int(sizes[0]) if lanes else 0):
            lanes = int(np.searchsorted(-sizes, -step))  # those longer than step
            row, pos, length = row[:lanes], pos[:lanes], length[:lanes]
            want = flat[stop[:lanes] - 1 - step]
            run = self._run(row)
            other = np.flatnonzero(self.symbol[run] != want) if step else np.arange(lanes)
            if len(other):
                c = want[other]
                i = np.searchsorted(self.keys, (c << 40) + row[other])
                below = self.runs[np.minimum(i, n_runs - 1)]
                above = self.runs[np.maximum(i - 1, 0)]
                has_below = (i < n_runs) & (self.symbol[below] == c)
                has_above = (i > 0) & (self.symbol[above] == c)
                least = length[other]
                up = np.where(has_above, self._common(pos[other], self.last[above], least), -1)
                down = np.where(has_below, self._common(pos[other], self.first[below], least), -1)
                use_up = up >= down
                chosen = np.where(use_up, above, below)
                run[other] = chosen
                row[other] = np.where(use_up, self.bounds[chosen + 1] - 1, self.heads[chosen])
                pos[other] = np.where(use_up, self.last[above], self.first[below])
                length[other] = np.maximum(up, down)
                gone = other[length[other] < 0]  # the symbol is nowhere in the text
            else:
                gone = other
            row = self.targets[run] + row - self.heads[run]
            pos = pos - 1
            length = length + 1
            row[gone], pos[gone], length[gone] = 0, self.first[0], 0
            yield order[:lanes], sizes[:lanes] - 1 - step, length, row, pos

    def _run(self, row: np.ndarray) -> np.ndarray:
        """The run that each row is in: how many runs begin up to it."""
        word = row >> 6
        upto = (np.uint64(2) << (row & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & upto) - 1

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many symbols the text has in common from a and from b on, ``most`` at most. Among so
        many from one of them there is no end of a string, so the zeros behind the text agree with none."""
        out, n = np.zeros(len(a), np.int64), len(self.text)

        def compare(live: np.ndarray) -> np.ndarray:
            """Add the symbols that agree of the next WIDTH; those to go on with."""
            at = out[live]
            differ = self.packed[np.minimum(a[live] + at, n)] ^ self.packed[np.minimum(b[live] + at, n)]
            got = np.zeros(len(live), np.int64)
            for i in range(WIDTH):
                got += differ < _BELOW[i]
            out[live] += got
            return live[(got == WIDTH) & (at + WIDTH < most[live])]

        left = compare(np.flatnonzero(most > 0))
        long = left
        while len(long):  # DEPTH symbols at once, where so many agree
            at = out[long]
            long = long[self.ranks[np.minimum(a[long] + at, n)] == self.ranks[np.minimum(b[long] + at, n)]]
            out[long] += DEPTH
            long = long[out[long] < most[long]]
        left = left[out[left] < most[left]]
        while len(left):
            left = compare(left)
        return np.minimum(out, most)


#: Symbols of 9 bits that are packed into one number, and those that the ranks kept from the sort tell apart.
WIDTH, DEPTH = 7, 28
_BELOW = [np.uint64(1 << 9 * i) for i in range(WIDTH)]


def _suffix_order(text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes (prefix doubling), ranks by the first DEPTH symbols,
    and the first WIDTH symbols from each position on (and from the end on, where zeros follow). Two positions agree in k symbols, DEPTH <= k <= 2 * DEPTH, if their ranks
    and those of the positions k - DEPTH behind are equal."""
    n = len(text)
    padded = np.append(text.astype(np.uint64), np.zeros(WIDTH + 1, np.uint64))
    packed = np.zeros(n + 1, np.uint64)
    for i in range(WIDTH):
        packed = (packed << np.uint64(9)) | padded[i : i + n + 1]
    key = packed[:n]
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    rank[order] = _ranks(key[order])
    depth, prefix = WIDTH, None
    tied = _tied(rank[order])  # rows whose suffix is not told apart yet
    while True:
        if depth == DEPTH:
            prefix = rank.copy()
        if not len(tied) and prefix is not None:
            return order, prefix, packed
        if len(tied):
            rows = order[tied]
            second = np.where(rows + depth < n, rank[np.minimum(rows + depth, n - 1)] + 1, 0)
            key = (rank[rows] << 32) | second
            by = np.argsort(key)
            rows, key = rows[by], key[by]
            order[tied] = rows  # ranks are first rows, so each group stays in its rows
            first = np.r_[True, key[1:] != key[:-1]]
            rank[rows] = tied[np.maximum.accumulate(np.where(first, np.arange(len(tied)), 0))]
            group = rank[rows]
            again = np.r_[group[1:] == group[:-1], False] | np.r_[False, group[1:] == group[:-1]]
            tied = tied[again]
        depth *= 2


def _ranks(keys: np.ndarray) -> np.ndarray:
    """For keys in order the first row with the same one."""
    first = np.r_[True, keys[1:] != keys[:-1]]
    return np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))


def _tied(ranks: np.ndarray) -> np.ndarray:
    same = ranks[1:] == ranks[:-1]
    return np.flatnonzero(np.r_[same, False] | np.r_[False, same])
