"""Monotone sequences in Elias-Fano form, and an n-gram trie of them.

A sequence of n values below u keeps the low log2(u / n) bits of each in a packed array and the rest in unary, about
2 + log2(u / n) bits a value. All arrays of a trie lie in one unlinked temporary file that is mapped into memory: only
pages that queries touch are resident, and nothing is left behind.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

_U = np.uint64
_BYTES, _TOPS = _U(0x0101010101010101), _U(0x8080808080808080)
#: The place of the k-th set bit of a byte.
_NTH = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    _set = [i for i in range(8) if _byte >> i & 1]
    _NTH[_byte, : len(_set)] = _set


class Mapped:
    """Arrays in one mapped file."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        with tempfile.TemporaryFile() as file:
            at, places = 0, {}
            for name, x in arrays.items():
                places[name] = (at, x.dtype, len(x))
                data = x.tobytes() + b"\0" * (-x.nbytes % 8)
                file.write(data)
                at += len(data)
            file.write(b"\0" * 8)
            file.flush()
            self.size = at
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        self.arrays = {n: np.frombuffer(self.map, d, k, a) for n, (a, d, k) in places.items()}


def encode(name: str, values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """The arrays of a non-decreasing sequence of values below universe."""
    n = len(values)
    bits = max(0, (universe // max(1, n)).bit_length() - 1)
    values = values.astype(_U)
    high = (values >> _U(bits)).astype(np.int64) + np.arange(n)
    size = n + (universe >> bits) + 1
    unary = np.zeros(-(-size // 64) * 64, np.uint8)
    unary[high] = 1
    words = np.packbits(unary, bitorder="little").view(_U)
    ones = np.concatenate(([0], np.cumsum(unary.reshape(-1, 64).sum(axis=1, dtype=np.int64))))
    low = np.zeros((n * bits + 63) // 64 + 1, _U)
    if bits:
        at = np.arange(n, dtype=np.int64) * bits
        part = values & _U((1 << bits) - 1)
        word, shift = at >> 6, (at & 63).astype(_U)
        if n:
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            low[word[first]] = np.bitwise_or.reduceat(part << shift, first)
            over = np.flatnonzero(shift.astype(np.int64) + bits > 64)  # one for each word at most
            low[word[over] + 1] |= part[over] >> (_U(64) - shift[over])
    return {
        f"{name}.high": words, f"{name}.ones": ones, f"{name}.low": low,
        f"{name}.head": np.array([n, bits, universe], np.int64 if universe < 2**63 else _U).astype(_U),
    }


class Sequence:
    """Access and search by arrays of queries."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.high, self.ones, self.low = (arrays[f"{name}.{x}"] for x in ("high", "ones", "low"))
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones
        self.n, self.bits = int(arrays[f"{name}.head"][0]), int(arrays[f"{name}.head"][1])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), _U)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(_U)
        out = self.low[word] >> shift
        spill = shift.astype(np.int64) + self.bits > 64
        out[spill] |= self.low[word[spill] + 1] << (_U(64) - shift[spill])
        return out & _U((1 << self.bits) - 1)

    def _select(self, k: np.ndarray, flip: bool) -> np.ndarray:
        """The place of the k-th one (flip: zero) of the unary part."""
        counts = self.zeros if flip else self.ones
        word = np.searchsorted(counts, k, side="right") - 1
        left = k - counts[word]
        words = ~self.high[word] if flip else self.high[word]
        # Ones per byte, summed over the bytes up to each; then the byte, then the bit in it.
        sums = words - ((words >> _U(1)) & _U(0x5555555555555555))
        sums = (sums & _U(0x3333333333333333)) + ((sums >> _U(2)) & _U(0x3333333333333333))
        sums = ((sums + (sums >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _BYTES
        left = (k - counts[word]).astype(_U)
        byte = np.bitwise_count(((left * _BYTES) | _TOPS) - sums & _TOPS).astype(_U) * _U(8)
        byte = np.minimum(byte, _U(56))
        left -= ((sums << _U(8)) >> byte) & _U(255)
        place = _NTH[(words >> byte) & _U(255), np.minimum(left, _U(7))]
        return word * 64 + byte.astype(np.int64) + place

    def get(self, i: np.ndarray) -> np.ndarray:
        if not len(i):
            return np.zeros(0, _U)
        i = np.asarray(i, np.int64)
        high = (self._select(i.copy(), False) - i).astype(_U)
        return (high << _U(self.bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The number of values below x: the place of the first value that is not."""
        return self._search(np.asarray(x, _U))[0]

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of x, or -1."""
        at, end, low = self._search(np.asarray(x, _U))
        out = np.full(len(at), -1, np.int64)
        inside = np.flatnonzero(at < end)
        hit = inside[self._low(at[inside]) == low[inside]]
        out[hit] = at[hit]
        return out

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The successor's place, the end of the values with the same high part, and the low part."""
        if not self.n or not len(x):
            none = np.zeros(len(x), np.int64)
            return none, none, none.astype(_U)
        high = (x >> _U(self.bits)).astype(np.int64)
        most = int(self.zeros[-1])
        past = high >= most
        high = np.minimum(high, most - 1)
        # Values of this high part lie between two zeros of the unary part.
        end = np.minimum(self._select(high.copy(), True) - high, self.n)
        first = np.where(high > 0, self._select(np.maximum(high - 1, 0), True) - (high - 1), 0)
        first = np.minimum(first, self.n)
        low = x & _U((1 << self.bits) - 1)
        a, b = first.copy(), end.copy()
        todo = np.flatnonzero(a < b)
        while len(todo):
            middle = (a[todo] + b[todo]) >> 1
            less = self._low(middle) < low[todo]
            a[todo[less]] = middle[less] + 1
            b[todo[~less]] = middle[~less]
            todo = todo[a[todo] < b[todo]]
        a[past], end[past] = self.n, 0
        return a, end, low


STEP = 1 / 1024  # of log10, to which values are rounded


def quantise(values: np.ndarray) -> np.ndarray:
    """Codes of two bytes: values rounded to a step that depends on no other value, from -32 to 32."""
    return np.clip(np.rint(values / STEP), -(2**15), 2**15 - 1).astype(np.int16)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where the rows of sorted columns change."""
    turn = np.zeros(len(columns[0]), bool)
    turn[:1] = True
    for x in columns:
        turn[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(turn)


class Trie:
    """Two- and three-word sequences u w, v u w, by their contexts u and v u.

    Levels: the words u; their successors w; their predecessors v, which with u are the longer contexts; and of each
    longer context the successors, each written as its place among the successors of u, so that values are small. Every
    level is one monotone sequence: the values of a context are shifted by the context's number times the universe (or
    by where the successors of u start). Pointers from a context to its values are monotone too.

    Probabilities are smoothed by adding to the counts of a context the shorter context's probabilities, as if they had
    been seen `weight` times (a Dirichlet prior):

        p(w | u) = (n(u w) + weight p(w)) / (n(u) + weight)
        p(w | v u) = (n(v u w) + weight p(w | u)) / (n(v u) + weight)

    Of a sequence v u w the trie keeps the log10 of (n(v u w) + weight p(w | u)) / weight, and of a pair that of
    weight / (n + weight), its share left for unseen successors. The two are added where both are known: a share of all
    the successors of u suffices to tell them, and they do not depend on what else the trie holds.
    """

    def __init__(
        self, v: np.ndarray, u: np.ndarray, w: np.ndarray, single: np.ndarray, times: np.ndarray, total: np.ndarray,
        weight: tuple[float, float],
    ):
        """Rows are distinct sequences, sorted by u, v, w, with all that were seen of each pair u w.

        single: the probability of w alone; times: how often seen; total: how often u was followed by a word.
        """
        arrays, self.universe = {}, int(max(w.max(initial=0), v.max(initial=0))) + 1
        self.weight = weight

        def level(name: str, group: np.ndarray, n_groups: int, values: np.ndarray, universe: int):
            arrays.update(encode(name, group.astype(_U) * _U(universe) + values.astype(_U), n_groups * universe + 1))
            ends = np.concatenate(([0], np.cumsum(np.bincount(group, minlength=n_groups))))
            arrays.update(encode(f"{name}.ptr", ends, len(values) + 1))

        words = u[_starts(u)]
        arrays.update(encode("words", words, int(words[-1]) + 1 if len(words) else 1))
        heads = _starts(u, v)
        context = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(u))))
        context_owner = np.searchsorted(words, u[heads])
        level("context", context_owner, len(words), v[heads], self.universe)

        pairs, first, place = np.unique(
            context_owner[context] * self.universe + w, return_index=True, return_inverse=True
        )  # of the word's number and its successor, which fit 63 bits for up to three billion of each
        owner = pairs // self.universe
        level("two", owner, len(words), pairs % self.universe, self.universe)
        seen = np.bincount(place, times, len(pairs))
        p2 = (seen + weight[0] * single[first]) / (total[first] + weight[0])
        arrays["two.code"], arrays["two.left"] = quantise(np.log10(p2)), quantise(np.log10(weight[1] / (seen + weight[1])))

        starts = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(words)))))
        relative = place - starts[context_owner[context]]
        self.width = int(np.diff(starts).max(initial=0)) + 1
        level("three", context, len(heads), relative, self.width)
        arrays["three.code"] = quantise(np.log10(times / weight[1] + p2[place]))
        self.mapped = Mapped(arrays)
        self.sizes = (len(words), len(p2), len(heads), len(u))

    def log10(self, v, u, w, single, total) -> tuple[np.ndarray, np.ndarray]:
        """Of each v u w: log10 of (n(v u w) + weight p(w | u)) / weight, and of the share left for unseen words after u w.

        log10 p(w | v u) is the first of these for v u w and the second for v u.
        """
        m = self.mapped.arrays
        seq = lambda name: Sequence(m, name)
        out = np.log10(single * self.weight[0] / (total + self.weight[0]))
        left = np.zeros(len(out))
        if not self.sizes[0] or not len(u):
            return out, left
        turn = _starts(u)  # equal neighbours are looked up once
        word = np.repeat(seq("words").find(u[turn]), np.diff(np.append(turn, len(u))))
        rows = np.flatnonzero(word >= 0)
        if not len(rows):
            return out, left
        word, q, before = word[rows], w[rows], v[rows]

        # Of a pair beyond the universe none is there.
        key, back = np.unique(word * (self.universe + 1) + np.minimum(q, self.universe), return_inverse=True)
        of, to = key // (self.universe + 1), key % (self.universe + 1)
        two = np.where(to < self.universe, seq("two").find(of * self.universe + np.minimum(to, self.universe - 1)), -1)[back]
        pair = np.flatnonzero(two >= 0)
        out[rows[pair]] = m["two.code"][two[pair]] * STEP
        left[rows[pair]] = m["two.left"][two[pair]] * STEP
        turn = _starts(word, before)
        known = before[turn] < self.universe
        found = seq("context").find(word[turn] * self.universe + np.where(known, before[turn], 0))
        context = np.repeat(np.where(known, found, -1), np.diff(np.append(turn, len(word))))
        inner = pair[context[pair] >= 0]
        # The word's place among the successors of u is what the longer context lists.
        relative = two[inner] - seq("two.ptr").get(np.arange(self.sizes[0])).astype(np.int64)[word[inner]]
        three = seq("three").find(context[inner] * self.width + relative)
        hit = three >= 0
        out[rows[inner[hit]]] = m["three.code"][three[hit]] * STEP
        return out, left
