"""Elias-Fano sequences and a two-level n-gram trie over them, as flat images that are mapped and not parsed."""

from __future__ import annotations

import mmap

import numpy as np

U64 = np.uint64
ONE, WORD = U64(1), U64(63)


def within(words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th set bit (from 0) of each 64-bit word, by halving."""
    w, r, at = words.copy(), r.astype(np.int64), np.zeros(len(words), dtype=np.int64)
    for s in (32, 16, 8, 4, 2, 1):
        low = w & U64((1 << s) - 1)
        n = np.bitwise_count(low).astype(np.int64)
        up = r >= n
        r -= np.where(up, n, 0)
        at += np.where(up, s, 0)
        w = np.where(up, w >> U64(s), low)
    return at


class Image:
    """Named arrays in one buffer: a small directory, then the bytes, each array at a multiple of eight."""

    @staticmethod
    def of(arrays: list[np.ndarray]) -> bytes:
        head, body, at = [len(arrays)], [], 8 * (1 + 3 * len(arrays))
        for a in arrays:
            head += [at, len(a), a.dtype.itemsize]
            raw = a.tobytes()
            body.append(raw + b"\0" * (-len(raw) % 8))
            at += len(body[-1])
        return np.array(head, dtype=np.int64).tobytes() + b"".join(body)

    @staticmethod
    def views(buffer) -> list[np.ndarray]:
        n = int(np.frombuffer(buffer, np.int64, 1)[0])
        head = np.frombuffer(buffer, np.int64, 3 * n, 8).reshape(n, 3).tolist()
        return [np.frombuffer(buffer, f"<u{size}", count, at) for at, count, size in head]


def mapped(image: bytes):
    """The image in memory of its own that the system may page."""
    room = mmap.mmap(-1, max(1, len(image)))
    room[: len(image)] = image
    return room


class Sequence:
    """A non-decreasing sequence: low bits packed, high parts in unary, ones counted before each word."""

    ARRAYS = 4

    def __init__(self, arrays: list[np.ndarray]):
        meta, self.low, self.high, self.ones = arrays
        self.n, self.bits = int(meta[0]), int(meta[1])
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones.astype(np.int64)

    @staticmethod
    def encoded(values: np.ndarray) -> list[np.ndarray]:
        values = values.astype(U64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, ((top + 1) // max(1, n)).bit_length() - 1)
        high = (values >> U64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(-(-((top >> bits) + n + 2) // 64) * 64, dtype=np.uint8)
        flags[high] = 1
        words = np.packbits(flags, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1].astype(np.uint32)
        low = np.zeros(-(-n * bits // 64) + 1, dtype=U64)
        if bits:
            offset = np.arange(n, dtype=np.int64) * bits
            part = values & U64((1 << bits) - 1)
            shift = (offset & 63).astype(U64)
            np.bitwise_or.at(low, offset >> 6, part << shift)
            over = (offset & 63) + bits > 64
            np.bitwise_or.at(low, (offset[over] >> 6) + 1, part[over] >> (U64(64) - shift[over]))
        return [np.array([n, bits], dtype=U64), low, words, ones]

    def lows(self, at: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(at), dtype=U64)
        offset = at * self.bits
        shift = (offset & 63).astype(U64)
        word = offset >> 6
        out = self.low[word] >> shift
        over = (offset & 63) + self.bits > 64
        out[over] |= self.low[word[over] + 1] << (U64(64) - shift[over])
        return out & U64((1 << self.bits) - 1)

    def values(self, at: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, at, "right") - 1
        place = word * 64 + within(self.high[word], at - self.ones[word])
        return ((place - at).astype(U64) << U64(self.bits)) | self.lows(at)

    def before(self, h: np.ndarray) -> np.ndarray:
        """How many values have a high part below h."""
        k = np.maximum(h - 1, 0)
        word = np.searchsorted(self.zeros, k, "right") - 1
        place = word * 64 + within(~self.high[word], k - self.zeros[word])
        return np.where(h > 0, place - k, 0)

    def successor(self, x: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Index of the first value >= x at or after start (n if none); x may exceed every value."""
        x = x.astype(U64)
        if not self.n:
            return np.zeros(len(x), dtype=np.int64)
        h = (x >> U64(self.bits)).astype(np.int64)
        last = int(self.high.size * 64 - self.n)  # zeros there are
        beyond = h >= last
        h = np.where(beyond, 0, h)
        at, end = np.maximum(self.before(h), start), self.before(np.minimum(h + 1, last - 1))
        low = x & U64((1 << self.bits) - 1)
        active = np.flatnonzero(at < end)
        while len(active):  # within a bucket, which holds about one value
            active = active[self.lows(at[active]) < low[active]]
            at[active] += 1
            active = active[at[active] < end[active]]
        return np.where(beyond, self.n, at)


class Trie:
    """Contexts, their successors by monotone pointers, and quantised logarithms.

    Levels: the words here; the contexts among them, with the weight of their backoff; for each context the
    successors that follow it, each range made monotone by adding the last value of the range before.
    Values are costs: -log10 in units that the caller chooses, 16 bits each.
    """

    @staticmethod
    def built(words: np.ndarray, contexts: np.ndarray, backoff: np.ndarray, counts: np.ndarray, successors: np.ndarray, cost: np.ndarray) -> bytes:
        """words: sorted ids; contexts: sorted indexes of words; counts: successors of each; successors: indexes of words, sorted within a context."""
        pointers = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        last = np.where(counts > 0, successors[np.maximum(pointers[1:] - 1, 0)] if len(successors) else 0, 0)
        base = np.concatenate([[0], np.cumsum(last)])[:-1]
        values = successors + np.repeat(base, counts)
        arrays = [*Sequence.encoded(words), *Sequence.encoded(contexts), *Sequence.encoded(pointers), *Sequence.encoded(values)]
        return Image.of([*arrays, backoff.astype(np.uint16), cost.astype(np.uint16)])

    def __init__(self, buffer):
        arrays = Image.views(buffer)
        k = Sequence.ARRAYS
        self.words, self.contexts, self.pointers, self.successors = (Sequence(arrays[i * k : i * k + k]) for i in range(4))
        self.backoff, self.cost = arrays[4 * k :]

    @staticmethod
    def found(level: Sequence, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, whether it is there) of each x."""
        at = level.successor(x, np.zeros(len(x), dtype=np.int64))
        there = at < level.n
        there[there] = level.values(at[there]) == x[there].astype(U64)
        return at, there

    def looked_up(self, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cost, seen, backoff) of successor w in context v (ids of words): the backoff is 0 for a context that isn't here."""
        n = len(v)
        cost, seen, backoff = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
        heads, place = np.unique(v, return_inverse=True)
        word, there = self.found(self.words, heads)
        context = np.zeros(len(heads), dtype=np.int64)
        context[there], there[there] = (r := self.found(self.contexts, word[there]))[0], r[1]
        start, end, base = (np.zeros(len(heads), dtype=np.int64) for _ in range(3))
        own = context[there]
        start[there], end[there] = self.pointers.values(own).astype(np.int64), self.pointers.values(own + 1).astype(np.int64)
        after = np.flatnonzero(there & (start > 0))
        base[after] = self.successors.values(start[after] - 1).astype(np.int64)
        bow = np.zeros(len(heads), dtype=np.int64)
        bow[there] = self.backoff[own]
        backoff[:] = bow[place]
        tails, spot = np.unique(w, return_inverse=True)
        relative, known = self.found(self.words, tails)
        ask = np.flatnonzero((end > start)[place] & known[spot])
        at_head = place[ask]
        x = base[at_head] + relative[spot[ask]]
        hit = self.successors.successor(x, start[at_head])
        good = hit < end[at_head]
        good[good] = self.successors.values(hit[good]) == x[good].astype(U64)
        seen[ask[good]] = True
        cost[ask[good]] = self.cost[hit[good]]
        return cost, seen, backoff
