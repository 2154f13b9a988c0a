"""Compact sorted levels of an n-gram trie, in files of parts that tasks map.

The vocabulary is a sorted sequence of distinct 63-bit keys, range-partitioned
into parts (``Level``). A part's file holds a directory (first key and place of
each block) and the blocks, Elias-Fano coded: relative to the block's first
key, packed low bits and high bits in unary.

A level of n-grams (``Grams``) holds, for each n-gram of the level below (its
context), the run of words that follow it. A part's file covers a range of
contexts: Elias-Fano pointers to the runs (monotone; read by select on the high
bits), the words of the runs in 1, 2, 4 or 8 bytes as the vocabulary needs, and one
byte for each word's weight and each context's back-off, which are codes into
256 quantiles of the part. A word is found by successor search inside its
context's run. A context too heavy for one part is split by ranges of words;
its back-off is held beside the directory.

Files are mapped where the path is local. Elsewhere they are read, and a
process keeps at most ``HELD`` bytes of them.
"""

from __future__ import annotations

import json
import struct
from collections import OrderedDict
from dataclasses import dataclass, field

import numpy as np

BLOCK, CODES, HELD, MAPPED = 4096, 256, 1 << 28, 1 << 16


def encode(keys: np.ndarray) -> bytes:
    """One block of sorted distinct keys."""
    d = (keys - keys[0]).astype(np.uint64)
    n = len(d)
    low = max(0, int(d[-1]).bit_length() - n.bit_length())
    high = (d >> np.uint64(low)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(high[-1]) + 1, np.uint8)
    bits[high] = 1
    lows = ((d[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    upper = np.packbits(bits).tobytes()
    return struct.pack("<qIBI", int(keys[0]), n, low, len(upper)) + upper + np.packbits(lows).tobytes()


def decode(raw: np.ndarray) -> np.ndarray:
    """The keys of a block (an array of its bytes)."""
    head = struct.calcsize("<qIBI")
    base, n, low, size = struct.unpack("<qIBI", raw[:head].tobytes())
    keys = np.flatnonzero(np.unpackbits(raw[head:head + size]))[:n] - np.arange(n)
    keys = keys.astype(np.int64) << low
    if low:
        bits = np.unpackbits(raw[head + size:head + size + (n * low + 7) // 8], count=n * low).reshape(n, low)
        padded = np.zeros((n, 64), np.uint8)
        padded[:, :low] = bits
        keys |= np.packbits(padded, axis=1, bitorder="little").view(np.int64)[:, 0]
    return keys + base


def pack(keys: np.ndarray) -> bytes:
    """A part's file: head, directory, blocks."""
    blocks = [encode(keys[i:i + BLOCK]) for i in range(0, len(keys), BLOCK)]
    first = keys[::BLOCK].astype("<i8")
    place = np.cumsum([0] + [len(b) for b in blocks]).astype("<i8")
    head = json.dumps({"n": len(keys), "blocks": len(blocks)}).encode()
    return struct.pack("<I", len(head)) + head + first.tobytes() + place.tobytes() + b"".join(blocks)


class Part:
    """A part's file as an array of bytes."""

    def __init__(self, raw: np.ndarray):
        size = struct.unpack("<I", raw[:4].tobytes())[0]
        head = json.loads(raw[4:4 + size].tobytes())
        at, nb = 4 + size, head["blocks"]
        self.n = head["n"]
        self.first = np.frombuffer(raw[at:at + 8 * nb].tobytes(), "<i8")
        self.place = np.frombuffer(raw[at + 8 * nb:at + 16 * nb + 8].tobytes(), "<i8")
        self.body = raw[at + 16 * nb + 8:]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each of the sorted keys in the part, -1 where absent: the
        first key not smaller is looked for in the key's block."""
        out = np.full(len(keys), -1, np.int64)
        block = np.searchsorted(self.first, keys, side="right") - 1
        for b in np.unique(block[block >= 0]):
            lo, hi = np.searchsorted(block, [b, b + 1])
            have = decode(self.body[self.place[b]:self.place[b + 1]])
            at = np.searchsorted(have, keys[lo:hi])
            hit = at < len(have)
            hit[hit] = have[at[hit]] == keys[lo:hi][hit]
            out[lo:hi][hit] = b * BLOCK + at[hit]
        return out


class Counts:
    """Counts by place in a part: a width in bytes, then the counts."""

    def __init__(self, raw: np.ndarray):
        self.n = raw[1:].view(f"<u{raw[0]}")

    @staticmethod
    def pack(n: np.ndarray) -> bytes:
        width = next(w for w in (1, 2, 4, 8) if int(n.max(initial=0)) < 1 << (8 * w - 1))
        return bytes([width]) + n.astype(f"<u{width}").tobytes()


_held: OrderedDict = OrderedDict()  # open files by kind and path: (object, bytes charged)


def opened(uri: str, kind: type):
    """A file as ``kind``: mapped if the path is local, else read."""
    if (kind, uri) in _held:
        _held.move_to_end((kind, uri))
        return _held[kind, uri][0]
    path = uri.removeprefix("file://").removeprefix("file:")
    if "://" not in path:
        raw, cost = np.asarray(np.memmap(path, np.uint8, "r")), MAPPED
    else:
        from pyarrow import fs
        files, path = fs.FileSystem.from_uri(uri)
        with files.open_input_file(path) as f:
            raw = np.frombuffer(f.read(), np.uint8)
        cost = len(raw)
    _held[kind, uri] = kind(raw), cost
    held = sum(c for _, c in _held.values())
    while held > HELD and len(_held) > 1:
        held -= _held.popitem(last=False)[1][1]
    return _held[kind, uri][0]


def _ranges(part: np.ndarray):
    """(part, lo, hi) for each run of a sorted array."""
    lo = np.flatnonzero(_changes(part))
    return zip(part[lo].tolist(), lo.tolist(), [*lo[1:].tolist(), len(part)])


def _changes(x: np.ndarray) -> np.ndarray:
    """True where a run of equal values starts."""
    out = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


@dataclass
class Level:
    """The parts of the vocabulary, in order: first key, first place and files."""

    first: list[int]
    start: list[int]
    files: list[str]
    size: int
    values: list[str] = field(default_factory=list)  # files of counts

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of sorted distinct keys in the level, -1 where absent."""
        out = np.full(len(keys), -1, np.int64)
        part = np.searchsorted(np.array(self.first, np.int64), keys, side="right") - 1
        for p, lo, hi in _ranges(part):
            if p >= 0:
                at = opened(self.files[p], Part).find(keys[lo:hi])
                out[lo:hi] = np.where(at >= 0, at + self.start[p], -1)
        return out

    def counts(self, places: np.ndarray) -> np.ndarray:
        """Counts at sorted places (0 or more)."""
        out = np.empty(len(places), np.int64)
        for p, lo, hi in _ranges(np.searchsorted(np.array(self.start, np.int64), places, side="right") - 1):
            out[lo:hi] = opened(self.values[p], Counts).n[places[lo:hi] - self.start[p]]
        return out


def _book(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most 256 quantiles of the values, and each value's nearest one."""
    s = np.sort(x)
    book = s[_changes(s)] if len(s) else np.zeros(1)
    if len(book) > CODES:
        book = np.unique(s[np.round(np.linspace(0, len(s) - 1, CODES)).astype(np.int64)])
    if len(book) == 1:
        return book, np.zeros(len(x), np.uint8)
    at = np.clip(np.searchsorted(book, x), 1, len(book) - 1)
    return book, np.where(x - book[at - 1] <= book[at] - x, at - 1, at).astype(np.uint8)


def pack_grams(lo: int, pointers: np.ndarray, words: np.ndarray, weight: np.ndarray, backoff: np.ndarray) -> bytes:
    """A part's file: ``pointers[i]`` to ``pointers[i + 1]`` is the run of
    context ``lo + i`` in ``words`` and ``weight``."""
    m, n = len(backoff), len(words)
    low = max(0, (n // (m + 1)).bit_length() - 1)
    at = (pointers >> low) + np.arange(m + 1)
    bits = np.zeros((int(at[-1]) // 64 + 1) * 64, np.uint8)
    bits[at] = 1
    ones = np.cumsum(bits.reshape(-1, 64).sum(axis=1, dtype=np.uint32), dtype=np.uint32)
    lows = ((pointers[:, None] >> np.arange(low)) & 1).astype(np.uint8)
    width = next(w for w in (1, 2, 4, 8) if int(words.max(initial=0)) < 1 << (8 * w - 1))
    (weights, w), (backoffs, b) = _book(weight), _book(backoff)
    parts = [weights.astype("<f8"), backoffs.astype("<f8"), np.concatenate([[0], ones[:-1]]).astype("<u4"),
             np.packbits(bits, bitorder="little"), np.concatenate([np.packbits(lows, bitorder="little"), np.zeros(8, np.uint8)]),
             words.astype(f"<i{width}"), w, b]
    raw = [p.tobytes() for p in parts]
    head = json.dumps({"lo": lo, "low": low, "width": width, "n": n, "sizes": [len(r) for r in raw]}).encode()
    head += b" " * (-(4 + len(head)) % 8)  # sections start at multiples of 8 bytes
    return struct.pack("<I", len(head)) + head + b"".join(r + bytes(-len(r) % 8) for r in raw)


class GramPart:
    """A part of a level of n-grams as an array of bytes."""

    def __init__(self, raw: np.ndarray):
        size = struct.unpack("<I", raw[:4].tobytes())[0]
        head = json.loads(raw[4:4 + size].tobytes())
        sizes = head["sizes"]
        at = np.cumsum([4 + size, *[x + -x % 8 for x in sizes]]).tolist()
        weights, backoffs, ones, high, self.lows, words, self.w, self.b = (raw[a:a + x] for a, x in zip(at, sizes))
        self.weights, self.backoffs, self.ones = weights.view("<f8"), backoffs.view("<f8"), ones.view("<u4")
        self.high, self.words = high.view("<u8"), words.view(f"<i{head['width']}")
        self.lo, self.low, self.n = head["lo"], head["low"], head["n"]

    def _select(self, i: np.ndarray) -> np.ndarray:
        """The place of the i-th one in the high bits: by the ones before each
        64 bits, then by halves of these."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        rest, bits, at = i - self.ones[word], self.high[word], word * 64
        for half in (32, 16, 8, 4, 2, 1):
            below = np.bitwise_count(bits & np.uint64((1 << half) - 1)).astype(np.int64)
            up = rest >= below
            rest -= below * up
            bits >>= (up * half).astype(np.uint64)
            at += up * half
        return at

    def pointer(self, i: np.ndarray) -> np.ndarray:
        """Element ``i`` of the monotone sequence."""
        high = self._select(i) - i
        if not self.low:
            return high
        bit = i * self.low
        window = np.ascontiguousarray(self.lows[(bit >> 3)[:, None] + np.arange(8)]).view("<i8")[:, 0]
        return (high << self.low) | ((window >> (bit & 7)) & ((1 << self.low) - 1))

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the part (-1: absent) and weight of sorted pairs, and their
        contexts' back-offs: the first word not smaller is looked for inside
        the context's run."""
        fresh = _changes(context)
        each, i = np.cumsum(fresh) - 1, context[fresh] - self.lo
        alone = np.ones(len(i), bool)  # neighbours share a pointer
        alone[:-1] = i[1:] != i[:-1] + 1
        at = np.arange(len(i)) + np.cumsum(alone) - alone
        ends = np.empty(len(i) + int(alone.sum()), np.int64)
        ends[at], ends[at[alone] + 1] = i, i[alone] + 1
        pointers = self.pointer(ends)
        a, end = pointers[at][each], pointers[at + 1][each]
        left = np.arange(len(a))  # still searched: index, bounds, word
        lo, hi, w = a.copy(), end.copy(), word
        while len(left):
            on = lo < hi
            if not on.all():
                a[left[~on]] = lo[~on]
                left, lo, hi, w = left[on], lo[on], hi[on], w[on]
            mid = (lo + hi) >> 1
            less = self.words[mid] < w
            lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
        found = np.flatnonzero(a < end)
        found = found[self.words[a[found]] == word[found]]
        place, weight = np.full(len(a), -1, np.int64), np.full(len(a), -np.inf)
        place[found] = a[found]
        weight[found] = self.weights[self.w[a[found]]]
        return place, weight, self.backoffs[self.b[i]][each]


@dataclass
class Grams:
    """The parts of a level of n-grams, in order. ``lo``: first context;
    ``subs``: by how many parts the part's one context is shared, else 1;
    ``start``: first place; ``files``: None where a part has no n-gram;
    ``hot``: back-offs of the contexts that are shared."""

    lo: np.ndarray
    subs: np.ndarray
    start: np.ndarray
    files: list[str | None]
    size: int
    words: int
    hot: dict[int, float]

    def at(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The part that holds each pair."""
        return part_of(self.lo, self.subs, self.words, context, word)

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places (-1: absent) and weights of sorted pairs, and logarithms of
        their contexts' back-offs (0: no child)."""
        place, weight, left = np.full(len(context), -1, np.int64), np.full(len(context), -np.inf), np.zeros(len(context))
        if self.size:
            for p, lo, hi in _ranges(self.at(context, word)):
                if self.files[p]:
                    got, weight[lo:hi], left[lo:hi] = opened(self.files[p], GramPart).find(context[lo:hi], word[lo:hi])
                    place[lo:hi] = np.where(got >= 0, got + self.start[p], -1)
                if self.subs[p] > 1:
                    left[lo:hi] = self.hot[int(self.lo[p])]
        return place, weight, left


def part_of(lo: np.ndarray, subs: np.ndarray, words: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The part of each pair: by its context, and inside a shared context by
    its word's place among ``words``."""
    last = np.searchsorted(lo, context, side="right") - 1
    s = subs[last]
    return np.where(s > 1, last - (s - 1) + np.minimum(s - 1, word * s // max(1, words)), last)


def cut(n: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First index of runs that hold at most about 2 * ``most`` in sum, and in
    how many parts a run is shared: more than 1 only for a single element
    above ``most``."""
    if not len(n):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    run, hot = (np.cumsum(n) - n) // most, n > most
    edge = np.ones(len(n), bool)
    edge[1:] = (run[1:] != run[:-1]) | hot[1:] | hot[:-1]
    lo = np.flatnonzero(edge)
    return lo, np.where(hot[lo], -(-n[lo] // most), 1)
