"""BPE encoding and decoding by contiguous rank arrays.

A word is held as part boundaries plus the rank of every adjacent pair. The
least rank is found by scanning, its boundary is deleted, and the ranks next
to it are looked up anew, until no pair has a rank. The tokenizer file supplies
the vocabulary, the merges, the special tokens and the text rules; its content
(of fixed size, whatever the data) goes to the tasks with the function.

A null text counts as empty: no ids and an empty decoded text. Special tokens
written out in a text become their ids, as the tokenizers library does without
encode_special_tokens. Repeated rows are encoded one by one; texts of any
length are encoded whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array

import numpy as np
import regex

LONG = 96  # parts from which the scan for the least rank is vectorised
#: White space of the tokenizer's pattern language (fixed values).
SPACE = "\t\n\v\f\r \x85\xa0  -     　"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level files."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class RankBpe:
    """A byte-level BPE tokenizer file with word ends; see the module text."""

    CACHED = 300_000  # chunks, and words, remembered by a task

    def __init__(self, spec: str):
        d = json.loads(spec)
        m = d["model"]
        self.suffix = m.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = m["vocab"]
        self.ranks = {tuple(p.split(" ")) if isinstance(p, str) else tuple(p): i for i, p in enumerate(m["merges"])}
        self.letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.marks = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True))
                                + ")") if self.special else None
        self.heads = {t[0] for t in self.special}  # a text without any of these holds no special token
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
        self.wide = regex.compile(f"[{SPACE}]+")
        self.cache = _Remembered(self.run, self.CACHED)
        self.known = _Remembered(self.word_ids, self.CACHED)

    def merge(self, word: str) -> list[str]:
        """The parts of one word (byte letters) after all merges."""
        text = word
        ends = list(range(1, len(word) + 1))

        def part(k: int) -> str:
            at = ends[k]
            p = text[ends[k - 1] if k else 0:at]
            return p + self.suffix if at == len(text) else p
        none = 1 << 30
        get = self.ranks.get
        rank = [get((part(k), part(k + 1)), none) for k in range(len(ends) - 1)]
        if len(ends) > LONG:
            return self._merge_long(text)
        while rank:
            least = min(rank)
            if least == none:
                break
            k = rank.index(least)
            del ends[k], rank[k]
            if k < len(rank):
                rank[k] = get((part(k), part(k + 1)), none)
            if k:
                rank[k - 1] = get((part(k - 1), part(k)), none)
        return [part(k) for k in range(len(ends))]

    def _merge_long(self, text: str) -> list[str]:
        """The same for long words: ranks in an array that is scanned by numpy
        block by block; deleted boundaries are skipped by links."""
        n, none = len(text), np.int64(1 << 40)
        size = 256
        parts: list[str] = [*text[:-1], text[-1] + self.suffix]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = np.full((n + size - 1) // size * size, none, np.int64)
        get = self.ranks.get
        for k in range(n - 1):
            rank[k] = get((parts[k], parts[k + 1]), none)
        blocks = rank.reshape(-1, size)
        least = blocks.min(axis=1)
        while True:
            b = int(least.argmin())
            if least[b] == none:
                break
            k = b * size + int(blocks[b].argmin())
            j = nxt[k]
            parts[k] += parts[j]
            parts[j] = ""
            rank[j] = none
            nxt[k] = nxt[j]
            if nxt[k] < n:
                prv[nxt[k]] = k
            rank[k] = get((parts[k], parts[nxt[k]]), none) if nxt[k] < n else none
            p = prv[k]
            if p >= 0:
                rank[p] = get((parts[p], parts[k]), none)
            for c in {b, j // size, max(p, 0) // size}:
                least[c] = blocks[c].min()
        return [p for p in parts if p]

    def run(self, chunk: str) -> bytes:
        """Ids (little-endian 32 bits) of text without white space."""
        return b"".join(map(self.known.__getitem__, self.words.findall(chunk)))

    def word_ids(self, word: str) -> bytes:
        """Ids of one word of the pattern."""
        parts = self.merge("".join(map(self.letters.__getitem__, word.encode())))
        return array("I", [self.vocab[p] for p in parts if p in self.vocab]).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if any(h in text for h in self.heads):
            return b"".join(self.special[s].to_bytes(4, "little") if s in self.special else self._plain(s)
                            for s in self.marks.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = self.wide.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ")
            text = text.lower()
            chunks = text.split(" ")
        else:
            # the library's white space has no separators 0x1c-0x1f, so split as bytes do
            chunks = text.lower().encode().split()
            chunks = b"\n".join(chunks).decode().split("\n") if chunks else []
        return b"".join(map(self.cache.__getitem__, chunks))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Remembered(dict):
    """text -> its ids by ``make``, emptied when full; long texts aren't kept."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, text: str) -> bytes:
        ids = self.make(text)
        if len(text) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[text] = ids
        return ids


_OPEN: dict[int, RankBpe] = {}


def opened(spec: str) -> RankBpe:
    """The tokenizer of a file's content, built once in each worker."""
    key = hash(spec)
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = RankBpe(spec)
    return _OPEN[key]


def encoded(docs, path: str, text: str = "text"):
    """``docs`` without its text, plus n_tokens, ids (binary), ids_sha256 and
    decoded_sha256. Columns of these names are replaced."""
    from hashlib import sha256

    from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

    from .common import arrow_map, text_bytes
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    new = [StructField("n_tokens", LongType()), StructField("ids", BinaryType()),
           StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    docs = docs.drop(*(f.name for f in new))
    rest = [f for f in docs.schema.fields if f.name != text]
    schema = StructType(rest + new)

    def run(batch):
        bpe = opened(spec.value)
        cols = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in rest}
        texts = text_bytes(batch, text)
        for lo in range(0, len(texts), 500):
            ids = [bpe.encode(t.decode("utf-8", "surrogatepass")) for t in texts[lo:lo + 500]]
            yield {n: c.slice(lo, 500) for n, c in cols.items()} | {
                "n_tokens": [len(x) // 4 for x in ids], "ids": ids, "ids_sha256": [sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [sha256(bpe.decode(x).encode("utf-8", "surrogatepass")).hexdigest() for x in ids]}
    return arrow_map(docs, run, schema)
