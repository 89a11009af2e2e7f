"""BPE encoding and decoding with a public tokenizer file.

A word is a doubly linked list of symbols. A heap holds mergeable neighbours by merge rank and
position; an entry whose symbols have changed since it was pushed is stale and skipped. Decoding
concatenates vocabulary strings.

Defined cases: a null text counts as empty; an empty text has no ids and decodes to ''. Repeated
rows are encoded separately; null ids stay null, also beside ids of any size; null ids of symbols decode
to ''. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import by_number, carried, documents

#: Entries at most of a worker's two tables, of chunks of text and of words within chunks: about 210 bytes each, or twice that
#: for chunks whose strings are kept too, so 120 MB at most in all.
CACHE_CHUNKS, CACHE_PACKED, CACHE_WORDS = 100_000, 250_000, 300_000
#: Slots that note by hash which words have been met once; only words met again enter a table.
SEEN_SLOTS = 1 << 22
#: A full table is emptied after so many misses for each entry, so that it follows the text.
STALE = 40
#: Places in a word of usual length; a longer word takes its own length.
WIDE = 1024
CONTROL = re.compile("[\x1c-\x1f]")
BLANKS = re.compile("[^\\S\x1c-\x1f]+")
#: Text of these alone has one normal form and one-to-one lower case in every Unicode version.
LATIN = re.compile("[\x00-\xff]+")
#: Signs that are a word of their own after letters at the end of a chunk.
STOPS = frozenset(".,;:!?)")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Recent(dict):
    """word -> make(word), kept from the second time on, for ``size`` words at most."""

    def __init__(self, make, size: int):
        self.make, self.size, self.seen, self.missed = make, size, bytearray(SEEN_SLOTS), 0

    def __missing__(self, word: str):
        value = self.make(word)
        if len(self) < self.size:
            slot = hash(word) & (SEEN_SLOTS - 1)
            if self.seen[slot] and len(word) <= 100:
                self[word] = value
            self.seen[slot] = 1
        else:
            self.missed += 1
            if self.missed > STALE * self.size:
                self.clear()
                self.seen, self.missed = bytearray(SEEN_SLOTS), 0
        return value


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def unpacked(data: bytes) -> list[int]:
    return array("I", data).tolist()


class Bpe:
    """The model part of a tokenizer file: vocabulary and merges."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        data = json.loads(spec)
        model = data["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self.lefts, self.rights = [self.vocab[a] for a, _ in pairs], [self.vocab[b] for _, b in pairs]
        self.becomes = [self.vocab[a + b] for a, b in pairs]
        #: left id -> right id -> rank; ids that are never on the left share one empty table
        none: dict[int, int] = {}
        self.merges = [none] * (max(self.vocab.values()) + 1)
        for rank, (a, b) in enumerate(zip(self.lefts, self.rights)):
            if self.merges[a] is none:
                self.merges[a] = {}
            self.merges[a][b] = rank
        self.joined = "" if data.get("decoder") else " "  # without a decoder the library joins by blanks
        self.specials = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        # Unicode tables (case, letters) are the library's, so its model stays empty; the merging below is ours.
        library = Tokenizer.from_str(json.dumps(data | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": [], "post_processor": None}))
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        # Byte-level alphabet: printable bytes stand for themselves, the others for 256 and up, in order.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
        # The library's own split pattern, when the file has the form that we know; else every chunk goes to the library.
        steps = data["pre_tokenizer"].get("pretokenizers", [])
        known = [x["type"] for x in steps] == ["Split", "ByteLevel"] and [x["type"] for x in data["normalizer"].get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"]) if known else None
        self.words = Recent(self._coded, CACHE_WORDS)

    def word(self, word: str) -> list[int]:
        """Ids of one pre-token. A heap entry is rank * WIDE + place; the rank names the pair and what it becomes."""
        vocab, merges, lefts, rights, becomes = self.vocab, self.merges, self.lefts, self.rights, self.becomes
        symbols = [*map(vocab.__getitem__, word[:-1]), vocab[word[-1] + self.suffix]]
        n = len(symbols)
        wide = WIDE if n < WIDE else n
        heap = []
        left = symbols[0]
        for i in range(1, n):
            right = symbols[i]
            if right in (ranks := merges[left]):
                heap.append(ranks[right] * wide + i - 1)
            left = right
        if not heap:
            return symbols
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heapify(heap)
        while heap:
            rank, i = divmod(heappop(heap), wide)
            j = after[i]
            if symbols[i] != lefts[rank] or j < 0 or symbols[j] != rights[rank]:
                continue  # stale: one of both has been merged meanwhile
            symbols[i] = merged = becomes[rank]
            n -= 1
            if n == 1:
                return [merged]  # whatever else is in the heap is stale
            symbols[j] = -1
            k = after[i] = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if (rank := merges[merged].get(symbols[k], -1)) >= 0:
                    heappush(heap, rank * wide + i)
            if (k := before[i]) >= 0 and (rank := merges[symbols[k]].get(merged, -1)) >= 0:
                heappush(heap, rank * wide + k)
        return [s for s in symbols if s >= 0]

    def _coded(self, w: str) -> bytes:
        return packed(self.word(w if w.isascii() and w.isprintable() else "".join(map(self.letters.__getitem__, w.encode()))))

    def chunk(self, text: str) -> bytes:
        """Packed ids of text without white space and special tokens. White space never lies within a pre-token."""
        if self.pattern is None or not (text.isascii() or LATIN.fullmatch(text)):
            return packed(list(chain.from_iterable(self.word(w) for w, _ in self.split(self.normalise(text)))))
        text = text.lower()
        if text.isalpha():
            return self.words[text]
        if (word := text[:-1]).isalpha() and text[-1] in STOPS:  # the usual form of a chunk with two words
            return self.words[word] + self.words[text[-1]]
        return b"".join(map(self.words.__getitem__, self.pattern.findall(text)))

    def chunks(self, text: str | None) -> Iterator[tuple[str, bool]]:
        """The white-space-free chunks of a text, and whether each is a special token."""
        if not text:
            return
        for k, part in enumerate(self.specials.split(text) if self.specials and "<|" in text else (text,)):
            if k % 2:
                yield part, True
            else:
                for c in BLANKS.split(part) if CONTROL.search(part) else part.split():
                    if c:
                        yield c, False

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable([self.special[c]] if special else unpacked(self.chunk(c)) for c, special in self.chunks(text)))

    @cached_property
    def strings(self) -> dict[int, str]:
        return {i: s for s, i in (self.vocab | self.special).items()}

    def decode(self, ids: list[int]) -> str:
        return self.joined.join(map(self.strings.__getitem__, ids))


class Cache(Recent):
    """chunk -> what made(packed ids of the chunk) gives."""

    def __init__(self, bpe: Bpe, made):
        super().__init__((lambda chunk: made(bpe.chunk(chunk))) if made else bpe.chunk, CACHE_CHUNKS if made else CACHE_PACKED)
        self.bpe, self.made = bpe, made or (lambda data: data)

    def each(self, text: str | None):
        """Of each chunk of text, in order."""
        if not text or (self.bpe.specials and "<|" in text) or CONTROL.search(text):
            return [self.made(packed([self.bpe.special[c]])) if special else self[c] for c, special in self.bpe.chunks(text)]
        return map(self.__getitem__, text.split())


_loaded: dict[int, Bpe] = {}
_caches: dict[tuple[int, str], Cache] = {}


def loaded(spec: str) -> Bpe:
    """One Bpe per worker; that of another file goes."""
    key = hash(spec)
    if key not in _loaded:
        _loaded.clear()
        _caches.clear()
        _loaded[key] = Bpe(spec)
    return _loaded[key]


def cached(spec: str, kind: str) -> Cache:
    """One table of chunks per worker; it outlives the task, but not the first use for another kind of value."""
    key = hash(spec), kind
    if key not in _caches:
        _caches.clear()
        bpe = loaded(spec)
        made = {"ids": unpacked, "packed": None, "strings": lambda data: (len(ids := unpacked(data)), " ".join(map(str, ids)), bpe.decode(ids))}[kind]
        _caches[key] = Cache(bpe, made)
    return _caches[key]


def shared(spark: SparkSession, path: str | None):
    """The tokenizer file (under 2 MB) is read on the driver, so that executors need no local copy."""
    with open(path or tokenizer_path(), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids: array<int>. The general form; one row per row of df (doc_id, text)."""
    spec = shared(df.sparkSession, path)

    def run(batches):
        ids = cached(spec.value, "ids")
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "ids": [list(chain.from_iterable(ids.each(t))) for t in pdf.text]})

    return by_number(carried(df, "text").mapInPandas(run, "doc_id string, ids array<int>"))


def decode(df: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text: the vocabulary strings of df (doc_id, ids), concatenated."""
    spec = shared(df.sparkSession, path)

    def run(batches):
        bpe = loaded(spec.value)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "text": [bpe.decode([] if i is None else list(i)) for i in pdf.ids]})

    return by_number(carried(df, "ids").mapInPandas(run, "doc_id string, text string"))


def round_trip(df: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of ids and of decoded texts, made in one pass so that no id list leaves its task."""
    spec = shared(df.sparkSession, path)

    def run(batches):
        bpe = loaded(spec.value)
        both = cached(spec.value, "strings")
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf.doc_id, pdf.text):
                got = [x for x in both.each(text) if x[0]]
                n, ids, strings = zip(*got) if got else ((), (), ())
                rows.append((doc_id, sum(n), hashlib.sha256(" ".join(ids).encode()).hexdigest(), hashlib.sha256(bpe.joined.join(strings).encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return by_number(carried(df, "text").mapInPandas(run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"))


def windows(df: DataFrame, size: int, end_id: int, path: str | None = None) -> DataFrame:
    """Cut each document's ids, closed by end_id, at every ``size``: doc_id, start, length, ids_crc32, doc_tokens."""
    spec = shared(df.sparkSession, path)
    end = packed([end_id])

    def run(batches):
        chunks = cached(spec.value, "packed")
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf.doc_id, pdf.text):
                data = b"".join(chunks.each(text)) + end
                n = len(data) // 4
                for at in range(0, n, size):
                    piece = data[4 * at : 4 * (at + size)]
                    rows.append((doc_id, at, len(piece) // 4, zlib.crc32(piece), n))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return by_number(carried(df, "text").mapInPandas(run, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))


QUERIES = {"op3_bpe_round_trip": op3_bpe_round_trip}
SQL: dict[str, str] = {}
