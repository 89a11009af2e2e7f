"""Removal of repeated byte strings with suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts anywhere else is removed.

1. Each window of ``length`` bytes has an anchor: its leftmost 32-byte gram of smallest hash. Equal
   windows have equal anchors, at equal places. Windows next to each other that share an anchor form
   a piece; only its digest and place are shuffled. Pieces whose anchor occurs once hold nothing
   that is repeated and are left out; a piece that occurs twice is repeated throughout. Pieces are
   told apart by anchor and digest, 128 bits together.
2. Different pieces with one anchor may share some windows. Their bytes go to shards by anchor. A
   shard sorts its suffixes (Larsson-Sadakane refinement) and finds
   common prefixes of neighbours (Kasai's rule, many stretches of text in step): windows with a
   neighbour that agrees in ``length`` bytes are repeated.
3. An anchor with more than BLOCK different pieces is cut over several shards; each pair of these is
   merged by binary search of the windows of one in the sorted windows of the other.

Defined cases: null and empty texts have no bytes; texts shorter than ``length`` lose none; repeated
rows are documents of their own, so they are copies of each other; rows with the same id and text
share their result; ids may be null; an empty table gives no rows; other columns are kept by
``cleaned``, whatever their names, and ignored by ``judged``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import block_pairs, runs, sharded
from .common import cut, documents, name_of, unused
from .jaccard import words_seen as _words

LENGTH, GRAM = 400, 32
#: About fifty words, for the columns on passages.
PASSAGE = 256
BLOCK, ROWS_EACH = 2000, 1200
MOST_PIECES = 1 << 14
STRETCH = 1 << 22  # window starts handled at once in a very long text


def words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as big-endian numbers (data is padded by eight zeros)."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return np.ndarray((len(data),), dtype=">u8", buffer=padded.tobytes(), strides=(1,)).astype(np.uint64)


def grams(data: np.ndarray) -> np.ndarray:
    """A hash of each 32-byte gram."""
    w = words(data)
    n = len(data) - GRAM + 1
    h = np.zeros(n, dtype=np.uint64)
    for k in range(0, GRAM, 8):
        h = (h ^ w[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sliding_least(x: np.ndarray, size: int) -> np.ndarray:
    span, m = 1, x
    while 2 * span <= size:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    rest = size - span
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def pieces_of(data: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(first window, last window, anchor's hash) of each piece of a text."""
    out = []
    for at in range(0, max(0, len(data) - length + 1), STRETCH):
        part = data[at : at + STRETCH + length - 1]
        h = grams(part)
        place = np.arange(len(h), dtype=np.uint64)
        # 40 bits of hash, then the place, so that the leftmost of equal grams wins.
        least = sliding_least((h & np.uint64(0xFFFFFFFFFF000000)) | place, length - GRAM + 1) & np.uint64(0xFFFFFF)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.concatenate([first[1:], [len(least)]]) - 1
        anchor = h[least[first].astype(np.int64)].astype(np.int64)
        out += zip((first + at).tolist(), (last + at).tolist(), anchor.tolist())
    return out


def order_of(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Which places put pairs in order, each number of ``bits`` bits at most. Sorting one packed number is much faster than argsort."""
    n = len(first)
    own = max(1, (n - 1).bit_length())
    if 2 * bits + own <= 64:
        key = (first.astype(np.uint64) << np.uint64(bits + own)) | (second.astype(np.uint64) << np.uint64(own)) | np.arange(n, dtype=np.uint64)
        key.sort()
        return (key & np.uint64((1 << own) - 1)).astype(np.int32)
    return np.lexsort((second, first)).astype(np.int32)


def suffix_order(data: np.ndarray) -> np.ndarray:
    """The suffixes in order. Kasai's rule needs the full order, so refinement goes on until no group is left.

    Larsson and Sadakane's refinement: suffixes are ranked by five bytes, and then only groups of
    equal rank are sorted again, by the rank of the suffix h bytes on, with h doubled each time.
    """
    w = words(data) >> np.uint64(24)
    n = len(w)
    order = order_of(w >> np.uint64(20), w & np.uint64((1 << 20) - 1), 20)
    new = np.concatenate([[True], w[order][1:] != w[order][:-1]])
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
    h, bits = 5, n.bit_length()
    while h < n + 5:
        again = np.flatnonzero(~(new & np.concatenate([new[1:], [True]]))).astype(np.int32)
        if not len(again):
            break
        at = order[again]
        ahead = at + h
        key = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        own = rank[at]
        by = order_of(own, key, bits)
        at, key, own = at[by], key[by], own[by]
        order[again] = at
        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (key[1:] != key[:-1])])
        new[again] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, again, np.int32(0)))
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int, lanes: int = 16_384) -> np.ndarray:
    """lcp[k]: how many bytes order[k] and order[k + 1] share, up to ``most``.

    Kasai's rule: going through the text, the common prefix of a suffix with its successor in order
    is at most one byte shorter than that of the suffix before it. ``lanes`` stretches of the text
    are gone through in step.
    """
    n = len(data)
    w = words(data)
    after = np.full(n, -1, dtype=np.int64)
    after[order[:-1]] = order[1:]
    steps = -(-n // lanes)
    starts = np.arange(0, n, steps)
    have = np.zeros(len(starts), dtype=np.int64)
    plcp = np.zeros(n, dtype=np.int64)
    for s in range(steps):
        at = starts + s
        lane = np.flatnonzero(at < n)
        at = at[lane]
        other = after[at]
        know = np.where(other >= 0, np.maximum(have[lane] - 1, 0), 0)
        live = np.flatnonzero(other >= 0)
        while len(live):
            a, b = at[live] + know[live], other[live] + know[live]
            inside = np.maximum(a, b) < n
            live, a, b = live[inside], a[inside], b[inside]
            diff = w[a] ^ w[b]
            # Equal leading bytes of the two words, cut at the text's end: the highest bit is the exponent of the number as a double.
            top = ((diff & ~(diff >> np.uint64(1))).astype(np.float64).view(np.int64) >> 52) - 1023
            same = np.where(diff == 0, 8, 7 - (top >> 3))
            same = np.minimum(same, n - np.maximum(a, b))
            know[live] += same
            live = live[(same == 8) & (know[live] < most)]
        have[lane] = know
        plcp[at] = np.minimum(know, most)
    return plcp[order[:-1]]


def less(w: np.ndarray, a: np.ndarray, v: np.ndarray, b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(window a of w < window b of v, equal), compared eight bytes at a time."""
    lower, equal = np.zeros(len(a), dtype=bool), np.ones(len(a), dtype=bool)
    live = np.arange(len(a))
    for k in range(0, length, 8):
        x, y = w[a[live] + k], v[b[live] + k]
        if length - k < 8:
            shift = np.uint64(8 * (8 - (length - k)))
            x, y = x >> shift, y >> shift
        lower[live[x < y]] = True
        equal[live[x != y]] = False
        live = live[x == y]
        if not len(live):
            break
    return lower, equal


class Shard:
    """Pieces in one text, their windows in order, and which of them are repeated."""

    def __init__(self, pieces: list[bytes], length: int):
        self.length = length
        self.data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        n = np.array([len(p) for p in pieces], dtype=np.int64)
        ends = np.cumsum(n)
        self.starts = ends - n
        valid = np.zeros(len(self.data), dtype=bool)
        for a, b in zip(self.starts, ends):
            valid[a : b - length + 1] = True
        order = suffix_order(self.data)
        lcp = common_prefixes(self.data, order, length)
        keep = valid[order]
        self.windows = order[keep]  # in order
        # Between two windows that follow each other, the common prefix is the least one on the way.
        at = np.flatnonzero(keep)
        low = np.concatenate([[0], np.cumsum(lcp < length)])
        self.same = low[at[1:]] == low[at[:-1]] if len(at) > 1 else np.zeros(0, dtype=bool)
        self.repeated = np.zeros(len(self.data), dtype=bool)

    def within(self) -> None:
        self.repeated[self.windows[:-1][self.same]] = True
        self.repeated[self.windows[1:][self.same]] = True

    def merge(self, other: Shard) -> None:
        """Binary search of the other shard's windows in this one's."""
        if not len(self.windows) or not len(other.windows):
            return
        w, v = words(self.data), words(other.data)
        lo, hi = np.zeros(len(other.windows), dtype=np.int64), np.full(len(other.windows), len(self.windows), dtype=np.int64)
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            lower, _ = less(w, self.windows[mid], v, other.windows[open_], self.length)
            lo[open_] = np.where(lower, mid + 1, lo[open_])
            hi[open_] = np.where(lower, hi[open_], mid)
        inside = np.flatnonzero(lo < len(self.windows))
        _, equal = less(w, self.windows[lo[inside]], v, other.windows[inside], self.length)
        self.repeated[self.windows[lo[inside]][equal]] = True
        other.repeated[other.windows[inside][equal]] = True

    def marks(self) -> list[tuple[int, int, int]]:
        """(piece, first, end) of runs of repeated windows, relative to the piece."""
        flags = np.concatenate([[False], self.repeated, [False]])
        # A run never goes from one piece into the next: a piece ends with length - 1 places that start no window.
        first, end = np.flatnonzero(flags[1:] & ~flags[:-1]), np.flatnonzero(~flags[1:] & flags[:-1])
        piece = np.searchsorted(self.starts, first, side="right") - 1
        return list(zip(piece.tolist(), (first - self.starts[piece]).tolist(), (end - self.starts[piece]).tolist()))


PIECE = "anchor long, digest long"


def squeezer(form):
    """A function of a column of bytes, which are shuffled compressed, in their form; null stays null."""

    @F.pandas_udf(T.BinaryType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        squeeze = zstandard.ZstdCompressor().compress
        for data in batches:
            yield pd.Series([None if x is None else squeeze(form(x)) for x in data], dtype=object)
        _words.clear()

    return run


squeezed = squeezer(bytes)


def raw_of(packed: bytes | None) -> bytes:
    return b"" if packed is None else zstandard.decompress(packed)


def located(df: DataFrame, length: int, form=bytes) -> DataFrame:
    """The pieces of each document, in its form, in arrays, MOST_PIECES to a row: name (of its document), anchor, digest, first and last window.

    Arrays take a third of the room that rows would; pieces() makes rows of them.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for name, raw in zip(pdf.name, pdf.data):
                raw = form(raw or b"")
                mine = pieces_of(np.frombuffer(raw, dtype=np.uint8), length)
                for at in range(0, len(mine), MOST_PIECES):
                    first, last, anchor = zip(*mine[at : at + MOST_PIECES])
                    digest = np.array([xxhash.xxh3_64_intdigest(raw[a : b + length]) for a, b in zip(first, last)], dtype=np.uint64).view(np.int64)
                    rows.append((name, np.array(anchor, dtype=np.int64), digest, np.array(first, dtype=np.int32), np.array(last, dtype=np.int32)))
            yield pd.DataFrame(rows, columns=["name", "anchor", "digest", "first", "last"])
        _words.clear()

    return df.select("name", "data").mapInPandas(run, "name binary, anchor array<long>, digest array<long>, first array<int>, last array<int>")


def pieces(every: DataFrame) -> DataFrame:
    """A row for each piece of located()."""
    return every.select("name", F.explode(F.arrays_zip("anchor", "digest", "first", "last")).alias("p")).select("name", "p.*")


def fetched(df: DataFrame, wanted: DataFrame, length: int, form=bytes) -> DataFrame:
    """anchor, digest, piece (bytes) for places wanted (name, anchor, digest, first, last)."""
    places = wanted.groupBy("name").agg(F.collect_list(F.struct("anchor", "digest", "first", "last")).alias("places"))

    def run(batches):
        for pdf in batches:
            rows = []
            for packed, places_ in zip(pdf.packed, pdf.places):
                raw = raw_of(packed)
                rows += [(p["anchor"], p["digest"], raw[p["first"] : p["last"] + length]) for p in places_]
            yield pd.DataFrame(rows, columns=["anchor", "digest", "piece"])

    return df.select("name", squeezer(form)("data").alias("packed")).join(places, "name").select("packed", "places").mapInPandas(run, f"{PIECE}, piece binary")


def sorted_out(units: DataFrame, length: int) -> DataFrame:
    """anchor, digest, a, b: runs of repeated windows of the pieces in each shard."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []

        def tell(shard: Shard, part: pd.DataFrame) -> None:
            anchors, digests = part.anchor.to_numpy(), part.digest.to_numpy()
            out.extend((anchors[p], digests[p], a, b) for p, a, b in shard.marks())

        alone = pdf[pdf.bi == pdf.bj]
        # All anchors that are whole here share suffix arrays of about half a megabyte, which fits caches.
        size = alone.piece.map(len).cumsum().to_numpy()
        alone = alone.assign(_lot=size // 500_000).sort_values("anchor", kind="stable") if len(alone) else alone
        if len(alone):
            ends = alone.groupby("anchor", sort=False)["_lot"].transform("min")
            for _, part in alone.groupby(ends):
                shard = Shard(list(part.piece), length)
                shard.within()
                tell(shard, part)
        pairs = pdf[pdf.bi != pdf.bj].sort_values(["anchor", "bi", "bj", "own"], kind="stable")
        for a, b in runs(pairs[["anchor", "bi", "bj"]].to_numpy()):
            unit = pairs.iloc[a:b]
            left, right = unit[unit.own == unit.bi], unit[unit.own == unit.bj]
            if len(left) and len(right):
                x, y = Shard(list(left.piece), length), Shard(list(right.piece), length)
                x.merge(y)
                tell(x, left)
                tell(y, right)
        return pd.DataFrame(out, columns=["anchor", "digest", "a", "b"]).astype({"anchor": "int64", "digest": "int64", "a": "int32", "b": "int32"})

    return units.groupBy("_shard").applyInPandas(run, f"{PIECE}, a int, b int")


def spans(df: DataFrame, length: int = LENGTH, form=bytes) -> DataFrame:
    """name, spans: array<struct<start, end>> of repeated bytes, for df (name, data); documents without any are left out.

    form gives the bytes to compare from the data, in the worker that reads them: a stage with two Python steps has twice the workers.
    """
    every = cut(located(df, length, form))
    twice = cut(every.select(F.explode("anchor").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    shared_ = cut(pieces(every).join(twice, "anchor", "left_semi"))
    kinds = cut(shared_.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min(F.struct("name", "first", "last")).alias("at")))
    shared = cut(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor"))
    several = cut(kinds.join(shared, "anchor", "left_semi"))
    units = block_pairs(several.select("anchor", "digest"), ["anchor"], "digest", BLOCK)
    units = sharded(cut(units), ["anchor", "bi", "bj"], ROWS_EACH)
    bytes_ = fetched(df, several.select("anchor", "digest", "at.name", "at.first", "at.last"), length, form)
    partly = sorted_out(units.join(bytes_, ["anchor", "digest"]), length)
    wholly = kinds.where("n > 1").select("anchor", "digest", F.lit(0).alias("a"), (F.col("at.last") - F.col("at.first") + 1).alias("b"))
    marks = cut(partly.join(wholly, ["anchor", "digest"], "left_anti").union(wholly))
    found = shared_.join(marks, ["anchor", "digest"]).select("name", F.struct((F.col("first") + F.col("a")).alias("start"), (F.col("first") + F.col("b") - 1 + length).alias("end")).alias("span"))
    # Two rows with one name have the same spans; a set keeps them once.
    return found.groupBy("name").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def merged(spans_) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in spans_ if spans_ is not None else ():
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["end"])
        else:
            out.append([s["start"], s["end"]])
    return [(a, b) for a, b in out]


def without(raw: bytes | str, cuts: list[tuple[int, int]]) -> bytes | str:
    at, kept = 0, []
    for a, b in cuts:
        kept.append(raw[at:a])
        at = b
    return raw[:0].join([*kept, raw[at:]])


def within(held: DataFrame, length: int) -> DataFrame:
    """name, spans like spans(df, length), looked for only in the spans found for a smaller length, in which they all lie.

    held: name, packed, spans.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for name, packed, found_ in zip(pdf.name, pdf.packed, pdf.spans):
                long = [(a, b) for a, b in merged(found_) if b - a >= length]
                raw = raw_of(packed) if long else b""
                rows += [(name + a.to_bytes(4, "big"), raw[a:b]) for a, b in long]
            yield pd.DataFrame(rows, columns=["name", "data"])

    found = spans(cut(held.mapInPandas(run, "name binary, data binary")), length).withColumn("at", F.conv(F.hex(F.substring("name", 17, 4)), 16, 10).cast("int"))
    moved = found.withColumn("moved", F.transform("spans", lambda s: F.struct((s["start"] + F.col("at")).alias("start"), (s["end"] + F.col("at")).alias("end"))))
    return moved.groupBy(F.substring("name", 1, 16).alias("name")).agg(F.array_sort(F.flatten(F.collect_list("moved"))).alias("spans"))


def judged(df: DataFrame, length: int = LENGTH, passage: int = PASSAGE) -> DataFrame:
    """For every row of df (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256 for strings of ``length`` bytes,
    and n_passages, n_passage_bytes, how many maximal runs and bytes are covered by repeated strings of ``passage`` (fewer) bytes.

    Texts are shuffled to find spans and to meet them; those that hold any are written once, and rows of the others get the digest of the whole where they are read.
    """
    if passage >= length:
        raise ValueError("passage must be below length")
    text = F.coalesce("text", F.lit(""))
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), name_of().alias("name"), F.col("text").cast("binary").alias("data"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    texts = rows.select("name", "data")
    low = cut(spans(texts, passage))
    held = cut(texts.select("name", squeezed("data").alias("packed")).join(low, "name"))
    high = within(held, length)

    def run(batches):
        for pdf in batches:
            out = []
            for name, packed, found, some in zip(pdf.name, pdf.packed, pdf.spans, pdf.low):
                cuts, runs_ = merged(found), merged(some)
                kept = hashlib.sha256(without(raw_of(packed), cuts)).hexdigest() if cuts else None
                out.append((name, sum(b - a for a, b in cuts), len(cuts), kept, len(runs_), sum(b - a for a, b in runs_)))
            yield pd.DataFrame(out, columns=["name", "n_removed", "n_spans", "kept", "n_passages", "n_passage_bytes"])

    both = held.withColumnRenamed("spans", "low").join(high, "name", "left").select("name", "packed", "spans", "low")
    # Rows with one name have the same text and spans.
    told = both.mapInPandas(run, "name binary, n_removed long, n_spans long, kept string, n_passages long, n_passage_bytes long").dropDuplicates(["name"])
    number = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    joined = rows.drop("data").join(told, "name", "left")
    return joined.select("doc_id", "n_bytes", number("n_removed"), number("n_spans"), F.coalesce("kept", "whole").alias("kept_sha256"), number("n_passages"), number("n_passage_bytes"))


def whole_characters(raw: bytes, cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole characters."""
    out = []
    for a, b in cuts:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def cleaned(df: DataFrame, length: int = LENGTH, least_words: int | None = None) -> DataFrame:
    """df with repeated passages taken out of its text (null stays null); all other columns as they are.

    Passages have ``length`` bytes and more, or ``least_words`` words and more when that is given: then suffix arrays are
    made of the texts' words.
    """
    name, cuts, packed = (unused(df, c) for c in ("_name", "_spans", "_packed"))
    rows = df.withColumn(name, name_of())
    texts = rows.select(F.col(name).alias("name"), F.col("text").cast("binary").alias("data"))
    found = (spans(texts, length) if least_words is None else spans(texts, WORD * least_words, in_words)).withColumnsRenamed({"name": name, "spans": cuts})

    @F.pandas_udf(T.StringType())
    def kept(packed_: pd.Series, found_: pd.Series) -> pd.Series:
        out = []
        for p, s in zip(packed_, found_):
            raw = raw_of(p)
            if p is None or s is None:
                out.append(None if p is None else raw.decode())
            elif least_words is None:
                out.append(without(raw, whole_characters(raw, merged(s))).decode())
            else:
                text = raw.decode()
                out.append(without(text, word_cuts(text, merged(s), least_words)))
        return pd.Series(out, dtype=object)

    joined = rows.withColumn(packed, squeezed(F.col("text").cast("binary"))).drop("text").join(found, name, "left")
    return joined.withColumn("text", kept(packed, cuts)).select(*df.columns)


# Words are judged without punctuation around them, so a passage is found whatever follows its last word.
CORE = re.compile(r"[^\W_](?:\S*[^\W_])?")
#: Bytes that stand for a word, a part of its hash.
WORD = 4


def in_words(raw: bytes) -> bytes:
    """WORD bytes for each word of a text, so that passages can be counted in words."""
    words_ = CORE.findall(raw.decode())
    return np.fromiter(map(_words.__getitem__, words_), dtype=np.uint64, count=len(words_)).astype("<u4").tobytes()


def word_cuts(text: str, found: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """Places in a text of the passages of n words and more in spans of its words."""
    whole = [(-(-a // WORD), b // WORD) for a, b in found]
    if not any(b - a >= n for a, b in whole):
        return []
    places = [m.span() for m in CORE.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in whole if b - a >= n]


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir))


QUERIES = {"op6_suffix_array_dedup": op6_suffix_array_dedup}
SQL: dict[str, str] = {}
