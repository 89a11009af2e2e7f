"""Language-model scores of documents from an Elias-Fano n-gram trie in shards.

Texts are tokenised once, in batches that carry their own word list. The lists meet in one shuffle by
word, which gives each batch the number and the training count of its words. A batch then sends each
shard the (context, word) pairs that live there: every pair once, with its count in training
documents and the documents where it stands. A shard, which is a hash of the context, adds up the
counts of all batches, builds the trie of the pairs that training documents have (elias_fano.py), looks
up every pair in it and returns costs by document; a batch adds what its shards return. Shards
grow in number with the corpus, not in size; a context with more than a shard's pairs is dealt to
several by its next word. No task, and not the driver, ever holds the model or the vocabulary.

The model: p(w) = (c(w) + 1) / (N + V + 1) as in the base score, and
p(w | v) = (c(v w) + m p(w)) / (c(v) + m), m = MASS c(v)^GROWTH, v being the word before (the end token
at the start). It needs no counts but those of its own pair, so contexts may be dealt by next word.
Logarithms are kept as costs in units of 1/4096, rounded up, so probabilities never add to more than one,
and a document's cost is an integer: the score doesn't depend on how rows are dealt.

Defined cases: a null text is an empty one and has the end token only; rows without doc_id are training
rows; repeated rows are rows of their own; without training rows every token has probability one; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut
from .elias_fano import Trie, mapped

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACE = re.compile(rb"[\x20\x09-\x0D]")
END = b""  # no word is empty
UNIT = 4096
MASS, GROWTH = 4.0, 0.8
#: Bytes of text in a batch, tokens in a shard, words in a bucket of the vocabulary.
BATCH, SHARD, BUCKET = 16 << 20, 1_500_000, 150_000
PIECE = 4 << 20

BATCHES = {"batch": pa.int64(), "ids": pa.list_(pa.string()), "lengths": pa.binary(), "held": pa.binary(), "tokens": pa.binary(), "words": pa.binary(), "uses": pa.binary(), "n_words": pa.int64(), "n_train": pa.int64(), "n_uses": pa.int64()}
WORDS = "bucket long, batch long, words binary, uses binary, types long"
PIECES = "shard long, batch long, kind int, ids array<string>, body binary"


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; pieces end at white space."""
    at = 0
    while len(text) - at > PIECE:
        stop = SPACE.search(text, at + PIECE)
        to = stop.start() if stop else len(text)
        yield text[at:to].translate(LOWER).split()
        at = to
    yield text[at:].translate(LOWER).split()


def packed(*arrays: np.ndarray) -> bytes:
    """Non-negative integers as byte planes of the width that each array needs, deflated."""
    out = [struct.pack("<I", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a, dtype="<u8")
        k = max(1, -(-int(a.max(initial=0)).bit_length() // 8))
        out += [struct.pack("<QB", len(a), k), a.view(np.uint8).reshape(-1, 8)[:, :k].T.tobytes()]
    return zlib.compress(b"".join(out), 1)


def unpacked(body: bytes) -> list[np.ndarray]:
    raw = zlib.decompress(body)
    (count,), at, out = struct.unpack_from("<I", raw), 4, []
    for _ in range(count):
        n, k = struct.unpack_from("<QB", raw, at)
        a = np.zeros((n, 8), dtype=np.uint8)
        a[:, :k] = np.frombuffer(raw, np.uint8, n * k, at + 9).reshape(k, n).T
        out.append(a.view("<i8").ravel())
        at += 9 + n * k
    return out


class Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def joined(words: list[bytes]) -> bytes:
    return zlib.compress(b" ".join(words), 1)


def split(body: bytes) -> list[bytes]:
    return zlib.decompress(body).split(b" ")


def batches(rows: DataFrame) -> DataFrame:
    """rows (doc_id string, text binary, held boolean) in batches: token numbers by a word list of the batch, which stands in the order of a hash, and how often each word is used, in training rows and in all."""
    schema = pa.schema(list(BATCHES.items()))

    def run(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 24, 0
        ids, held, lengths, tokens, size, number = [], [], [], [], 0, Numbers({END: 0})

        def flushed() -> pa.RecordBatch:
            words = sorted(number, key=lambda w: (zlib.crc32(w), w))
            place = np.empty(len(words), dtype=np.int64)
            place[np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))] = np.arange(len(words))
            n, flat = np.array(lengths), place[np.concatenate(tokens)]
            train = np.repeat(~np.array(held, dtype=bool), n)
            uses, own = np.bincount(flat, minlength=len(words)), np.bincount(flat[train], minlength=len(words))
            cells = [task + made, ids, packed(n), np.array(held, dtype=np.uint8).tobytes(), packed(flat), joined(words), packed(own, uses), len(words), int(own.sum()), int(uses.sum())]
            return pa.RecordBatch.from_arrays([pa.array([x], type=t) for x, t in zip(cells, schema.types)], schema=schema)

        for part in arriving:
            for i, text, h in zip(part[0].to_pylist(), part[1], part[2].to_pylist()):
                text = text.as_py() or b""
                n = 0
                for words in words_of(text):
                    tokens.append(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)))
                    n += len(words)
                tokens.append(np.zeros(1, dtype=np.int64))
                ids.append(i)
                held.append(h)
                lengths.append(n + 1)
                size += len(text) + 64
                if size >= BATCH:
                    yield flushed()
                    made += 1
                    ids, held, lengths, tokens, size, number = [], [], [], [], 0, Numbers({END: 0})
        if ids:
            yield flushed()

    kinds = "batch long, ids array<string>, lengths binary, held binary, tokens binary, words binary, uses binary, n_words long, n_train long, n_uses long"
    return cut(rows.select("doc_id", "text", "held").mapInArrow(run, kinds))


def numbered(dealt: DataFrame, buckets: int) -> DataFrame:
    """batch, bucket, body (the numbers, training counts and uses over all batches of the batch's words in that bucket), types (training words of the bucket, on one row of it). One shuffle, by bucket of words."""

    def deal(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arriving:
            for batch, words, uses in zip(*(c.to_pylist() for c in part.columns)):
                words, (own, uses) = split(words), unpacked(uses)
                bucket = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) * buckets >> 32  # rises along the list
                rows = [(int(bucket[a]), batch, joined(words[a:b]), packed(own[a:b], uses[a:b])) for a, b in spans(bucket)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)] + [pa.nulls(len(rows), pa.int64())], names=["bucket", "batch", "words", "uses", "types"])

    def meet(table: pa.Table) -> pa.Table:
        bucket, lists = table["bucket"][0].as_py(), [split(x) for x in table["words"].to_pylist()]
        order = {w: k for k, w in enumerate(sorted(set().union(*lists), key=lambda w: (zlib.crc32(w), w)))}
        at = [np.fromiter(map(order.__getitem__, words), dtype=np.int64, count=len(words)) for words in lists]
        total, used = np.zeros(len(order), dtype=np.int64), np.zeros(len(order), dtype=np.int64)
        for place, body in zip(at, table["uses"].to_pylist()):
            own, uses = unpacked(body)
            total[place] += own
            used[place] += uses
        bodies = [packed(steps(place), total[place], used[place]) for place in at]
        types = [int((total > 0).sum()), *[0] * (len(at) - 1)]
        return pa.table({"batch": table["batch"], "bucket": pa.array([bucket] * len(at), pa.int64()), "body": pa.array(bodies, pa.binary()), "types": pa.array(types, pa.int64())})

    lists = dealt.select("batch", "words", "uses").mapInArrow(deal, WORDS)
    return cut(lists.groupBy("bucket").applyInArrow(meet, "batch long, bucket long, body binary, types long"))


def mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers."""
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shard_of(v: np.ndarray, w: np.ndarray, uses: np.ndarray, shards: int) -> np.ndarray:
    """The shard of pairs (v, w): that of v, or of v and a hash of w where v is used more than a shard holds."""
    salt = mixed(w) % np.maximum(1, -(-uses // SHARD)).astype(np.uint64)
    return (mixed(v.astype(np.uint64) + salt * np.uint64(0x632BE59BD9B4E019)) % np.uint64(shards)).astype(np.int64)


def dealt_pairs(pieces: DataFrame, total: int, types: int, buckets: int, shards: int) -> DataFrame:
    """Of each batch (its record at bucket -1, and its words' numbers by bucket): the base scores (kind 0), and the pairs for each shard (kind 1)."""
    z = total + types + 1

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        record = {k: table[k][0].as_py() for k in ("batch", "ids", "lengths", "held", "body")}
        lists = [(k, *unpacked(body)) for k, body in zip(table["bucket"].to_pylist()[1:], table["body"].to_pylist()[1:])]
        gid = np.concatenate([np.cumsum(at) * buckets + k for k, at, _, _ in lists])
        count, uses = np.concatenate([x[2] for x in lists]), np.concatenate([x[3] for x in lists])
        by_gid = np.argsort(gid)
        rank = np.empty(len(gid), dtype=np.int64)
        rank[by_gid] = np.arange(len(gid))  # by place in the list: order of the word's number
        gid, count, uses = gid[by_gid], count[by_gid], uses[by_gid]
        (lengths,), (flat,) = unpacked(record["lengths"]), unpacked(record["body"])
        w = rank[flat]
        v = np.concatenate([w[-1:], w[:-1]])  # every document ends with the end token, which opens the next
        doc = np.repeat(np.arange(len(lengths)), lengths)
        held = np.frombuffer(record["held"], dtype=np.uint8)
        base = np.bincount(doc, np.log10((count[w] + 1) / z), len(lengths))
        known = np.bincount(doc, count[w] > 0, len(lengths)).astype(np.int64)
        out = [(-1 - record["batch"] % shards, record["batch"], 0, record["ids"], packed(lengths, known, held, base.view(np.int64)))]
        keys, inverse, times = np.unique(v * len(gid) + w, return_inverse=True, return_counts=True)
        kv, kw = keys // len(gid), keys % len(gid)
        train = np.bincount(inverse, (held == 0)[doc], len(keys)).astype(np.int64)
        shard = shard_of(gid[kv], gid[kw], uses[kv], shards)
        order = np.argsort(shard, kind="stable")
        new = np.empty(len(keys), dtype=np.int64)
        new[order] = np.arange(len(keys))
        tokens = np.argsort(new[inverse], kind="stable")
        shard, kv, kw, train, times, doc = shard[order], kv[order], kw[order], train[order], times[order], doc[tokens]
        starts = np.concatenate([[0], np.cumsum(times)])
        for a, b in spans(shard):
            here = np.unique(np.concatenate([kv[a:b], kw[a:b]]))
            first, last = np.searchsorted(here, kv[a:b]), np.searchsorted(here, kw[a:b])
            body = packed(steps(gid[here]), count[here], steps(first), last, train[a:b], times[a:b], doc[starts[a] : starts[b]])
            out.append((int(shard[a]), record["batch"], 1, None, body))
        return rows_of(out)

    return pieces.groupBy("batch").applyInArrow(run, PIECES)


def rows_of(rows: list[tuple]) -> pa.Table:
    kinds = [("shard", pa.int64()), ("batch", pa.int64()), ("kind", pa.int32()), ("ids", pa.list_(pa.string())), ("body", pa.binary())]
    return pa.table([pa.array([r[k] for r in rows], type=t) for k, (_, t) in enumerate(kinds)], schema=pa.schema(kinds))


def spans(x: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of runs of equal values."""
    edges = np.flatnonzero(np.diff(x)) + 1
    return list(zip([0, *edges.tolist()], [*edges.tolist(), len(x)])) if len(x) else []


def steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=0)


def costs(p: np.ndarray) -> np.ndarray:
    """-log10 p in units, rounded up."""
    return np.ceil(-np.log10(p) * UNIT - 1e-9).astype(np.int64)


class Pairs:
    """The pairs of one shard, of all batches together, and their trie."""

    def __init__(self, bodies: list[bytes], total: int, types: int):
        self.parts = [unpacked(b) for b in bodies]
        words, counts = np.concatenate([np.cumsum(p[0]) for p in self.parts]), np.concatenate([p[1] for p in self.parts])
        self.words, first = np.unique(words, return_index=True)
        self.count = counts[first]
        local = [np.searchsorted(self.words, np.cumsum(p[0])) for p in self.parts]
        n = len(self.words)
        keys = np.concatenate([at[np.cumsum(p[2])] * n + at[p[3]] for at, p in zip(local, self.parts)])
        self.keys, self.inverse = np.unique(keys, return_inverse=True)
        self.v, self.w = self.keys // n, self.keys % n
        times = np.bincount(self.inverse, np.concatenate([p[4] for p in self.parts]), len(self.keys))
        self.base = costs((self.count + 1) / (total + types + 1))
        self.image = self.built(times.astype(np.int64), total + types + 1)

    def built(self, times: np.ndarray, z: int) -> bytes:
        count = self.count.astype(np.float64)
        mass = MASS * count**GROWTH
        contexts = np.unique(self.v)
        contexts = contexts[self.count[contexts] > 0]
        seen = times > 0
        v, w = self.v[seen], self.w[seen]
        p = (times[seen] + mass[v] * (count[w] + 1) / z) / (count[v] + mass[v])
        successors = np.bincount(np.searchsorted(contexts, v), minlength=len(contexts))
        backoff = costs(mass[contexts] / (count[contexts] + mass[contexts]))
        return Trie.built(self.words, contexts, backoff, successors, w, np.minimum(costs(p), 65535))

    def cost(self) -> np.ndarray:
        """The cost of every pair, looked up in the trie."""
        seen_cost, seen, backoff = Trie(mapped(self.image)).looked_up(self.words[self.v], self.words[self.w])
        return np.where(seen, seen_cost, backoff + self.base[self.w])

    def by_document(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(documents of the batch, the cost of their pairs here) of each body."""
        cost, at = self.cost(), 0
        for p in self.parts:
            mine = cost[self.inverse[at : at + len(p[3])]]
            at += len(p[3])
            sums = np.bincount(p[6], np.repeat(mine, p[5])).astype(np.int64)
            docs = np.unique(p[6])
            yield docs, sums[docs]


def looked_up(pairs: DataFrame, total: int, types: int) -> DataFrame:
    """The costs by document of each shard and batch (kind 2); the base scores pass."""

    def run(table: pa.Table) -> pa.Table:
        if table["kind"][0].as_py() == 0:
            return table.select(["shard", "batch", "kind", "ids", "body"])
        shard = Pairs(table["body"].to_pylist(), total, types)
        found = zip(table["batch"].to_pylist(), shard.by_document())
        return rows_of([(0, batch, 2, None, packed(steps(docs), sums)) for batch, (docs, sums) in found])

    return pairs.groupBy("shard").applyInArrow(run, PIECES)


def models(pairs: DataFrame, total: int, types: int) -> DataFrame:
    """shard, image: the trie of each shard."""

    def run(table: pa.Table) -> pa.Table:
        shard = Pairs(table["body"].to_pylist(), total, types)
        return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int64()), "image": pa.array([shard.image], pa.binary())})

    return pairs.where("kind = 1").groupBy("shard").applyInArrow(run, "shard long, image binary")


def told(parts: DataFrame, total: int) -> DataFrame:
    """A row for each document of a batch."""
    kinds = "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(table: pa.Table) -> pa.Table:
        kind = table["kind"].to_pylist()
        k = kind.index(0)
        lengths, known, held, base = unpacked(table["body"][k].as_py())
        cost = np.zeros(len(lengths), dtype=np.int64)
        for k2, body in zip(kind, table["body"].to_pylist()):
            if k2 == 2:
                docs, sums = unpacked(body)
                cost[np.cumsum(docs)] += sums
        cells = [pa.array(table["ids"][k].as_py(), pa.string()), pa.array(held == 1), pa.array(lengths), pa.array(known), pa.array(np.full(len(lengths), total)), pa.array(base.view(np.float64) + 0.0), pa.array(-cost / UNIT + 0.0)]
        return pa.table(cells, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return parts.groupBy("batch").applyInArrow(run, kinds)


def pairs_of(df: DataFrame) -> tuple[DataFrame, int, int]:
    """(the pairs of df (doc_id, text, held) by shard, tokens and types of its training rows)."""
    dealt = batches(df)
    words, total, uses = (n or 0 for n in dealt.agg(F.sum("n_words"), F.sum("n_train"), F.sum("n_uses")).first())
    buckets, shards = max(4, -(-words // BUCKET)), max(1, -(-uses // SHARD))
    numbers = numbered(dealt, buckets)
    types = numbers.agg(F.sum("types")).first()[0] or 0
    record = dealt.select("batch", F.lit(-1).cast("long").alias("bucket"), F.col("tokens").alias("body"), "ids", "lengths", "held")
    numbers = numbers.select("batch", "bucket", "body", F.lit(None).cast("array<string>").alias("ids"), *[F.lit(None).cast("binary").alias(x) for x in ("lengths", "held")])
    return dealt_pairs(record.unionByName(numbers), total, types, buckets, shards), total, types


def scored(df: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of df (doc_id, text, held)."""
    id_ = F.col("doc_id").cast("long").cast("string").alias("doc_id")  # a long beside a null would lose its low bits
    rows = df.select(id_, F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.coalesce("held", F.lit(False)).alias("held"))
    pairs, total, types = pairs_of(rows)
    return told(looked_up(pairs, total, types), total).withColumn("doc_id", F.col("doc_id").cast("long"))


def op12_lm_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scored(docs.select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string")) % 7 == 2).alias("held")))


QUERIES = {"op12_lm_trie": op12_lm_trie}
SQL: dict[str, str] = {}
