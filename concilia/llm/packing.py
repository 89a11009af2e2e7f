"""Packing of tokenised documents into training sequences.

A document's ids (closed by an end id) are cut at every full window; the rest of each document is
kept whole. The histogram of lengths (at most ``size`` rows, however large the corpus) goes to the
driver, which enumerates shallow combinations of lengths that fill a window, solves for their
repeat counts by non-negative least squares, rounds them down to what the histogram allows, and
packs the residual counts greedily, largest first, best fit. The plan (patterns, not rows) is
joined back: the i-th piece of a length takes the i-th slot of that length.

Defined cases: null and empty texts are one piece of one id; repeated rows are packed separately;
an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import cut, documents, ranked

SIZE, END = 2048, 1
SLOTS = "length long, lo long, hi long, mult long, first_sequence long, first_offset long"


def combinations(lengths: np.ndarray, size: int) -> list[tuple[int, ...]]:
    """Shallow combinations of present lengths whose sum is the window: two, and three with one of every 64th length or an equal pair."""
    there = set(lengths.tolist())
    found = {tuple(sorted((a, size - a), reverse=True)) for a in there if size - a in there}
    found |= {tuple(sorted((a, a, size - 2 * a), reverse=True)) for a in there if size - 2 * a in there}
    for c in sorted(there)[:: max(1, len(there) // 32)]:
        found |= {tuple(sorted((a, c, size - a - c), reverse=True)) for a in there if size - a - c in there}
    return sorted(found)


def solve(columns: list[tuple[int, ...]], hist: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """min |A x - hist| for x >= 0 by coordinate descent; A[l, k] is how often length l is in column k."""
    x, rest = np.zeros(len(columns)), hist.astype(float).copy()
    sparse = []
    for c in columns:
        at, n = np.unique(c, return_counts=True)
        sparse.append((at, n.astype(float), float(n @ n)))
    for _ in range(sweeps):
        moved = 0.0
        for k, (at, n, norm) in enumerate(sparse):
            step = max(-x[k], float(rest[at] @ n) / norm)
            if step:
                x[k] += step
                rest[at] -= step * n
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def plan(hist: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(repeats, [(length, how often)]) covering each length exactly as often as the histogram says."""
    left = np.zeros(size + 1, dtype=np.int64)
    for length, n in hist.items():
        left[length] = n
    patterns = [(int(left[size]), [(size, 1)])] if left[size] else []
    left[size] = 0
    columns = combinations(np.flatnonzero(left), size)
    weights = solve(columns, left) if columns else np.zeros(0)
    for k in np.argsort(-weights, kind="stable"):
        at, n = np.unique(columns[k], return_counts=True)
        repeats = min(int(weights[k] + 0.5), int((left[at] // n).min()))
        if repeats > 0:
            left[at] -= repeats * n
            patterns.append((repeats, [(int(a), int(m)) for a, m in zip(at, n)]))
    present = np.flatnonzero(left).tolist()
    while present:
        parts: list[tuple[int, int]] = []
        gap, top = size, len(present)
        while gap and (top := bisect_right(present, gap, 0, top)):
            length = present[top - 1]
            often = min(gap // length, int(left[length]))
            parts.append((length, often))
            gap -= often * length
            top -= 1
        repeats = min(int(left[length]) // often for length, often in parts)
        for length, often in parts:
            left[length] -= repeats * often
            if not left[length]:
                present.remove(length)
        patterns.append((repeats, parts))
    return patterns


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, ...]]:
    """Rows of SLOTS: which of the numbered pieces of a length go to which sequences and offsets."""
    rows, used, sequence = [], {}, 0
    for repeats, parts in patterns:
        offset = 0
        for length, often in parts:
            lo = used.get(length, 0)
            used[length] = lo + repeats * often
            rows.append((length, lo, used[length], often, sequence, offset))
            offset += often * length
        sequence += repeats
    return rows


def pack(pieces: DataFrame, size: int = SIZE, id_columns: list[str] | None = None) -> DataFrame:
    """Add sequence_id and offset to pieces with a column length (1 to size)."""
    ids = id_columns or ["doc_id", "start"]
    pieces = cut(pieces)
    hist = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # Bounded: every greedy pattern uses up a length, and columns are bounded by the window.
    table = pieces.sparkSession.createDataFrame(slots(plan(hist, size)), SLOTS)
    items = ranked(pieces, ["length"], ids, "_rank")
    placed = items.join(F.broadcast(table), (items["length"] == table["length"]) & (items["_rank"] >= table["lo"]) & (items["_rank"] < table["hi"]))
    turn = F.col("_rank") - F.col("lo")
    return placed.select(
        *[pieces[c] for c in pieces.columns],
        (F.col("first_sequence") + F.floor(turn / F.col("mult"))).alias("sequence_id"),
        (F.col("first_offset") + (turn % F.col("mult")) * table["length"]).alias("offset"),
    )


def pack_documents(df: DataFrame, size: int = SIZE, end_id: int = END, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(bpe.windows(df, size, end_id, path), size)


def op10_pack_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


QUERIES = {"op10_pack_nnls": op10_pack_nnls}
SQL: dict[str, str] = {}
