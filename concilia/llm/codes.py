"""Product codes of vectors, with codebooks trained by delta-maintained Lloyd rounds on integers.

A vector's components become floor(1024 x) and are cut into four parts; each part position has a
codebook of at most 256 entries, which starts as the parts of the smallest ids. A table of rows with
their last assignment is kept between rounds, and so are the running integer sums and counts of
each entry. A round assigns every part again where its rows are, and shuffles only what changed: for
a part that moved, minus its components at the old entry and plus at the new one, added up within a
task first. Integers make the sums exact, whatever the order; a round's sums are those of a full
recount. The codebooks (4 x 256 entries) are all that tasks and driver share.

Distances are taken by a product of matrices where every number in it is exact in double precision,
and by Python integers elsewhere, so the nearest entry is the true one and ties go to the lower index.

Defined cases: vectors that are null or hold null or non-finite components are dropped; shorter ones
count as padded with zeros to the longest length, itself rounded up to a multiple of four; an id that
is null counts as the largest, rows of one id stand in the order of their components; components beyond
2^62 count as that; an error that no long holds is null; fewer than 256 vectors make shorter codebooks;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
MOST, LONG = 2**62, 2**63 - 1  # an error above LONG is kept as 10^27 at most, so that sums of a label fit a decimal
EXACT = 2.0**52
STATE = "vec_id string, label string, v binary, old binary, new binary, error string"


def integers(vector, width: int) -> list[int]:
    """floor(1024 x) of each component, exactly, padded to width."""
    out = [max(-MOST, min(MOST, math.floor(math.ldexp(float(x), 10)) if abs(x) < 1e300 else (MOST if x > 0 else -MOST))) for x in vector]
    return out + [0] * (width - len(out))


def whole(vectors: list, width: int) -> np.ndarray:
    """The same for many vectors: int64 of shape (n, width)."""
    if all(len(v) == width for v in vectors):
        x = np.array(vectors, dtype=np.float64).reshape(len(vectors), width)
        if not len(x) or np.abs(x).max(initial=0) < 2**50:
            return np.floor(x * SCALE).astype(np.int64)
    return np.array([integers(v, width) for v in vectors], dtype=np.int64).reshape(len(vectors), width)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(index of the nearest entry, the lowest of equals; squared distance) of each row of x; both int64."""
    n, d = x.shape
    biggest = lambda a: float(max(np.abs(a).max(initial=0), 1))
    if 4.0 * d * max(biggest(x), biggest(book)) ** 2 < EXACT:
        xf, b = x.astype(np.float64), book.astype(np.float64)
        score = (b * b).sum(1) - 2.0 * (xf @ b.T)
        at = score.argmin(1)
        return at, (score[np.arange(n), at] + (xf * xf).sum(1)).astype(np.int64).tolist()
    entries = [[int(c) for c in row] for row in book]
    at, error = np.zeros(n, dtype=np.int64), [0] * n
    for k, row in enumerate(x.tolist()):
        error[k], at[k] = min((sum((a - c) ** 2 for a, c in zip(row, entry)), i) for i, entry in enumerate(entries))
    return at, error


def packed(x: np.ndarray) -> list[bytes]:
    """Rows as bytes, each in the narrowest integers that hold it; their length tells which."""
    out = []
    for kind, most in ((np.int16, 2**15), (np.int32, 2**31)):
        if len(x) and np.abs(x).max(initial=0) < most:
            return [r.tobytes() for r in x.astype(kind)]
    for row in x:
        out.append(row.tobytes())
    return out


def unpacked(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    sizes = np.array([len(r) for r in rows])
    for size in np.unique(sizes) if width else ():
        at = np.flatnonzero(sizes == size)
        out[at] = np.frombuffer(b"".join(rows[k] for k in at), dtype=f"<i{size // width}").reshape(len(at), width)
    return out


def assigned(state: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """The state after one assignment to the codebooks: what was new is old."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = unpacked(pdf.v.tolist(), width)
            found = [nearest(part, book) for part, book in zip(np.split(x, PARTS, axis=1), books)]
            codes = np.stack([at for at, _ in found], axis=1).astype(np.uint8)
            error = [str(min(sum(e), 10**27)) for e in zip(*[error for _, error in found])]
            yield pd.DataFrame({"vec_id": pdf.vec_id, "label": pdf.label, "v": pdf.v, "old": pdf.new, "new": [r.tobytes() for r in codes], "error": error})

    return cut(state.mapInPandas(run, STATE))


def deltas(state: DataFrame, width: int) -> DataFrame:
    """part, entry, k, value: what moved parts take from their old entries and add to their new ones, added up; k = -1 counts parts."""
    d = width // PARTS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple[int, int], list[int]] = {}
        for pdf in batches:
            x = unpacked(pdf.v.tolist(), width)
            new = np.frombuffer(b"".join(pdf.new), dtype=np.uint8).reshape(-1, PARTS)
            known = pdf.old.notna().to_numpy()
            old = np.zeros_like(new)
            if known.any():
                old[known] = np.frombuffer(b"".join(pdf.old[known]), dtype=np.uint8).reshape(-1, PARTS)
            for p, part in enumerate(np.split(x, PARTS, axis=1)):
                moved = ~known | (old[:, p] != new[:, p])
                for sign, rows, entries in ((1, moved, new[:, p]), (-1, moved & known, old[:, p])):
                    # int64 sums of one batch stay exact below this bound; beyond it, Python integers.
                    part_ = part if np.abs(part).max(initial=0) < 2**45 else part.astype(object)
                    for e in np.unique(entries[rows]):
                        mine = part_[rows & (entries == e)]
                        was = total.setdefault((p, int(e)), [0] * (d + 1))
                        for k, s in enumerate([len(mine), *(int(s) for s in mine.sum(axis=0))]):
                            was[k] += sign * s
        rows = [(p, e, k - 1, str(s)) for (p, e), sums in total.items() for k, s in enumerate(sums) if s]
        yield pd.DataFrame(rows, columns=["part", "entry", "k", "value"])

    moved = state.where("old is null or old != new").select("v", "old", "new").mapInPandas(run, "part int, entry int, k int, value string")
    return moved.groupBy("part", "entry", "k").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))


def trained(state: DataFrame, first: list[np.ndarray], width: int, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(state after the last assignment, codebooks) from the first codebooks."""
    d = width // PARTS
    books = [b.copy() for b in first]
    sums = [[[0] * (d + 1) for _ in b] for b in books]
    for _ in range(rounds):
        state = assigned(state, books, width)
        for r in deltas(state, width).collect():  # at most 4 x 256 x (d + 1) numbers
            sums[r.part][r.entry][r.k + 1] += int(r.value)
        for book, of in zip(books, sums):
            for e, (count, *total) in enumerate(of):
                if count:
                    book[e] = [s // count for s in total]
    return assigned(state, books, width), books


def by_label(rows: DataFrame, most: int = 1_000) -> DataFrame:
    """rows with label_error, the error summed over their label. Labels of more than a thousandth of all rows are fewer than a thousand and are broadcast; the others meet in a shuffle."""
    fits = F.when(F.sum("exact") <= LONG, F.sum("exact")).cast("long")
    sums = cut(rows.groupBy("label").agg(fits.alias("label_error"), F.count("*").alias("_n")))
    total = sums.agg(F.sum("_n")).first()[0] or 0
    hot = F.col("_n") * most > total
    found = rows.join(F.broadcast(sums.where(hot).select(F.col("label").alias("_l"), "label_error", F.lit(True).alias("_hot"))), F.col("label").eqNullSafe(F.col("_l")), "left")
    cold = found.where("_hot is null").drop("_l", "_hot", "label_error").join(sums.where(~hot).select(F.col("label").alias("_l"), "label_error"), F.col("label").eqNullSafe(F.col("_l")))
    return found.where("_hot").drop("_hot").unionByName(cold.select(found.drop("_hot").columns)).drop("_l")


def coded(df: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error, exact of each kept row; the codebooks of the four part positions) of df (vec_id, embedding, label)."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding").where(F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    zeros = F.array_repeat(F.lit(0.0), F.lit(width) - F.size("embedding"))
    order = [F.col("vec_id").asc_nulls_last(), F.concat(F.col("embedding").cast("array<double>"), zeros)]
    seeds = whole([list(r.embedding) for r in rows.select("vec_id", "embedding").orderBy(*order).limit(ENTRIES).collect()], width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"vec_id": pdf.vec_id, "label": pdf.label, "v": packed(whole(pdf.embedding.tolist(), width)), "old": None, "new": None, "error": None})

    # Ids travel as text: a long beside a null becomes a double in pandas.
    state = rows.select(F.col("vec_id").cast("string").alias("vec_id"), "label", "embedding").mapInPandas(run, STATE)
    state, books = trained(state, np.split(seeds, PARTS, axis=1), width, rounds)
    exact = F.col("error").cast("decimal(38,0)")
    out = state.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.lower(F.hex("new")).alias("code"), F.when(exact <= LONG, exact).cast("long").alias("error"), exact.alias("exact"))
    return out, books


def digest_of(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(c)) for book in books for entry in book for c in entry).encode()).hexdigest()


def op13_codes_delta_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = coded(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
    return by_label(rows).select("vec_id", "code", "error", "label_error", F.lit(digest_of(books)).alias("codebooks_sha256"))


QUERIES = {"op13_codes_delta_lloyd": op13_codes_delta_lloyd}


def oracle(rounds: int = ROUNDS) -> str:
    """The rounds in DuckDB's SQL, each a full recount, for vectors of one length that is a multiple of four and whose squares are exact in doubles."""
    d = f"(SELECT max(len(v)) // {PARTS} FROM k)"
    sql = (
        "WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings"
        " WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"
        f", parts AS MATERIALIZED (SELECT r, p, v[p * {d} + 1 : (p + 1) * {d}] AS v FROM k, range({PARTS}) t(p))"
        f", book0 AS MATERIALIZED (SELECT p, r - 1 AS e, v AS c FROM parts WHERE r <= {ENTRIES})"
    )
    for n in range(rounds + 1):
        far = "list_dot_product(c::DOUBLE[], c::DOUBLE[]) - 2 * list_dot_product(v::DOUBLE[], c::DOUBLE[]) + list_dot_product(v::DOUBLE[], v::DOUBLE[])"
        sql += f", near{n} AS MATERIALIZED (SELECT r, p, min({{'s': {far}, 'e': e}}) AS b FROM parts JOIN book{n} USING (p) GROUP BY r, p)"
        if n < rounds:
            cells = "SELECT p, b.e AS e, unnest(v) AS x, unnest(range(len(v))) AS i"
            total = f"SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS n FROM ({cells} FROM near{n} JOIN parts USING (r, p)) GROUP BY p, e, i"
            sql += f", book{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, o.c) AS c FROM book{n} o LEFT JOIN (SELECT p, e, list((s - ((s % n + n) % n)) // n ORDER BY i) AS c FROM ({total}) GROUP BY p, e) m USING (p, e))"
    return (
        f"{sql}, coded AS (SELECT r, string_agg(format('{{:02x}}', b.e), '' ORDER BY p) AS code, CAST(sum(b.s) AS BIGINT) AS error FROM near{rounds} GROUP BY r)"
        " SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,"
        f" (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS i FROM book{rounds})) AS codebooks_sha256 FROM k JOIN coded USING (r)"
    )


SQL = {"op13_codes_delta_lloyd": oracle()}
