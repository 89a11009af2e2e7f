"""Merkle dataset manifest: a tree of fan-out 16 over each source's documents, and one over the sources.

Rows are range-partitioned and numbered within their source, so every partition knows the index of its
first leaf. A partition keeps a stack of peaks, one list of at most 15 nodes a level: whenever an aligned
run of 16 is there, it carries into its parent. Completed nodes are records; what stays on the stack at
either edge of a partition is open. Open nodes, some thirty a level and partition however many rows
there are, are merged level by level with their neighbours' in a shuffle by parent; the last run of a
level may be short, and is hashed as it is, without padding. The subroots are leaves of the same
procedure. Proofs come back from the top: a run of nodes takes its parent's path, so each path is
carried once for every 16 leaves.

A digest stands as lowercase hex of SHA-256; a parent hashes its children's digests as text.

Defined cases: a field that is null counts as ``-``; rows without doc_id come first in their source and
are never tampered with; rows with one doc_id follow each other by leaf; a lone leaf is its subroot, a
lone subroot the root, and an empty proof the digest of nothing; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut

FANOUT = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NODES = "tree string, n long, level int, idx long, digest string, open boolean"


def field(x: Column) -> Column:
    text = x.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def leaves(df: DataFrame) -> DataFrame:
    """doc_id, tree (the source; null first in byte order), leaf, and tampered: the leaf with the text's A-Z in lower case, where it differs."""
    row = lambda text: digest(F.concat(*[field(F.col(x)) for x in FIELDS[:-1]], field(text)))
    text = F.col("text")
    chosen = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0) & text.rlike("[A-Z]")
    tree = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0"))
    return df.select("doc_id", tree.alias("tree"), row(text).alias("leaf"), F.when(chosen, row(F.translate(text, UPPER, LOWER))).alias("tampered"))


def indexed(rows: DataFrame, order: list[str], rows_each: int = 200_000) -> DataFrame:
    """rows with _part, idx (gapless from 0 in each tree by ``order``) and n, the size of the tree.

    Equal rows are told apart by a seeded number, so that copies of one row fill more than one partition.
    """
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // rows_each))
    dealt = rows.withColumn("_tie", F.rand(11)).repartitionByRange(parts, "tree", *order, "_tie")
    dealt = cut(dealt.withColumn("_part", F.spark_partition_id()))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("tree", "_part").agg(F.count("*").alias("_n"))
    starts = sizes.select("tree", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(tree).alias("n"))
    place = F.row_number().over(Window.partitionBy("tree", "_part").orderBy(*order, "_tie")) - 1
    out = dealt.withColumn("_place", place).join(starts, ["tree", "_part"]).withColumn("idx", F.col("_start") + F.col("_place"))
    return out.drop("_start", "_place", "_tie")


def peaks(rows: Iterator[tuple[int, str]], start: int) -> Iterator[tuple[int, int, str, bool]]:
    """(level, idx, digest, open) of the nodes over consecutive leaves from index start: completed parents as they carry, then the open edges."""
    stack: list[list[tuple[int, str]]] = [[]]
    for at, leaf in rows:
        level, node = 0, (at, leaf)
        while True:
            if level == len(stack):
                stack.append([])
            peak = stack[level]
            peak.append(node)
            if (node[0] + 1) % FANOUT:
                break
            if len(peak) < FANOUT:  # the run began before this partition
                yield from ((level, i, d, True) for i, d in peak)
                peak.clear()
                break
            if level:
                yield from ((level, i, d, False) for i, d in peak)
            node = node[0] // FANOUT, hashlib.sha256("".join(d for _, d in peak).encode()).hexdigest()
            peak.clear()
            level += 1
    for level, peak in enumerate(stack):
        yield from ((level, i, d, True) for i, d in peak)


def partition_nodes(rows: DataFrame) -> DataFrame:
    """The node records of every (tree, _part) run of indexed rows (tree, n, _part, idx, leaf)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: dict = {"key": None}

        def told(found) -> pd.DataFrame:
            tree, n, _ = state["key"]
            return pd.DataFrame([(tree, n, *x) for x in found], columns=["tree", "n", "level", "idx", "digest", "open"])

        def stream():
            """Consecutive runs of one (tree, _part), across batches."""
            for pdf in batches:
                yield from zip(zip(pdf.tree, pdf.n, pdf["_part"]), pdf.idx, pdf.leaf)

        feed = stream()
        head = next(feed, None)
        while head is not None:
            state["key"], first = head[0], head[1]
            after: list = [None]

            def run_of(head=head, after=after):
                yield head[1], head[2]
                for item in feed:
                    if item[0] != head[0]:
                        after[0] = item
                        return
                    yield item[1], item[2]

            found = []
            for x in peaks(run_of(), first):
                found.append(x)
                if len(found) >= 20_000:
                    yield told(found)
                    found = []
            if found:
                yield told(found)
            head = after[0]

    ordered = rows.select("tree", "n", "_part", "idx", "leaf").repartition("tree", "_part").sortWithinPartitions("tree", "_part", "idx")
    return ordered.mapInPandas(run, NODES)


def width(n: Column, level: int) -> Column:
    """Nodes of a level over n leaves; 0 above the top."""
    w = n
    for _ in range(level):
        w = F.when(w > 1, F.floor((w + FANOUT - 1) / FANOUT)).otherwise(0)
    return w.cast("long")


def depth_of(n: int) -> int:
    """Levels above the leaves of a tree of n."""
    depth = 0
    while n > 1:
        n, depth = -(-n // FANOUT), depth + 1
    return depth


def forest(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Of rows (tree, leaf, ...): the rows with idx and n; the nodes above them (tree, n, level, idx, digest); the tops (tree, level, digest); the levels of the highest tree."""
    numbered = cut(indexed(rows, order))
    depth = depth_of(numbered.agg(F.max("n")).first()[0] or 0)
    found = cut(partition_nodes(numbered))
    nodes, edge = found.where("level > 0").drop("open"), found.where("open and level = 0").drop("open")
    for level in range(depth):
        parent = F.floor(F.col("idx") / FANOUT).alias("idx")
        runs = edge.where(width(F.col("n"), level) > 1).groupBy("tree", "n", parent).agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("c"))
        merged = cut(runs.select("tree", "n", F.lit(level + 1).alias("level"), "idx", digest(F.array_join("c.digest", "")).alias("digest")))
        nodes = nodes.unionByName(merged)
        edge = merged.unionByName(found.where(F.col("open") & (F.col("level") == level + 1)).drop("open"))
    top = F.lit(0)
    for level in range(1, depth + 1):
        top = F.when(width(F.col("n"), level) == 1, level).otherwise(top)
    tops = nodes.where(F.col("level") == top).select("tree", "level", "digest")
    alone = numbered.where("n = 1").select("tree", F.lit(0).alias("level"), F.col("leaf").alias("digest"))
    return numbered, nodes, cut(alone.unionByName(tops)), depth


def pathed(runs: DataFrame, paths: DataFrame, carry: list[str], more: list[str]) -> DataFrame:
    """Each child of a run (tree, idx of the parent, c: its children in order) with its path: {left, right} of its siblings, then the parent's path."""
    both = runs.join(paths, ["tree", "idx"])
    own = both.select("tree", *more, "path", F.array_join("c.digest", "").alias("t"), F.posexplode("c").alias("p", "x"))
    # Digests have 64 characters, so siblings are slices.
    step = F.struct(F.substring(F.col("t"), F.lit(1), F.col("p") * 64).alias("left"), F.substring(F.col("t"), F.col("p") * 64 + 65, F.length("t")).alias("right"))
    return own.select("tree", F.col("x.idx").alias("idx"), *more, *[F.col(f"x.{k}").alias(k) for k in carry], F.concat(F.array(step), F.col("path")).alias("path"))


def with_paths(numbered: DataFrame, nodes: DataFrame, tops: DataFrame, depth: int, above: DataFrame, carry: list[str]) -> DataFrame:
    """The leaves of a forest with their paths to the root; above gives each tree the path of its top, and more columns that all its leaves take (tree, path, ...)."""
    more = [x for x in above.columns if x not in ("tree", "path")]
    at_top = tops.select("tree", F.col("level").alias("top"), F.lit(0).cast("long").alias("idx")).join(above, "tree")
    paths = at_top.where(F.col("top") == depth).drop("top")
    for level in range(depth - 1, -1, -1):
        rows, cells = (nodes.where(F.col("level") == level), ["digest"]) if level else (numbered, [F.col("leaf").alias("digest"), *carry])
        runs = rows.groupBy("tree", F.floor(F.col("idx") / FANOUT).alias("idx")).agg(F.sort_array(F.collect_list(F.struct("idx", *cells))).alias("c"))
        paths = pathed(runs, paths, [] if level else carry, more)
        if level:
            paths = paths.unionByName(at_top.where(F.col("top") == level).drop("top"))
    lone = numbered.where("n = 1").select("tree", "idx", *carry).join(at_top.where("top = 0").select("tree", *more, "path"), "tree")
    return paths.unionByName(lone) if depth else lone


def manifest(df: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row of df."""
    numbered, nodes, tops, depth = forest(leaves(df), ["doc_id", "leaf"])
    sources = tops.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("digest").alias("leaf"))
    of_sources = forest(sources, ["source"])
    root = (of_sources[2].first() or {"digest": None})["digest"]
    end = of_sources[2].select("tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    above = with_paths(*of_sources, end, ["source", "leaf"]).select(F.col("source").alias("tree"), F.col("leaf").alias("subroot"), "path")
    placed = with_paths(numbered, nodes, tops, depth, cut(above), ["doc_id", "leaf", "tampered"])
    proof = digest(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""))
    folded = F.aggregate("path", F.coalesce("tampered", "leaf"), lambda h, s: digest(F.concat(s["left"], h, s["right"])))
    told = placed.select("doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), proof.alias("proof_sha256"), folded.alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS))


QUERIES = {"op11_merkle_manifest": op11_merkle_manifest}


# The same in DuckDB's SQL, level by level over whole tables; a tree of one node passes a level unchanged.


def _levels(name: str, depth: int) -> str:
    """From {name}0 (tree, idx, digest, n): the nodes of each level, and the siblings of each node."""
    out = ""
    for k in range(depth):
        run = f"PARTITION BY tree, idx // {FANOUT} ORDER BY idx ROWS BETWEEN"
        out += (
            f", {name}{k + 1} AS MATERIALIZED (SELECT tree, idx // {FANOUT} AS idx, CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest, CASE WHEN any_value(n) = 1 THEN 1 ELSE (any_value(n) + {FANOUT - 1}) // {FANOUT} END AS n FROM {name}{k} GROUP BY tree, idx // {FANOUT})"
            f", {name}_s{k} AS MATERIALIZED (SELECT tree, idx, n, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"
        )
    return out


def _folds(start: str, name: str, depth: int, tree: str, idx: str) -> tuple[str, str]:
    """(SQL, last name): h and proof of the rows of ``start`` after each level of {name}."""
    out, at = "", start
    for k in range(depth):
        new = f"{name}_f{k}"
        out += f", {new} AS (SELECT f.* EXCLUDE (h, proof), CASE WHEN s.n = 1 THEN h ELSE sha256(s.l || h || s.r) END AS h, proof || s.l || s.r AS proof FROM {at} f JOIN {name}_s{k} s ON f.{tree} = s.tree AND f.{idx} // {FANOUT**k} = s.idx)"
        at = new
    return out, at


def oracle(depth: int = 8, of_sources: int = 6) -> str:
    """SQL for trees of up to 16^depth documents and 16^of_sources sources."""
    put = lambda x: f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || {x} END"
    leaf = lambda text: "sha256(" + " || ".join([*map(put, FIELDS[:-1]), put(text)]) + ")"
    # CRC-32 bit by bit: a byte is taken in, then eight shifts.
    bits = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"
    folds, last = _folds("h0", "t", depth, "tree", "idx")
    more, end = _folds("h1", "r", of_sources, "one", "at")
    return (
        f"WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS tree, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered FROM documents)"
        f", h0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n, coalesce(tampered, leaf) AS h, '' AS proof FROM d)"
        f", t0 AS MATERIALIZED (SELECT tree, idx, leaf AS digest, n FROM h0){_levels('t', depth)}{folds}"
        f", r0 AS MATERIALIZED (SELECT '' AS tree, tree AS source, row_number() OVER (ORDER BY tree) - 1 AS idx, digest, count(*) OVER () AS n FROM t{depth}){_levels('r', of_sources)}"
        f", h1 AS (SELECT f.*, '' AS one, r0.idx AS at, r0.digest AS subroot FROM {last} f JOIN r0 ON f.tree = r0.source){more}"
        f" SELECT doc_id, leaf, subroot, root.digest AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = root.digest AS verified FROM {end} JOIN r{of_sources} root ON root.tree = one"
    )


SQL = {"op11_merkle_manifest": oracle()}
