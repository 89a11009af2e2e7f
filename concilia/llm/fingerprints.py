"""Document fingerprints by invertible Bloom lookup sketches, in DataFrame functions only.

A text is cut into paragraphs by its content alone, by one rule for all scripts and lengths: after line
ends, and after two odd and six even UTF-8 bytes (about every 150 bytes of these tables). So a change moves no cut but
those beside it. Where no such place is met for LONGEST bytes, as in periodic text or in a script of one
lead byte without blanks, a paragraph ends after these, and the next place found brings the cuts
together again.

The digest of each distinct paragraph goes to three cells of a block of a sketch; a cell holds a
count, the xor of its digests and the xor of their checksums. A fingerprint is the sketch of a text,
with as many blocks as its number of paragraphs needs, a power of two; the block of a digest is the
low bits of a hash, so a sketch can be folded to fewer blocks by adding up blocks.

Two fingerprints, the larger one folded, are subtracted cell by cell, equal paragraphs cancel, and
peeling recovers the digests that differ: a cell with one digest left gives it away, it is taken out
of its other cells, and so on. Pairs with a block that can't be peeled are done again with larger
sketches, each time with four times as many blocks. After RETRIES (or where digests collide) the sets
themselves are compared. Likeness is the share of common digests among those of both.

Documents meet their successors by name: ids and hashes alone are sorted in ranges, which gives each
name the one before it, and as much of a text as its edit takes is sent there, a quarter of the other's length at
most. Digests (no texts) are then dealt by row; all sketches and retries stay within those partitions.

Defined cases: a paragraph that comes again in a text counts once; a null text is empty, has no paragraphs, an empty fingerprint, and is wholly like
another empty one; repeated rows stay separate rows, with the same
results (rows equal in doc_id and text are one document in the order); rows of the same doc_id are
ordered by their text's hash; rows without doc_id come first; a single document is its own successor;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, documents, name_of, text_key

SIDE, CELLS = 8, 24  # three parts of SIDE cells
LOAD, RETRIES, ROUNDS = 8, 5, 16
#: Bytes of a paragraph at most; a prime, so that the paragraphs of a periodic text differ.
LONGEST = 251
EVEN, ODD = (f"[{''.join(rf'\x{b:02x}' for b in range(bit, 256, 2))}]" for bit in (0, 1))
#: The rule: a paragraph of a text whose UTF-8 bytes are written as characters 0 to 255.
PARAGRAPH = rf"[\s\S]{{1,{LONGEST}}}?(?:(?<=\n)|(?<={ODD}{{2}}{EVEN}{{6}})|(?![\s\S]))|[\s\S]{{{LONGEST}}}"
#: The same in two steps, without a look back from every byte: MARK, a byte that UTF-8 never has, is put after each BREAK, and then a paragraph is a PIECE.
MARK, BREAK = "\xff", ODD * 2 + EVEN * 6
PIECE = rf"[^\n{MARK}]{{1,{LONGEST - 1}}}+[^{MARK}]?+|\n"
#: Names of documents in a range, about; a range holds no texts.
RANGE_NAMES = 1_000_000


def digests(text: Column) -> Column:
    """Distinct digests of a text's paragraphs."""
    marked = F.regexp_replace(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), BREAK, f"$0{MARK}")
    parts = F.regexp_extract_all(marked, F.lit(PIECE), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def blocks_for(n: Column) -> Column:
    """Blocks of the sketch of n digests: a power of two, at most LOAD digests to a block on average."""
    return F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.lit(1.0), n / F.lit(LOAD))))).cast("int")


def block_of(digest: Column, blocks: Column) -> Column:
    return F.xxhash64(digest, F.lit(3)).bitwiseAND(blocks.cast("long") - 1).cast("int")


def let(value: Column, use) -> Column:
    """use(value) with value computed once: lambda variables are bound, whole expressions are not."""
    return F.element_at(F.transform(F.array(value), use), 1)


def places(digest: Column) -> Column:
    """The cell of a digest in each of the three parts of a block."""
    mixed = F.xxhash64(digest, F.lit(7))
    return F.array(*[(F.pmod(F.shiftright(mixed, 8 * part), F.lit(SIDE)) + part * SIDE).cast("int") for part in range(3)])


def checksum(digest: Column) -> Column:
    return F.hash(digest, F.lit(11))


def sketched(units: DataFrame, by: list[str]) -> DataFrame:
    """Cells (by, i, c, d, h) of units (by, c: sign, d: digest); signs of two versions subtract. Rows of a cell are summed where they are."""
    cells = units.select(*by, "c", "d", checksum(F.col("d")).alias("h"), F.explode(places(F.col("d"))).alias("i"))
    return cells.groupBy(*by, "i").agg(F.sum("c").cast("int").alias("c"), F.bit_xor("d").alias("d"), F.bit_xor("h").alias("h"))


def cell(i: Column, c: Column, d: Column, h: Column) -> Column:
    return F.struct(i.alias("i"), c.alias("c"), d.alias("d"), h.alias("h"))


def peeled(cells: Column) -> Column:
    """How many digests peeling recovers from a block's cells, array<struct<i, c, d, h>>; null if some stay hidden."""

    def pure(cells: Column) -> Column:
        alone = F.filter(cells, lambda c: (F.abs(c["c"]) == 1) & (checksum(c["d"]) == c["h"]))
        return F.array_distinct(F.transform(alone, lambda c: F.struct(c["c"].alias("c"), c["d"].alias("d"), c["h"].alias("h"), places(c["d"]).alias("p"))))

    def without(c: Column, keys: Column) -> Column:
        mine = F.filter(keys, lambda k: F.array_contains(k["p"], c["i"]))
        return F.aggregate(mine, c, lambda s, k: cell(s["i"], s["c"] - k["c"], s["d"].bitwiseXOR(k["d"]), s["h"].bitwiseXOR(k["h"])))

    def step(state: Column, _: Column) -> Column:
        same = F.struct(state["cells"].alias("cells"), state["n"].alias("n"), F.lit(True).alias("over"))
        return F.when(state["over"], same).otherwise(
            let(pure(state["cells"]), lambda keys: F.when(F.size(keys) == 0, same).otherwise(
                F.struct(F.filter(F.transform(state["cells"], lambda c: without(c, keys)), lambda c: (c["c"] != 0) | (c["d"] != 0)).alias("cells"), (state["n"] + F.size(keys)).alias("n"), F.lit(False).alias("over"))
            ))
        )

    start = F.struct(cells.alias("cells"), F.lit(0).alias("n"), F.lit(False).alias("over"))
    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, step, lambda s: F.when(F.size(s["cells"]) == 0, s["n"]))


def differing(pairs: DataFrame, retries: int = RETRIES) -> DataFrame:
    """(rid, pair, n): how many digests are in one of x and y only, for pairs (rid, pair, x, y), best dealt by rid.

    The first try subtracts the fingerprints of both, folded to the smaller one's blocks.
    """
    left, done = pairs, None
    for level in range(retries):
        blocks = F.least(blocks_for(F.size("x")), blocks_for(F.size("y"))) if level == 0 else blocks_for(F.size("x") + F.size("y")) * 2 * 4 ** (level - 1)
        signed = F.concat(F.transform("x", lambda d: F.struct(F.lit(1).alias("c"), d.alias("d"))), F.transform("y", lambda d: F.struct(F.lit(-1).alias("c"), d.alias("d"))))
        dealt = left if level == 0 else left.repartition("rid")  # all groupings below include rid, so nothing else is shuffled
        units = dealt.select("rid", "pair", blocks.alias("blocks"), F.explode(signed).alias("u")).select("rid", "pair", "u.c", "u.d", block_of(F.col("u.d"), F.col("blocks")).alias("block"))
        cells = sketched(units, ["rid", "pair", "block"]).where("c != 0 or d != 0")
        block = cells.groupBy("rid", "pair", "block").agg(F.collect_list(F.struct("i", "c", "d", "h")).alias("cells")).select("rid", "pair", peeled(F.col("cells")).alias("n"))
        tried = block.groupBy("rid", "pair").agg(F.sum("n").alias("n"), F.max(F.col("n").isNull()).alias("hidden"))
        # Where nothing is left of the cells, nothing differs.
        tried = cut(left.select("rid", "pair").join(tried, ["rid", "pair"], "left").select("rid", "pair", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("hidden", F.lit(False)).alias("hidden")))
        solved = tried.where("not hidden").select("rid", "pair", "n")
        done = solved if done is None else done.union(solved)
        failed = tried.where("hidden").groupBy("rid").agg(F.collect_set("pair").alias("again"))
        if failed.isEmpty():
            return done
        left = cut(left.join(failed, "rid").where(F.array_contains("again", F.col("pair"))).drop("again"))  # by rid, as left is dealt
    rest = left.select("rid", "pair", (F.size(F.array_except("x", "y")) + F.size(F.array_except("y", "x"))).cast("long").alias("n"))
    return done.union(rest)


def fingerprints(sets: DataFrame) -> DataFrame:
    """(rid, which, fingerprint) of sets (rid, which, d: array of digests): the number of blocks, and the cells in use as
    place.count.digests.checksums, in hex but for the count."""
    units = sets.select("rid", "which", F.lit(1).alias("c"), blocks_for(F.size("d")).alias("blocks"), F.explode("d").alias("d"))
    cells = sketched(units.withColumn("block", block_of(F.col("d"), F.col("blocks"))), ["rid", "which", "blocks", "block"])
    place = (F.col("block") * CELLS + F.col("i")).alias("i")
    text = F.concat_ws(".", F.hex(F.col("block") * CELLS + F.col("i")), F.col("c").cast("string"), F.hex("d"), F.lower(F.hex(F.col("h").cast("long").bitwiseAND(0xFFFFFFFF))))
    listed = cells.groupBy("rid", "which", "blocks").agg(F.array_sort(F.collect_list(F.struct(place, text.alias("t")))).alias("all"))
    return listed.select("rid", "which", F.concat_ws("|", F.col("blocks").cast("string"), F.array_join(F.transform("all", lambda x: x["t"]), ",")).alias("fingerprint"))


def before(names: DataFrame) -> DataFrame:
    """name, doc_id, prev, prev_chars: name and n_chars of the name before it in order of (doc_id, key), nulls first; before the first, the last.

    names: distinct (doc_id, key, name, n_chars).
    """
    spark = names.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), names.count() // RANGE_NAMES)
    placed = names.select("doc_id", "key", F.struct("name", "n_chars").alias("own"))
    placed = cut(placed.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "key").withColumn("range", F.spark_partition_id()))
    # One name per range goes to the driver: the last of each is before the first of the next range.
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "key")
    lasts = sorted((r["range"], r["last"]) for r in placed.groupBy("range").agg(F.max_by("own", order).alias("last")).collect())
    table = spark.createDataFrame([(k, lasts[i - 1][1]) for i, (k, _) in enumerate(lasts)], "range int, last struct<name: binary, n_chars: int>")
    within = Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first(), "key")
    return placed.withColumn("prev", F.lag("own").over(within)).join(F.broadcast(table), "range").select("own.name", "doc_id", F.coalesce("prev", "last").alias("prev")).select("name", "doc_id", "prev.name", "prev.n_chars").toDF("name", "doc_id", "prev", "prev_chars")


def with_next(df: DataFrame, part: int | None = None) -> DataFrame:
    """doc_id, text, a (digests), next_text and n (its digests): the next document in order of (doc_id, text's hash); after the last, the first.

    With part, next_text ends after a ``part``-th of text's length, so that no more of it is sent; n is of the whole.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("key", text_key(F.col("text"))).withColumn("name", name_of())
    links = cut(before(rows.select("doc_id", "key", "name", F.length("text").alias("n_chars")).distinct()))
    known = rows.select("text", digests(F.col("text")).alias("a"), "name").join(links, "name")  # the same columns on both sides below: one exchange, read twice
    head = F.col("text") if part is None else F.substring("text", F.lit(1), F.floor(F.col("prev_chars") / part).cast("int"))
    sent = known.dropDuplicates(["name"]).select(F.col("prev").alias("name"), head.alias("next_text"), F.col("a").alias("n"))
    return known.join(sent, "name").select("doc_id", "text", "a", "next_text", "n")


def compare(df: DataFrame) -> DataFrame:
    """The contract's columns for rows of (doc_id, text)."""
    rows = with_next(df, 4).withColumn("n_chars", F.length("text"))
    rows = rows.withColumn("edited", F.concat(F.expr("substring(text, 1, n_chars - cast(floor(n_chars / 4) as int))"), F.expr("substring(next_text, 1, cast(floor(n_chars / 4) as int))")))
    sets = rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "a", digests(F.col("edited")).alias("e"), "n")
    main = cut(sets)  # written once, so rid stays as it is
    pair = lambda k, x, y: F.struct(F.lit(k).alias("pair"), F.col(x).alias("x"), F.col(y).alias("y"))
    dealt = main.select("rid", "a", "e", "n").repartition("rid")
    pairs = dealt.select("rid", F.explode(F.array(pair(0, "a", "e"), pair(1, "a", "n"))).alias("p")).select("rid", "p.*")
    n = differing(pairs.where(F.size("x") + F.size("y") > 0)).groupBy("rid").agg(F.max(F.when(F.col("pair") == 0, F.col("n"))).alias("n0"), F.max(F.when(F.col("pair") == 1, F.col("n"))).alias("n1"))
    own_sets = main.select("rid", "a", "e").repartition("rid").select("rid", F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("a").alias("d")), F.struct(F.lit(1).alias("which"), F.col("e").alias("d")))).alias("s")).select("rid", "s.*")
    prints = fingerprints(own_sets).groupBy("rid").agg(F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("f0"), F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("f1"))

    def like(x: str, y: str, n: str) -> Column:
        both, d = F.col(x) + F.col(y), F.coalesce(n, F.lit(0))
        return F.when(both == 0, 1.0).otherwise((both - d) / (both + d))

    told = main.select("rid", "doc_id", "n_chars", "edited_sha256", *[F.size(x).alias(x) for x in "aen"])  # no sets beyond here
    return told.join(n, "rid", "left").join(prints, "rid", "left").select(
        "doc_id", "n_chars", "edited_sha256", F.coalesce("f0", F.lit("")).alias("fingerprint"), F.coalesce("f1", F.lit("")).alias("edited_fingerprint"),
        like("a", "e", "n0").alias("near_edited"), like("a", "n", "n1").alias("near_next"),
    )


def op5_fingerprint_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(documents(spark, sf_dir))


QUERIES = {"op5_fingerprint_iblt": op5_fingerprint_iblt}
SQL: dict[str, str] = {}
