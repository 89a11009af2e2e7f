"""Secret scan: fixed patterns, and a randomness test battery for other tokens; DataFrame functions only.

Tokens of 20 and more characters with a digit and a letter get an encoding (hex, also with dashes or
0x, base32, base36, base62, base64) by their characters; a token of any other mix gets the classes of
letters and the signs that it has. A '=' inside ends a token, so the value of NAME=value is one.

The battery asks whether a token looks random in its encoding: chi-squared uniformity over the
alphabet (with the exact mean and variance for its length), runs above and below the middle, and
serial correlation at lag one; their p-values are combined by the Cauchy rule. A token that the
battery finds uneven (UNEVEN) is no secret.

Random tokens are told from ordinary ones by a test of the other hypothesis, that a token is ordinary:
its pairs of neighbouring characters are as likely as those of the corpus' words, or as those of prose
by the frequencies of letters alone, whichever fits better. Pairs are counted over all texts,
candidate tokens taken out. Within each stratum of lengths a Benjamini-Hochberg threshold, read off a histogram of p-values, rejects
ordinariness at false-discovery rate Q, which so bounds the share of ordinary tokens among those reported.

Defined cases: a null text is empty and has no spans; repeated rows are scanned separately; ids may
be null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents

# The patterns of the base scan and the order of its kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "random"]

TOKEN = r"[A-Za-z0-9+/_-]{20,}(?:=++(?![A-Za-z0-9+/_-]))?"
MIXED = r"(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])"
Q, UNEVEN = 0.01, 1e-3
# How often letters occur in prose, in a thousand, and digits and signs in identifiers. They are the prior of pairs.
LETTERS = {
    "a": 80, "b": 15, "c": 30, "d": 42, "e": 125, "f": 20, "g": 20, "h": 50, "i": 73, "j": 3, "k": 8, "l": 42, "m": 26, "n": 72, "o": 70, "p": 21, "q": 3, "r": 64,
    "s": 66, "t": 86, "u": 31, "v": 12, "w": 19, "x": 3, "y": 16, "z": 4, "0": 10,
}
#: Pairs that the prior counts for, and how much wider than for independent pairs the law of their mean is taken.
PRIOR, WIDER = 5_000, 1.5
SIGN, FOLDED = 30, "".join(LETTERS)
LOWER, UPPER, DIGITS, SIGNS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/_-"
# Dashes and 0x of hex are form; they are left out of the tests.
FORMED = r"^(?:0[xX])?(?:[0-9a-f]+(?:-[0-9a-f]+)*|[0-9A-F]+(?:-[0-9A-F]+)*)$"
ENCODINGS = [  # name, what a token must match, alphabet
    ("hex", r"^[0-9a-f]+$", "0123456789abcdef"),
    ("hex", r"^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", r"^[a-z0-9]+$", LOWER + DIGITS),
    ("base36", r"^[A-Z0-9]+$", UPPER + DIGITS),
    ("base62", r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("base64", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
]


def found(text: Column, pattern: str, kind: int, value: bool = False) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, kind, end, token, value>>, in code points.

    \\G holds each match to where the last one ended, so the gaps before matches are known and the
    search after the last match is linear. The test by rlike spares most texts the second pass.
    """
    walk = F.lit(rf"\G([\s\S]*?)({pattern})")
    # Group 1 is the gap, 2 the match, 3 the value of an assignment.
    parts = F.arrays_zip(
        F.transform(F.regexp_extract_all(text, walk, F.lit(1)), lambda g: F.length(g)).alias("gap"),
        F.regexp_extract_all(text, walk, F.lit(2)).alias("token"),
        F.regexp_extract_all(text, walk, F.lit(3 if value else 2)).alias("value"),
    )
    kinds = "array<struct<start:int,kind:int,end:int,token:string,value:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kinds).alias("spans"))

    def step(state: Column, p: Column) -> Column:
        at = state["at"] + p["gap"]
        end = at + F.length(p["token"])
        one = F.struct(at.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), p["token"].alias("token"), p["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(one)).alias("spans"))

    return F.when(text.rlike(pattern), F.aggregate(parts, start, step)["spans"]).otherwise(F.array().cast(kinds))


def tail(z: Column) -> Column:
    """P(N > z) for the standard normal law (error function by a rational approximation, error below 2e-7)."""
    a = F.abs(z) / F.lit(2.0**0.5)
    t = 1 / (1 + F.lit(0.3275911) * a)
    p = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    upper = p * F.exp(-a * a) / 2
    return F.when(z >= 0, upper).otherwise(1 - upper)


class Pairs:
    """Logarithms of the frequencies of pairs of folded characters (letters, digits as one, others as one), their mean and spread."""

    def __init__(self, counts: dict[str, int]):
        shares = {"": SIGN / 1000} | {c: n / 1000 for c, n in LETTERS.items()}
        side = [*shares]
        n = [PRIOR * shares[a] * shares[b] + counts.get(a + b, 0) for a in side for b in side]
        total = sum(n)
        self.side, self.logs = len(side), [math.log(x / total) for x in n]
        self.mean = sum(x / total * y for x, y in zip(n, self.logs))
        self.spread = math.sqrt(sum(x / total * (y - self.mean) ** 2 for x, y in zip(n, self.logs)))

    @staticmethod
    def folded(text: Column) -> Column:
        return F.translate(F.lower(text), "123456789", "000000000")

    @classmethod
    def of(cls, texts: DataFrame) -> Pairs:
        """Counted over all words of texts (text) but candidate tokens; at most 27 squared counts go to the driver."""
        words = cls.folded(F.regexp_replace("text", TOKEN, " "))
        pairs = texts.select(F.explode(F.regexp_extract_all(words, F.lit(r"(?=([a-z0]{2}))[a-z0]"), F.lit(1))).alias("pair"))
        return cls({r["pair"]: r["count"] for r in pairs.groupBy("pair").count().collect()})

    def z(self, token: Column) -> Column:
        """How far the mean logarithm of a token's pairs is from that of ordinary ones; below 0: less likely pairs."""
        place = F.transform(F.split(self.folded(token), ""), lambda ch: F.instr(F.lit(FOLDED), ch))
        table = F.array(*map(F.lit, self.logs))

        def sums(x: Column) -> Column:
            both = F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: F.element_at(table, a * self.side + b + 1))
            return F.aggregate(both, F.lit(0.0), lambda s, v: s + v - self.mean)

        return F.element_at(F.transform(F.array(place), sums), 1) / (F.sqrt(F.length(token) - F.lit(1.0)) * (self.spread * WIDER))


def tested(tokens: Column, nulls: list[Pairs]) -> Column:
    """Add to each token's struct p, how likely one as uneven is when it is random, and q, how likely one with such pairs is when it is ordinary."""

    def bare(c: Column) -> Column:
        token = F.regexp_replace(c["token"], "=+$", "")
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), F.when(token.rlike(FORMED), F.regexp_replace(token, "^0[xX]|-", "")).otherwise(token).alias("token"), F.greatest(*[n.z(c["token"]) for n in nulls]).alias("z"))

    def coded(c: Column) -> Column:
        has = lambda pattern, letters: F.when(c["token"].rlike(pattern), letters).otherwise("")
        letters = F.concat(has("[A-Z]", UPPER), has("[a-z]", LOWER), F.lit(DIGITS), *[has(rf"\{s}" if s in "+-" else s, s) for s in SIGNS])
        for _, pattern, alphabet in reversed(ENCODINGS):
            letters = F.when(c["token"].rlike(pattern), F.lit(alphabet)).otherwise(letters)
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), c["token"].alias("token"), letters.alias("letters"), c["z"].alias("z"))

    def indexed(c: Column) -> Column:
        x = F.transform(F.split(c["token"], ""), lambda ch: F.instr(c["letters"], ch) - 1)
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), F.length(c["letters"]).cast("double").alias("k"), F.length(c["token"]).cast("double").alias("n"), F.transform(x, lambda v: v.cast("double")).alias("x"), c["z"].alias("z"))

    def summed(c: Column) -> Column:
        x = c["x"]
        mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / c["n"]
        squares = F.aggregate(F.array_distinct(x), F.lit(0.0), lambda s, v: s + F.pow(F.size(F.filter(x, lambda w: w == v)).cast("double"), F.lit(2.0)))
        high = F.transform(x, lambda v: v >= (c["k"] - 1) / 2)
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), c["k"].alias("k"), c["n"].alias("n"), x.alias("x"), mean.alias("mean"), squares.alias("squares"), high.alias("high"), c["z"].alias("z"))

    def moments(c: Column) -> Column:
        x, mean = c["x"], c["mean"]
        pairs = F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: (a - mean) * (b - mean))
        spread = F.aggregate(x, F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean))
        serial = F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)
        changes = F.zip_with(F.slice(c["high"], 1, F.size(x) - 1), F.slice(c["high"], 2, F.size(x) - 1), lambda a, b: F.when(a == b, 0.0).otherwise(1.0))
        runs = F.aggregate(changes, F.lit(1.0), lambda s, v: s + v)
        up = F.size(F.filter(c["high"], lambda h: h)).cast("double")
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), c["k"].alias("k"), c["n"].alias("n"), c["squares"].alias("squares"), spread.alias("spread"), serial.alias("serial"), runs.alias("runs"), up.alias("up"), c["z"].alias("z"))

    def scored(c: Column) -> Column:
        n, k, up = c["n"], c["k"], c["up"]
        chi = k / n * c["squares"] - n
        z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        both = 2 * up * (n - up)
        var = F.greatest(both * (both - n) / (n * n * (n - 1)), F.lit(1e-9))
        z_runs = F.when(up * (n - up) > 0, (c["runs"] - (both / n + 1)) / F.sqrt(var)).otherwise(F.sqrt(n))
        z_serial = F.when(c["spread"] > 0, (c["serial"] / c["spread"] + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
        ps = [tail(z_chi), 2 * tail(F.abs(z_runs)), 2 * tail(F.abs(z_serial))]
        clip = [F.least(F.greatest(p, F.lit(1e-15)), F.lit(1 - 1e-6)) for p in ps]
        cauchy = sum((F.tan((0.5 - p) * F.lit(3.141592653589793)) for p in clip[1:]), F.tan((0.5 - clip[0]) * F.lit(3.141592653589793))) / 3
        p = F.greatest(0.5 - F.atan(cauchy) / F.lit(3.141592653589793), F.lit(1e-15))
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), n.cast("int").alias("n"), p.alias("p"), F.greatest(tail(-c["z"]), F.lit(1e-15)).alias("q"))

    encoded = F.transform(F.transform(tokens, bare), coded)
    return F.transform(F.transform(F.transform(F.transform(encoded, indexed), summed), moments), scored)


def stratum(n: Column) -> Column:
    """Lengths 20 to 31, 32 to 63, 64 to 127, and longer."""
    return F.least(F.floor(F.log2(n.cast("double"))), F.lit(7)).cast("int")


def thresholds(tokens: DataFrame, q: float) -> dict[int, float]:
    """Per stratum the largest q that Benjamini and Hochberg's rule rejects, from a histogram of 1,500 bins at most."""
    bins = tokens.groupBy(stratum(F.col("n")).alias("s"), F.floor(-F.log10("q") * 100).cast("int").alias("bin")).count().collect()
    out: dict[int, float] = {}
    for s in {r["s"] for r in bins}:
        mine = sorted(((r["bin"], r["count"]) for r in bins if r["s"] == s), reverse=True)
        total, below, limit = sum(n for _, n in mine), 0, 0.0
        for b, n in mine:
            below += n
            top = 10 ** (-b / 100)
            if top * total / below <= q:
                limit = top
        out[s] = limit
    return out


def scan(df: DataFrame, q: float = Q) -> DataFrame:
    """doc_id, base and random: arrays of struct<start, kind, end> for every row of df (doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    assign = F.filter(found(text, ASSIGN, 0, True), lambda s: F.length(s["value"]) >= 8)
    base = F.array_sort(F.transform(F.concat(assign, found(text, ACCESS, 1), found(text, HEX, 2)), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    tokens = F.when(text.rlike(MIXED + TOKEN), F.filter(found(text, TOKEN, 3), lambda s: s["token"].rlike("[0-9]") & s["token"].rlike("[A-Za-z]"))).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,token:string,value:string>>"))
    narrow = cut(df.select(F.col("doc_id").cast("long").alias("doc_id"), base.alias("base"), tested(tokens, [Pairs.of(df.select("text")), Pairs({})]).alias("tested")))
    limits = thresholds(narrow.select(F.explode("tested").alias("t")).select("t.*"), q)

    def random(c: Column) -> Column:
        rare = F.lit(False)
        for s, limit in limits.items():
            rare = rare | ((stratum(c["n"]) == s) & (c["q"] <= limit))
        return rare & (c["p"] > UNEVEN) & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    extra = F.transform(F.filter("tested", random), lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    return narrow.select("doc_id", "base", extra.alias("random"))


def written(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")


def op9_secret_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = scan(documents(spark, sf_dir))
    kinds = F.transform("base", lambda s: s["kind"])
    n = [F.size(F.array_remove(F.transform(kinds, lambda k: F.when(k == i, 1).otherwise(0)), 0)).cast("long").alias(f"n_{KINDS[i]}") for i in range(3)]
    return spans.select("doc_id", *n, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.array_sort(F.concat("base", "random"))).alias("spans"))


QUERIES = {"op9_secret_randomness": op9_secret_randomness}
SQL: dict[str, str] = {}
