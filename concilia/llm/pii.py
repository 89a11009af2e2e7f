"""Surrogates for personal data.

Entities (e-mail, phone, IP address of both versions, payment card, social security number, IBAN, access key, person
name) get replacements that depend on a key, the kind and the entity's normal form only, so every
mention in every document gets the same one (coreference). Runs of letters, digits or hex digits go
through a keyed Feistel permutation of strings of their length, which keeps format and length and
gives different entities different surrogates; card and IBAN check digits are made valid again. Names are
made of syllables of the same script, given names with an ending of the same gender. A name is any run
of capitalised words after a title; it is replaced wherever else it stands in the document, and a given
name has the gender that its document tells.

Collisions are looked for over the whole corpus before anything is written: a surrogate must not
equal its entity, another entity, or another entity's surrogate. Entities that lose get the next
attempt, until none is left; such exceptions (rare) are joined to their documents by id.

The key is a secret of the deployment, an argument or the session's setting KEY; without one a key is made
up for the run.

Defined cases: null stays null, empty stays empty; repeated rows are rewritten alike; ids may be null; an
empty table gives no rows; ``rewritten`` keeps all other columns as they are, whatever their names.
"""

from __future__ import annotations

import bisect
import hashlib
import ipaddress
import re
import secrets
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, name_of, unused

#: The key's name in the session's configuration. Whoever has the key can undo surrogates.
KEY = "spark.concilia.pii.key"
MOST_ATTEMPTS = 20

# Titles that announce a name, with the gender they tell.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Lady": "f", "Dr": "", "Prof": "", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f",
    "Mlle": "f", "Señor": "m", "Señora": "f", "Señorita": "f", "Sr": "m", "Sra": "f", "Don": "m", "Doña": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
}
# Syllables and endings of made-up names, by script.
SYLLABLES = {
    "latin": ["ba", "be", "bo", "da", "de", "do", "fa", "fe", "ga", "go", "ka", "ke", "la", "le", "lo", "ma", "me", "mo", "na", "ne", "no", "pa", "ra", "re", "ro", "sa", "se", "so", "ta", "te", "to", "va"],
    "cyrillic": ["ба", "бо", "ва", "во", "га", "го", "да", "до", "за", "ка", "ко", "ла", "ле", "ма", "ми", "на", "не", "па", "по", "ра", "ро", "са", "со", "та"],
    "greek": ["βα", "γα", "δα", "δη", "κα", "κο", "λα", "λε", "μα", "μι", "να", "νι", "πα", "πο", "ρα", "ρι", "σα", "σο", "τα", "τι"],
}
ENDINGS = {"latin": {"f": "lia", "m": "ric", "": "lin"}, "cyrillic": {"f": "лия", "m": "рик", "": "лин"}, "greek": {"f": "λια", "m": "ρης", "": "λιν"}}
SURNAMES = {"latin": "ner", "cyrillic": "нер", "greek": "νερ"}

EMAIL = re.compile(r"[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
IP6 = re.compile(r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![\w:])")
IP = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)")
SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
PHONE = re.compile(r"(?<![\w.+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\w+])\+\d(?:[ .-]?\d){7,14}(?!\d)|(?<![\w.+-])[2-9]\d{2}[2-9]\d{6}(?![\w-]|\.\d)")
CARD = re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])")
IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
SECRET = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{8,})""")
# A word of a name, hyphens and apostrophes within; before it there may be initials and particles.
_LETTER = r"(?:[^\W\d_]|[\u0300-\u036f])"
_FIRST = r"[^\W\d_a-zß-öø-ÿа-яёα-ωά-ώ]"
_WORD = rf"{_FIRST}(?:{_LETTER}|['’](?!s\b)(?={_LETTER})|-(?={_LETTER}))+"
_BEFORE = rf"(?:{_FIRST}(?:\. ?| )|(?:van|von|der|den|ten|ter|de|del|della|di|da|dos|du|la|le|zu|bin|ibn) )"
_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
WORD = re.compile(_WORD)
PART = re.compile(r"[^'’-]+")
INITIAL = re.compile(rf"{_FIRST}(?!{_LETTER}|['’-])")
NAME = re.compile(rf"\b((?:(?:{_TITLE})\b\.? )+)({_BEFORE}{{0,4}}{_WORD}(?: {_BEFORE}{{0,4}}(?!(?:{_TITLE})\b){_WORD})*)")
DIGIT = re.compile(r"\d")


def luhn(digits: list[int]) -> int:
    """What must follow the digits to make them pass."""
    total = sum(d if k % 2 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits)))
    return -total % 10


def mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


Found = tuple[int, int, str, str]  # start, end, kind, normal form


def names(text: str) -> list[Found]:
    """Names after titles, and the same names elsewhere in the text; none overlapping.

    The last word after a title is the family name, those before it (and initials) are given names. A
    lone word is a given name if the text has it as such only. A given name has the gender that its
    titles in the text tell, none if they tell two.
    """
    plain = lambda w: unicodedata.normalize("NFC", w).lower()
    titled: list[tuple[list[tuple[int, int, str]], tuple[int, int, str], str]] = []  # given names, family name, gender
    for m in NAME.finditer(text):
        gender = next((g for t in m[1].split() if (g := TITLES[t.rstrip(".")])), "")
        *first, last = [(w.start(), w.end(), plain(w[0])) for w in WORD.finditer(text, m.start(2), m.end(2))]
        taken = [(a, b) for a, b, _ in (*first, last)]
        first += [(w.start(), w.end(), plain(w[0])) for w in INITIAL.finditer(text, m.start(2), m.end(2)) if not any(a <= w.start() < b for a, b in taken)]
        titled.append((first, last, gender))
    if not titled:
        return []
    families = {last[2] for first, last, _ in titled if first}
    genders: dict[str, set[str]] = {}
    for first, _, gender in titled:
        for _, _, norm in first:
            genders.setdefault(norm, set()).add(gender)
    for first, last, gender in titled:
        if first or last[2] in families or last[2] not in genders:
            families.add(last[2])
        else:
            genders[last[2]].add(gender)

    def told(norm: str) -> tuple[str, str]:
        if norm in families:
            return "family", norm
        known = genders[norm] - {""}
        return "given", f"{known.pop() if len(known) == 1 else ''}:{norm}"

    out: dict[int, Found] = {}
    for first, last, _ in titled:
        for a, b, norm in first:
            known = genders[norm] - {""}
            out[a] = (a, b, "given", f"{known.pop() if len(known) == 1 else ''}:{norm}")
        out[last[0]] = (last[0], last[1], *told(last[2]))
    for m in WORD.finditer(text):
        if m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] == "_"):
            continue
        # The whole word, or else its parts between hyphens and apostrophes.
        parts = [(m.start(), m.end())]
        if plain(m[0]) not in families and plain(m[0]) not in genders:
            parts = [(m.start() + p.start(), m.start() + p.end()) for p in PART.finditer(m[0])]
        for a, b in parts:
            norm = plain(text[a:b])
            if a not in out and b - a > 1 and not text[a].islower() and (norm in families or norm in genders):
                out[a] = (a, b, *told(norm))
    return sorted(out.values())


def address(text: str) -> str | None:
    """The normal form of an IPv6 address of two groups and more with a digit; null if it is none."""
    try:
        found = ipaddress.IPv6Address(text).compressed
    except ValueError:
        return None
    return found if DIGIT.search(found) and len(found.strip(":").replace("::", ":").split(":")) > 1 else None


def entities(text: str | None) -> list[Found]:
    """Entities of a text in order, none overlapping; earlier kinds win."""
    if not text:
        return []
    out: list[Found] = []
    taken: list[tuple[int, int]] = []  # in order

    def add(a: int, b: int, kind: str, norm: str) -> None:
        k = bisect.bisect(taken, (a, b))
        if (not k or taken[k - 1][1] <= a) and (k == len(taken) or taken[k][0] >= b):
            taken.insert(k, (a, b))
            out.append((a, b, kind, norm))

    def each(pattern: re.Pattern, kind: str, norm: Callable[[str], str | None], group: int = 0) -> None:
        for m in pattern.finditer(text):
            if (n := norm(m[group])) is not None:
                add(m.start(group), m.end(group), kind, n)

    only = lambda s: "".join(c for c in s if c.isdigit())
    if "@" in text:
        each(EMAIL, "email", str.lower)
    if DIGIT.search(text):
        each(SECRET, "key", lambda s: s if DIGIT.search(s) else None, 1)
        each(ACCESS, "key", str)
        each(IBAN, "iban", lambda s: x if len(x := s.replace(" ", "")) >= 15 and mod97(x) == 1 else None)
        each(CARD, "card", lambda s: only(s))
        each(IP, "ip", lambda s: s if all(int(p) < 256 for p in s.split(".")) else None)
        each(SSN, "ssn", only)
        each(PHONE, "phone", lambda s: ("+" if s[0] == "+" else "") + only(s))
    if "::" in text or text.count(":") > 6:
        each(IP6, "ip6", address)
    for a, b, kind, norm in names(text):
        add(a, b, kind, norm)
    return sorted(out)


def number(key: bytes, *parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("|".join(map(str, parts)).encode(), key=key, digest_size=16).digest(), "big")


def permuted(key: bytes, tweak: str, digits: list[int], base: int) -> list[int]:
    """A keyed permutation of digit strings of one length: a Feistel network of ten rounds; one digit is shuffled by table."""
    n = len(digits)
    if n == 0:
        return []
    if n == 1:
        table = sorted(range(base), key=lambda d: number(key, tweak, base, d))
        return [table[digits[0]]]
    u = n // 2
    value = lambda ds: sum(d * base**k for k, d in enumerate(ds))
    a, b, na, nb = value(digits[:u]), value(digits[u:]), u, n - u
    for r in range(10):
        a = (a + number(key, tweak, n, r, b)) % base**na
        a, b, na, nb = b, a, nb, na
    out = []
    for x, size in ((a, na), (b, nb)):
        for _ in range(size):
            out.append(x % base)
            x //= base
    return out


def reshaped(key: bytes, tweak: str, text: str) -> str:
    """Letters and digits permuted within their class; case, punctuation and other letters stay."""
    out = list(text)
    for name, base, at in (("d", 10, [k for k, c in enumerate(text) if c in "0123456789"]), ("a", 26, [k for k, c in enumerate(text) if c.isascii() and c.isalpha()])):
        old = [int(text[k]) if base == 10 else ord(text[k].lower()) - 97 for k in at]
        for k, d in zip(at, permuted(key, f"{tweak}{name}", old, base)):
            new = str(d) if base == 10 else chr(97 + d)
            out[k] = new.upper() if text[k].isupper() else new
    return "".join(out)


def hexed(key: bytes, tweak: str, text: str) -> str:
    digits = permuted(key, tweak, [int(c, 16) for c in text], 16)
    return "".join(f"{d:x}" for d in digits)


#: Syllables of a made-up name at the first attempt; each attempt has one more, so any number of names settles.
GIVEN, FAMILY = 3, 4


def syllables(key: bytes, tweak: str, norm: str, script: str, n: int) -> str:
    x, out, table = number(key, tweak, norm), [], SYLLABLES[script]
    for _ in range(n):
        x, d = divmod(x, len(table))
        out.append(table[d])
    return "".join(out)


def script_of(text: str) -> str:
    name = unicodedata.name(text[0], "LATIN")
    return "cyrillic" if name.startswith("CYRILLIC") else "greek" if name.startswith("GREEK") else "latin"


def surrogate(key: bytes, kind: str, norm: str, attempt: int = 0) -> str:
    """The normal form that stands for an entity."""
    tweak = f"{kind}{attempt}"
    if kind == "email":
        local, _, domain = norm.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{reshaped(key, tweak + 'l', local)}@{reshaped(key, 'host', host)}.{top}"
    if kind == "card":
        body = [int(c) for c in norm[:-1]]
        new = [body[0], *permuted(key, tweak + str(body[0]), body[1:], 10)]
        last = (luhn(new) + int(norm[-1]) - luhn(body)) % 10  # valid exactly when it was
        return "".join(map(str, [*new, last]))
    if kind == "ip":
        x = permuted(key, tweak, [d for p in norm.split(".") for d in divmod(int(p), 16)], 16)
        return ".".join(str(16 * x[k] + x[k + 1]) for k in range(0, 8, 2))
    if kind == "ip6":
        rest = iter(hexed(key, tweak, norm.replace(":", "")))
        return "".join(":" if c == ":" else next(rest) for c in norm)
    if kind == "iban":
        body = reshaped(key, tweak, norm[4:])
        return f"{norm[:2]}{98 - mod97(norm[:2] + '00' + body):02d}{body}"
    if kind == "key":
        head = norm[:4] if norm.startswith("AKIA") else ""
        body = norm[len(head) :]
        return head + (hexed(key, tweak, body) if re.fullmatch("[0-9a-f]+", body) else reshaped(key, tweak, body))
    if kind == "given":
        gender, _, name = norm.partition(":")
        script = script_of(name)
        return f"{gender}:{syllables(key, tweak, norm, script, GIVEN + attempt)}{ENDINGS[script][gender]}"
    if kind == "family":
        return syllables(key, tweak, norm, script_of(norm), FAMILY + attempt) + SURNAMES[script_of(norm)]
    plus = "+" if norm.startswith("+") else ""
    digits = [int(c) for c in norm[len(plus) :]]
    keep = max(0, len(digits) - 10) if kind == "phone" else 0  # the country's code stays
    return plus + "".join(map(str, digits[:keep] + permuted(key, tweak + norm[: keep + len(plus)], digits[keep:], 10)))


def dressed(kind: str, old: str, new: str) -> str:
    """A surrogate in the format of the mention that it replaces."""
    if kind in ("phone", "card", "ssn", "iban"):
        rest = iter(new)
        return "".join(next(rest) if c.isalnum() or c == "+" else c for c in old)
    if kind in ("given", "family"):
        new = new.rpartition(":")[2]
        return new[:1].upper() if len(old) == 1 else new.upper() if old.isupper() else new.capitalize()
    if kind == "email" and len(old) == len(new):
        return "".join(n.upper() if o.isupper() else n for o, n in zip(old, new))
    return new


ENTITY = "kind string, norm string"
found_in = entities


def found_entities(df: DataFrame) -> DataFrame:
    """Distinct kind and norm of the entities in df (name, text), with the names of their documents left out."""

    def run(batches):
        for pdf in batches:
            seen = {(kind, norm) for t in pdf.text for _, _, kind, norm in entities(t)}
            yield pd.DataFrame(sorted(seen), columns=["kind", "norm"])

    return df.select("text").mapInPandas(run, ENTITY).distinct()


def assigned(entities_: DataFrame, key: bytes) -> DataFrame:
    """kind, norm, attempt of entities whose first surrogate loses a collision check."""

    def draw(df: DataFrame) -> DataFrame:
        def run(batches):
            for pdf in batches:
                new = [surrogate(key, k, n, a) for k, n, a in zip(pdf.kind, pdf.norm, pdf.attempt)]
                yield pdf.assign(new=new)

        return df.select("kind", "norm", "attempt").mapInPandas(run, f"{ENTITY}, attempt int, new string")

    current = cut(draw(entities_.withColumn("attempt", F.lit(0))))
    for _ in range(MOST_ATTEMPTS):
        claims = current.select("kind", F.col("new").alias("value"), "norm", F.lit(0).alias("real")).union(current.select("kind", F.col("norm").alias("value"), "norm", F.lit(1).alias("real")))
        # Of several entities with one surrogate the one with most attempts, then the smallest, keeps it.
        by_value = claims.join(current.select("kind", "norm", "attempt"), ["kind", "norm"]).groupBy("kind", "value").agg(
            F.max("real").alias("real"), F.max_by("norm", F.struct((1 - F.col("real")), "attempt", F.xxhash64("norm"))).alias("owner"), F.sum(1 - F.col("real")).alias("claims")
        )
        clash = by_value.where("claims > 1 or (claims = 1 and real = 1)").select("kind", F.col("value").alias("new"), "real", "owner")
        losers = cut(current.join(clash, ["kind", "new"]).where("real = 1 or norm != owner").select("kind", "norm", (F.col("attempt") + 1).alias("attempt")))
        if losers.isEmpty():
            return current.where("attempt > 0").select("kind", "norm", "attempt")
        current = cut(current.join(losers, ["kind", "norm"], "left_anti").unionByName(draw(losers)))
    raise RuntimeError("surrogates still collide; use another key")


def key_of(spark: SparkSession) -> bytes:
    """The session's key, or one made up for this run: then nobody can undo the surrogates, and another run gives others."""
    key = spark.conf.get(KEY, None)
    return hashlib.blake2b(key.encode(), digest_size=32).digest() if key else secrets.token_bytes(32)


def rewritten(df: DataFrame, key: bytes | None = None, entities: str | None = "entities") -> DataFrame:
    """df with surrogates in its text, and a column with the array of the kinds replaced, in order.

    That column is called ``entities``, with a "_" added if df has one of the name; None leaves it out.
    """
    key = key or key_of(df.sparkSession)
    exceptions = cut(assigned(found_entities(df), key))
    name, tries_, new = (unused(df, c) for c in ("_name", "_except", "_new"))
    rows = df.withColumn(name, name_of())
    if exceptions.isEmpty():
        rows = rows.withColumn(tries_, F.lit(None).cast("map<string,int>"))
    else:

        def mentions(batches):
            for pdf in batches:
                got = {(n, kind, norm) for n, t in zip(pdf.name, pdf.text) for _, _, kind, norm in found_in(t)}
                yield pd.DataFrame(sorted(got), columns=["name", "kind", "norm"])

        where = rows.select(F.col(name).alias("name"), "text").mapInPandas(mentions, f"name binary, {ENTITY}").join(exceptions, ["kind", "norm"])
        maps = where.groupBy(F.col("name").alias(name)).agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws(":", "kind", "norm"), "attempt"))).alias(tries_))
        rows = rows.join(maps, name, "left")

    @F.pandas_udf("text string, entities array<string>")
    def replaced(text: pd.Series, attempts: pd.Series) -> pd.DataFrame:
        out = []
        for t, tries in zip(text, attempts):
            at, parts, kinds, tries = 0, [], [], dict(tries) if tries is not None else {}
            for a, b, kind, norm in found_in(t):
                parts += [t[at:a], dressed(kind, t[a:b], surrogate(key, kind, norm, tries.get(f"{kind}:{norm}", 0)))]
                kinds.append(kind)
                at = b
            out.append((t if not parts else "".join([*parts, t[at:]]), kinds))
        return pd.DataFrame(out, columns=["text", "entities"])

    done = rows.withColumn(new, replaced("text", tries_))
    added = [F.col(f"{new}.entities").alias(unused(df, entities))] if entities else []
    return done.select(*[F.col(f"{new}.text").alias("text") if c == "text" else F.col(c) for c in df.columns], *added)


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = rewritten(documents(spark, sf_dir))
    return done.select("doc_id", "text", F.size("entities").cast("long").alias("n_entities"), F.array_join("entities", ",").alias("kinds"))


QUERIES = {"op4_pii_surrogates": op4_pii_surrogates}
SQL: dict[str, str] = {}
