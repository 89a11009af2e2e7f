"""Scalar rules as Column expressions; no Python runs on executors."""

from __future__ import annotations

import unicodedata
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dictionaries import ALIASES_BLANK, ALIASES_KEEP, ALIASES_TITLE, CANON, STATUSES

INVISIBLE = "\u00a0\u200b\u200c\u200d\ufeff"
DASHES = "\u2012\u2013\u2014\u2212"
# One-letter accented forms of Latin letters and their base letters, by Unicode decomposition.
ACCENTED = "".join(c for c in map(chr, range(0xC0, 0x250)) if len(unicodedata.normalize("NFD", c)) > 1)
PLAIN = "".join(unicodedata.normalize("NFD", c)[0] for c in ACCENTED)
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def collapsed(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(x, r"(?U)\s+", " "), "^ | $", "")


def unaccented(x: Column) -> Column:
    return F.regexp_replace(F.translate(x, ACCENTED, PLAIN), "[\u0300-\u036f]", "")


def str_clean(x: Column) -> Column:
    return F.coalesce(F.regexp_replace(x.cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))


def normalize_text(x: Column, dashes: bool = True) -> Column:
    text = F.coalesce(x, F.lit(""))
    visible = F.translate(text, INVISIBLE, " " * len(INVISIBLE))
    folded = unaccented(F.translate(visible, DASHES, "-" * len(DASHES)) if dashes else visible)
    ascii_only = F.char_length(text) == F.octet_length(text)  # nothing to fold there, and translate is costly
    return collapsed(F.lower(F.when(ascii_only, text).otherwise(folded)))


def normalize_status(x: Column) -> Column:
    return F.lower(unaccented(str_clean(x)))


def title_case(x: Column) -> Column:
    return F.initcap(collapsed(F.lower(x)))


def lookup(x: Column, values: dict[str, str]) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(values.items())))[x]


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c)).lower()


BY_NORM = {plain(c): c for c in CANON}


def barrio_canon(x: Column, on_unknown: str = "keep") -> Column:
    """Canonical neighbourhood; what is unknown stays ('keep') or becomes blank ('blank')."""
    norm = normalize_text(x, dashes=False)
    if on_unknown == "keep":
        return F.when(norm == "", x).otherwise(F.coalesce(lookup(norm, ALIASES_KEEP | BY_NORM), x))
    return F.coalesce(lookup(norm, BY_NORM | ALIASES_BLANK), F.lit(""))


def barrio_canon_title(x: Column) -> Column:
    norm = normalize_text(x, dashes=False)
    return F.coalesce(lookup(norm, ALIASES_TITLE), title_case(norm))


def map_status(x: Column) -> Column:
    raw, n = str_clean(x), normalize_status(x)
    return (
        F.when(raw.isin(STATUSES), raw).when(n.startswith("realizad"), "Realizada").when(n.startswith("programad"), "en agenda").when(n.startswith("reprogramad"), "Reprogramada")
        .when(n.contains("suspendid") | n.startswith("cancelad"), "Suspendida").when(n.contains("se modifico barrio") | n.contains("modifico el barrio"), "Se modifico el barrio").otherwise("en agenda")
    )


def status_prefix(x: Column) -> Column:
    n = normalize_status(x)
    return F.when(n.startswith("realizad"), "realizada").when(n.startswith("programad"), "programada").otherwise("")


def sanitize_figura(x: Column) -> Column:
    return str_clean(F.substring_index(F.coalesce(x, F.lit("")), "&", 1))


def sanitize_barrio(x: Column) -> Column:
    return collapsed(F.coalesce(x, F.lit("")))


def persona_from_text(x: Column) -> Column:
    base = F.regexp_replace(F.coalesce(x, F.lit("")), r"\s*\(.*?\)\s*$", "")
    return str_clean(F.substring_index(F.substring_index(base, " & ", 1), " y ", 1))


def strip_html(x: Column) -> Column:
    for pattern, new in ((r"(?i)<br\s*/?>", "\n"), (r"(?i)</p>", "\n"), (r"<[^>]+>", ""), ("&nbsp;", " "), ("&amp;", "&"), (r"[ \t]+\n", "\n")):
        x = F.regexp_replace(x, pattern, new)
    return str_clean(x)


def split_lines(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, r"\r?\n"), lambda s: str_clean(F.translate(s, "\u00a0", " "))), lambda s: s != "")


def excluded(x: Column) -> Column:
    return F.lower(unaccented(F.coalesce(x, F.lit("")))).contains("no participa")


# Numbers


def first_comma(x: Column) -> Column:
    return F.regexp_replace(str_clean(x), "^([^,]*),", "$1.")


def num_parse(x: Column) -> Column:
    s = first_comma(x)
    return F.when(s.rlike(NUMBER), s.try_cast("double")).otherwise(0.0)


def num_strict(x: Column) -> Column:
    """Blank is 0; text that is no number (a decimal comma too) is null, so comparisons with it accept nothing."""
    s = str_clean(x)
    return F.when(s == "", 0.0).when(s.rlike(NUMBER), s.try_cast("double"))


def num_prefix_parse(x: Column) -> Column:
    s = F.regexp_extract(first_comma(x), r"^\s*([+-]?\d+(?:\.\d+)?)", 1)
    return F.coalesce(s.try_cast("double"), F.lit(0.0))


def numeric_like(x: Column) -> Column:
    return first_comma(x).rlike(NUMBER)


def empty_or_zero(x: Column) -> Column:
    s = first_comma(x)
    return (s == "") | (s.rlike(NUMBER) & (num_parse(x) == 0))


def rounded(x: Column) -> Column:
    """Half up, towards plus infinity."""
    return F.floor(x + 0.5)


def gender_allocation(total: Column, part: Column, unique: Column) -> Column:
    return F.when(unique > 0, rounded(total * (part.cast("double") / unique))).otherwise(0).cast("long")


def rrss_fallback(rrss: Column, parts: Column, blank_falls_through: bool = True) -> Column:
    return F.when(str_clean(rrss) != "", num_parse(rrss)).otherwise(parts if blank_falls_through else F.lit(0.0))


# Dates and times


def parse_date_lenient(x: Column, as_of: str) -> Column:
    """d/m, d/m/y, d-m-y and 20yy-m-d; days and months roll over; a missing year is that of as_of."""
    dmy, ymd = r"^\s*(\d{1,2})[/-](\d{1,2})(?:[/-](\d{2,4}))?\s*$", r"^\s*(20\d{2})[/-](\d{1,2})[/-](\d{1,2})\s*$"
    part = lambda p, k: F.regexp_extract(x, p, k).try_cast("int")
    y = F.coalesce(part(dmy, 3), F.lit(int(as_of[:4])))
    y = F.when(y < 100, y + 2000).otherwise(y)
    rolled = lambda y, m, d: F.date_add(F.add_months(F.make_date(y, F.lit(1), F.lit(1)), m - 1), d - 1)
    return F.when(x.rlike(dmy), rolled(y, part(dmy, 2), part(dmy, 1))).when(x.rlike(ymd), rolled(part(ymd, 1), part(ymd, 2), part(ymd, 3)))


def parse_time_ampm(x: Column) -> Column:
    pattern = r"(?i)^\s*(\d{1,2}):(\d{2})\s*(AM|PM)?\s*$"
    h, half = F.regexp_extract(x, pattern, 1).try_cast("int"), F.upper(F.regexp_extract(x, pattern, 3))
    h = F.when((half == "PM") & (h < 12), h + 12).when((half == "AM") & (h == 12), 0).otherwise(h)
    return F.when(x.rlike(pattern), F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":"), F.regexp_extract(x, pattern, 2)))


def format_hora(x: Column, seconds: bool = True) -> Column:
    """Padded: with seconds H:mm and H:mm:ss to HH:mm:ss, without them H:mm only to HH:mm; other text as it is."""
    s = str_clean(x)
    hms = r"^(\d{1,2}):(\d{2})(?::(\d{2}))?$" if seconds else r"^(\d{1,2}):(\d{2})$"
    padded = F.concat(F.lpad(F.regexp_extract(s, hms, 1), 2, "0"), F.lit(":"), F.regexp_extract(s, hms, 2))
    if seconds:
        padded = F.concat(padded, F.lit(":"), F.coalesce(F.nullif(F.regexp_extract(s, hms, 3), F.lit("")), F.lit("00")))
    return F.when(s.rlike(hms), padded).otherwise(s)


def monday(as_of: str) -> Column:
    return F.date_trunc("week", F.lit(as_of).cast("timestamp")).cast("date")


def week_bucket(d: Column, as_of: str) -> Column:
    m = monday(as_of)
    return F.when(d >= F.date_add(m, 7), "future").when(d >= m, "current").when(d >= F.date_sub(m, 7), "past")


def ymd(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd")


def dmy(d: Column) -> Column:
    return F.date_format(d, "dd/MM/yyyy")


def blank_null(x: Column) -> Column:
    return F.nullif(str_clean(x), F.lit(""))


def key_fbf(figura: Column, barrio: Column, d: Column) -> Column:
    """figura|barrio|yyyyMMdd, null if a part is blank."""
    f, b = F.nullif(normalize_text(figura), F.lit("")), F.nullif(normalize_text(barrio), F.lit(""))
    return F.concat(f, F.lit("|"), b, F.lit("|"), ymd(d))


def key_a(figura: Column, d: Column, hora: Column | None = None) -> Column:
    """figura|yyyyMMdd[|HH:mm]; parts may be blank, the key is never null."""
    parts = [normalize_text(figura), F.coalesce(ymd(d), F.lit(""))] + ([F.coalesce(hora, F.lit(""))] if hora is not None else [])
    return F.concat_ws("|", *parts)


def number_text(x: Column) -> Column:
    """A number as a cell shows it: whole numbers without a point, others in plain digits; only below 1e-4 with an exponent, of two digits."""
    told = x.cast("double").cast("string")  # may be 9.5E-4 or 1.25E7
    # A fraction of 1e-4 and more has at most 16 digits before its point and 21 after it.
    plain = F.coalesce(F.regexp_replace(told.try_cast("decimal(38,21)").cast("string"), "0+$", ""), told)
    tiny = F.regexp_replace(F.regexp_replace(told, r"(?:\.0)?E-", "e-"), r"e-(\d)$", "e-0$1")
    return F.when(x == F.floor(x), x.cast("long").cast("string")).otherwise(F.when(F.abs(x) < 1e-4, tiny).otherwise(plain))


def key_b(nombre: Column, inscriptos: Column) -> Column:
    """nombre|inscriptos, null without a name; whole numbers are written without a point."""
    n = number_text(inscriptos)
    return F.concat(F.nullif(normalize_text(nombre), F.lit("")), F.lit("|"), n)
