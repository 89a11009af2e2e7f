"""Typed cells: a VARIANT holds text, a number or an instant, as a cell of a sheet does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import scalars as X

INSTANTS = ("TIMESTAMP", "TIMESTAMP_NTZ", "DATE")
NUMBERS = ("BIGINT", "DOUBLE", "FLOAT")


def cell(*forms: Column) -> Column:
    """One cell from columns of different types, of which at most one is not null in a row."""
    return F.coalesce(*[x.cast("variant") for x in forms])


def kind(x: Column) -> Column:
    """texto, numero or fecha; null for a blank cell."""
    of = F.schema_of_variant(x)
    text = F.when(X.str_clean(as_text(x)) != "", "texto")
    return F.when(of.isin(*INSTANTS), "fecha").when(of.isin(*NUMBERS) | of.startswith("DECIMAL"), "numero").when(of == "STRING", text)


def as_text(x: Column) -> Column:
    return F.try_variant_get(x, "$", "string")


def number(x: Column) -> Column:
    return F.when(kind(x) == "numero", F.try_variant_get(x, "$", "double"))


def instant(x: Column) -> Column:
    return F.when(kind(x) == "fecha", F.try_variant_get(x, "$", "timestamp_ntz"))


def shown(x: Column) -> Column:
    """A cell's text: whole numbers without a point, blanks around text gone, an instant by day and time."""
    return F.coalesce(X.number_text(number(x)), F.date_format(instant(x), "yyyy-MM-dd HH:mm:ss"), X.str_clean(as_text(x)))


def hora(x: Column, seconds: bool = True) -> Column:
    """HH:mm:ss (or HH:mm) of a cell: a number is a fraction of a day, rounded half up; an instant gives its time; text as in format_hora."""
    per = 86_400 if seconds else 1_440
    total = X.rounded(number(x) * per)
    two = lambda v: F.lpad(v.cast("long").cast("string"), 2, "0")
    parts = [F.floor(total / 3600), F.floor(total % 3600 / 60), total % 60] if seconds else [F.floor(total / 60), total % 60]
    pattern = "HH:mm:ss" if seconds else "HH:mm"
    return F.when(kind(x) == "numero", F.concat_ws(":", *map(two, parts))).when(kind(x) == "fecha", F.date_format(instant(x), pattern)).otherwise(X.format_hora(as_text(x), seconds))


def equal(a: Column, b: Column) -> Column:
    """Instants are equal by instant; anything else by its text, blank and null being the same. An instant equals no text."""
    both, one = (kind(a) == "fecha") & (kind(b) == "fecha"), (kind(a) == "fecha") | (kind(b) == "fecha")
    yes = lambda x: F.coalesce(x, F.lit(False))
    return F.when(yes(both), instant(a) == instant(b)).when(yes(one), False).otherwise(shown(a) == shown(b))


def day(x: Column, as_of: str) -> Column:
    """The day of a cell: an instant's, else what its text says; a number is none."""
    return F.coalesce(instant(x).cast("date"), F.when(kind(x) == "texto", X.parse_date_lenient(as_text(x), as_of)))


def same_day(a: Column, b: Column, as_of: str) -> Column:
    """Whether two cells say the same day; two that say none are the same."""
    return day(a, as_of).eqNullSafe(day(b, as_of))
