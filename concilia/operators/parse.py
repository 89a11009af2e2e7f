"""The line-oriented mail parser as a set of rules over lines; no state machine, no Python on executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X

# The lines of an agenda mail.
DAY = r"(?iu)^(lunes|martes|miércoles|miercoles|jueves|viernes|sábado|sabado|domingo)\s+(\d{1,2}/\d{1,2})$"
EVENT = r"(?iu)^evento:\s*encuentro con vecinos\s+(.+?),\s*(.+)$"
HOUR = r"(?iu)^hora:\s*(\d{1,2}:\d{2})h"
PLACE = r"(?iu)^lugar:\s*(.+)$"


def agenda(mails: DataFrame, key: str, body: str, as_of: str) -> DataFrame:
    """key, pos, persona, barrio, fecha, hora, direccion: one row per complete event of each message, pos its place in it.

    A message is the unit of order and is bounded, so its lines are folded within the row: an event
    line opens a block that takes the day above it, and the last hour and place below it.
    """
    kinds = F.transform(
        X.split_lines(F.col(body)),
        lambda s, i: F.struct(
            i.alias("i"), F.when(s.rlike(DAY), F.regexp_extract(s, DAY, 2)).alias("day"), F.when(s.rlike(EVENT), s).alias("event"), F.when(s.rlike(HOUR), F.regexp_extract(s, HOUR, 1)).alias("hora"),
            F.when(s.rlike(PLACE), F.trim(F.regexp_extract(s, PLACE, 1))).alias("lugar"),
        ),
    )
    lines = mails.select(key, kinds.alias("lines"))
    opened = F.filter("lines", lambda x: x["event"].isNotNull())

    def block(x):
        after = F.coalesce(F.array_min(F.transform(F.filter(opened, lambda y: y["i"] > x["i"]), lambda y: y["i"])), F.lit(2**31 - 1))
        inside = F.filter("lines", lambda y: (y["i"] > x["i"]) & (y["i"] < after))
        above = F.filter("lines", lambda y: y["i"] < x["i"])
        return F.struct(x["event"].alias("event"), F.try_element_at(F.transform(F.filter(above, lambda y: y["day"].isNotNull()), lambda y: y["day"]), F.lit(-1)).alias("day"),
                        F.try_element_at(F.transform(F.filter(inside, lambda y: y["hora"].isNotNull()), lambda y: y["hora"]), F.lit(-1)).alias("hora"),
                        F.try_element_at(F.transform(F.filter(inside, lambda y: y["lugar"].isNotNull()), lambda y: y["lugar"]), F.lit(-1)).alias("lugar"))

    events = lines.select(key, F.posexplode(F.transform(opened, block)).alias("pos", "e")).select(key, "pos", "e.*")
    who, where = F.trim(F.regexp_extract("event", EVENT, 1)), F.trim(F.regexp_extract("event", EVENT, 2))
    events = events.where(~X.excluded(F.concat_ws(" ", who, where))).select(
        key, "pos", X.persona_from_text(who).alias("persona"), where.alias("barrio"), X.parse_date_lenient(F.concat("day", F.lit(f"/{as_of[:4]}")), as_of).alias("fecha"), "hora",
        F.when(F.col("lugar").rlike("(?i)^a confirmar"), "").otherwise(F.coalesce("lugar", F.lit(""))).alias("direccion"),
    )
    return events.where("persona != '' and fecha is not null and hora is not null")
