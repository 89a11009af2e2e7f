"""The agenda of meetings: filled from mails, archived by week, pushed into the base.

An agenda row has automatic columns (*_auto), which each sync overwrites, manual ones (*_manual) and flags,
which no sync touches; the manual value goes before the automatic one wherever a row is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from . import parse
from .stage import cut

c = F.col
FIELDS = ["persona", "barrio", "fecha", "hora", "direccion"]
AUTO, MANUAL = [f"{x}_auto" for x in FIELDS], [f"{x}_manual" for x in FIELDS]
FLAGS = ["listo", "enviado", "enviado_ts"]
COLUMNS = ["id", *AUTO, "fuente", *MANUAL, *FLAGS]
#: Where a row comes from, then its number there: rows that a job appends never share a number with rows that were there.
PLACE = ["origen", "_row", "_pos"]
SUBJECT, LOOK_BACK, KEEP_DAYS = "agenda encuentros de vecinos", 21, 3


def last_messages(mails: DataFrame, as_of: str, days: int = LOOK_BACK) -> DataFrame:
    """The last message of each thread that has a message with the subject within the days before as_of. mails: msg (rising within a thread), thread, sent, subject, body."""
    asked = F.lower("subject").contains(SUBJECT) & (c("sent") >= F.date_sub(F.lit(as_of).cast("date"), days))
    last = mails.groupBy("thread").agg(F.max("msg").alias("msg"), F.max(F.coalesce(asked, F.lit(False))).alias("asked")).where("asked").select("msg")
    return mails.join(last, "msg", "left_semi")


def events(mails: DataFrame, as_of: str) -> DataFrame:
    """id, AUTO, fuente and place (when and where it was said) of every event from as_of on."""
    found = parse.agenda(mails, "msg", "body", as_of).where(c("fecha") >= F.lit(as_of).cast("date")).join(mails.select("msg", "sent", "subject"), "msg")
    id_ = F.concat_ws("|", X.normalize_text(c("persona")), X.ymd(c("fecha")), F.trim("hora"))
    return found.select(id_.alias("id"), *[c(x).alias(f"{x}_auto") for x in FIELDS], c("subject").alias("fuente"), F.struct("sent", "msg", "pos").alias("place"))


def upserted(agenda: DataFrame, said: DataFrame) -> DataFrame:
    """The whole agenda after a sync, PLACE and COLUMNS: what mails say goes into the automatic columns and the source; the rest of a row stays.

    Among events with one id the last said wins; the last agenda row of an id takes it. A new id is a new row, placed where it was first said.
    """
    families = ["fuente", *AUTO]
    news = said.groupBy("id").agg(F.max_by(F.struct(*families), "place").alias("u"), F.min("place").alias("first"))
    last = agenda.where(X.str_clean(c("id")) != "").groupBy("id").agg(F.max("_row").alias("_row"), F.lit(True).alias("is_last"))
    # Rows that no mail may touch meet nothing: they are dealt by their number.
    at = F.when(c("is_last"), c("id")).otherwise(F.concat(F.lit("#"), c("_row").cast("string")))
    rows = agenda.join(last, ["id", "_row"], "left").select(at.alias("at"), F.struct("_row", *COLUMNS).alias("p"))
    both = rows.join(news.select(c("id").alias("at"), "u", "first"), "at", "full_outer")
    cell = {
        "id": F.coalesce("p.id", "at"), **{x: F.when(c("u").isNotNull(), c(f"u.{x}")).otherwise(c(f"p.{x}")) for x in families},
        **{x: F.coalesce(f"p.{x}", F.lit("")) for x in MANUAL}, "listo": F.coalesce("p.listo", F.lit(False)), "enviado": F.coalesce("p.enviado", F.lit(False)), "enviado_ts": F.coalesce("p.enviado_ts", F.lit("")),
    }
    new = c("p").isNull()
    place = [F.when(new, "mail").otherwise("agenda").alias("origen"), F.when(new, c("first.msg")).otherwise(c("p._row")).alias("_row"), F.when(new, c("first.pos")).otherwise(0).alias("_pos")]
    return both.select(*place, *[cell[x].alias(x) for x in COLUMNS])


def effective(x: str) -> Column:
    return F.coalesce(X.blank_null(c(f"{x}_manual")), X.blank_null(c(f"{x}_auto")))


def effective_date(as_of: str) -> Column:
    """The manual date where it can be read, else the automatic one."""
    return F.coalesce(X.parse_date_lenient(c("fecha_manual"), as_of), c("fecha_auto"))


def filed(agenda: DataFrame, as_of: str, cut_off: Column | None = None) -> DataFrame:
    """agenda with destino: rows whose date lies before the cut-off (KEEP_DAYS before Monday, unless given) go to the archive; rows without a date stay. semana labels those that stay."""
    day = effective_date(as_of)
    limit = cut_off if cut_off is not None else F.date_sub(X.monday(as_of), KEEP_DAYS)
    old = F.coalesce(day < limit, F.lit(False))
    return agenda.withColumns({"destino": F.when(old, "Agenda ya incorporada").otherwise("Agenda"), "semana": F.when(~old, X.week_bucket(day, as_of))})


def ready(agenda: DataFrame, as_of: str) -> DataFrame:
    """Rows to be sent: ready, not sent, and with a person, a neighbourhood and a date. PLACE, key, id_final and the base's cells."""
    hora = F.coalesce(F.nullif(X.format_hora(c("hora_manual")), F.lit("")), F.nullif(X.format_hora(c("hora_auto")), F.lit("")), F.lit(""))
    said = agenda.where(c("listo") & ~c("enviado")).select(
        *PLACE, effective("persona").alias("figura"), effective("barrio").alias("barrio"), effective_date(as_of).alias("fecha_d"), hora.alias("hora"), F.coalesce(effective("direccion"), F.lit("")).alias("direccion"),
    )
    # Each rule reads the one before it several times, so they are written one after the other and not nested.
    named = cut(cut(said).withColumn("barrio", F.coalesce(F.nullif(X.barrio_canon(c("barrio")), F.lit("")), c("barrio"))))
    rows = cut(named.withColumn("key", X.key_fbf(c("figura"), c("barrio"), c("fecha_d")))).where("key is not null")
    return rows.withColumn("id", F.concat_ws(" - ", "figura", "barrio", X.dmy(c("fecha_d"))))


def into_base(base: DataFrame, sent: DataFrame) -> DataFrame:
    """The whole base after the push: origen, _row, figura, barrio, fecha_d, hora, direccion, status, id, asistentes.

    The last base row of a key takes the row sent last; an hour or address that is blank there leaves what is said before it; a
    status is set only where there is none. Keys that the base lacks become rows, where they were first sent.
    """
    order = F.struct(*PLACE)
    said = lambda x: F.max_by(x, F.when(c(x) != "", order)).alias(x)
    news = sent.groupBy("key").agg(F.max_by(F.struct("figura", "barrio", "fecha_d", "id"), order).alias("u"), said("hora"), said("direccion"), F.min(order).alias("first"))
    news = news.select("key", F.struct("u.*", "hora", "direccion", "first").alias("u"))
    keyed = cut(base.withColumn("key", X.key_fbf(c("figura"), c("barrio"), c("fecha_d"))))
    last = keyed.where("key is not null").groupBy("key").agg(F.max("_row").alias("_row"), F.lit(True).alias("is_last"))
    at = F.when(c("is_last"), c("key")).otherwise(F.concat(F.lit("#"), c("_row").cast("string")))
    cells = ["figura", "barrio", "fecha_d", "hora", "direccion", "status", "id", "asistentes"]
    rows = keyed.join(last, ["key", "_row"], "left").select(at.alias("key"), F.struct("_row", *cells).alias("p"))
    both = rows.join(news, "key", "full_outer")
    hit, new = c("u").isNotNull(), c("p").isNull()
    cell = {
        **{x: F.when(hit, c(f"u.{x}")).otherwise(c(f"p.{x}")) for x in ("figura", "barrio", "fecha_d", "id")}, **{x: F.coalesce(f"u.{x}", f"p.{x}", F.lit("")) for x in ("hora", "direccion")},
        "status": F.when(hit & (X.str_clean(c("p.status")) == ""), "en agenda").otherwise(c("p.status")), "asistentes": F.coalesce("p.asistentes", F.lit("")),
    }
    place = [F.when(new, c("u.first.origen")).otherwise("base").alias("origen"), F.when(new, c("u.first._row")).otherwise(c("p._row")).alias("_row")]
    return both.select(*place, *[cell[x].alias(x) for x in cells])


def marked(agenda: DataFrame, sent: DataFrame, stamp: str) -> DataFrame:
    """The agenda with what was sent marked so, at the time ``stamp``."""
    done = sent.select(*PLACE, F.lit(True).alias("_sent"))
    out = agenda.join(done, PLACE, "left")
    return out.withColumns({"enviado": c("enviado") | F.coalesce("_sent", F.lit(False)), "enviado_ts": F.when(c("_sent"), stamp).otherwise(c("enviado_ts"))}).drop("_sent")


def mirror(agenda: DataFrame, as_of: str) -> DataFrame:
    """The agenda in the base's columns, by date: rows with a person and a date; of the neighbourhoods (manual, automatic) the first that is known."""
    known = [F.nullif(X.barrio_canon(c(x), "blank"), F.lit("")) for x in ("barrio_manual", "barrio_auto")]
    hora = F.coalesce(F.nullif(X.format_hora(c("hora_manual")), F.lit("")), F.nullif(X.format_hora(c("hora_auto")), F.lit("")), F.lit(""))
    rows = agenda.select(*PLACE, effective("persona").alias("figura"), F.coalesce(*known, F.lit("")).alias("barrio"), effective_date(as_of).alias("fecha"), hora.alias("hora"), F.coalesce(effective("direccion"), F.lit("")).alias("direccion"))
    rows = rows.where("figura is not null and fecha is not null").withColumn("status", F.lit("en agenda"))
    return rows.withColumn("id", F.concat_ws(" - ", "figura", X.blank_null(c("barrio")), X.dmy(c("fecha")))).orderBy("fecha", *PLACE)
