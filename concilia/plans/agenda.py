"""Agenda jobs on whole tables, each with its SQL written apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import agenda as G
from ..operators.stage import cut
from ..sources.sheets import AS_OF, FAR, raw, sql_with
from . import dialect as D
from .flagship import base_sheet

QUERIES: dict = {}
SQL: dict[str, str] = {}
c = F.col

# In the dialect that Spark and DuckDB share: threads of three mails, with one event or two each, and the agenda that is there already.
_E1, _E2 = f"(DATE '{AS_OF}' + CAST(k % 9 - 2 AS INT))", f"(DATE '{AS_OF}' + CAST(k % 9 - 1 AS INT))"
_DM = lambda d: f"CAST(day({d}) AS STRING) || '/' || CAST(month({d}) AS STRING)"
_YMD = lambda d: f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS STRING)"
_HORA = "CAST(k % 2 + 9 AS STRING) || ':30'"
_WHERE = "CASE WHEN k % 7 = 0 THEN 'NO PARTICIPA' ELSE barrio || ' centro' END"
_SUBJECT = "CASE WHEN k % 5 = 0 THEN 'Otra cosa' WHEN k % 5 = 1 THEN 'Fwd: Agenda Encuentros de vecinos' ELSE 'AGENDA Encuentros de Vecinos ' || CAST(k % 4 AS STRING) END"
MAILS = f"""SELECT _row AS msg, CAST(floor(k / 3) AS BIGINT) AS thread, DATE '{AS_OF}' - CAST(k % 30 AS INT) AS sent, {_SUBJECT} AS subject, name, barrio, k,
  'Lunes ' || {_DM(_E1)} || chr(10) || 'Evento: Encuentro con vecinos ' || name || ' (sala), ' || {_WHERE} || chr(10) || 'Hora: ' || {_HORA} || 'h' || chr(10)
  || 'Lugar: ' || CASE WHEN k % 3 = 1 THEN 'A confirmar' ELSE 'Calle ' || CAST(k AS STRING) END
  || CASE WHEN k % 4 = 0 THEN chr(10) || 'Martes ' || {_DM(_E2)} || chr(10) || 'Evento: Encuentro con vecinos ' || name || ' & Ana, Retiro' || chr(10) || 'Hora: 10:15h' ELSE '' END AS body FROM {{raw}}"""
_ROW = f"""lower(name) || '|' || {_YMD(_E1)} || '|' || {_HORA} AS id, name AS persona_auto, 'viejo' AS barrio_auto, {_E1} - CAST(k % 40 AS INT) AS fecha_auto, {_HORA} AS hora_auto, 'Calle vieja' AS direccion_auto, 'hoja' AS fuente,
  CASE WHEN k % 4 = 3 THEN figura ELSE '' END AS persona_manual, CASE WHEN k % 4 = 3 THEN barrio WHEN k % 9 = 0 THEN 'boca' WHEN k % 9 = 3 THEN ' ' ELSE '' END AS barrio_manual, CASE WHEN k % 4 = 3 THEN fecha WHEN k % 15 = 0 THEN 'sin fecha' ELSE '' END AS fecha_manual,
  CASE WHEN k % 15 = 0 THEN '9:05' WHEN k % 15 = 3 THEN 'tarde' ELSE '' END AS hora_manual, CASE WHEN k % 6 = 3 THEN 'Sala ' || CAST(k % 5 AS STRING) ELSE '' END AS direccion_manual, k % 2 = 1 AS listo, k % 10 = 3 AS enviado, CASE WHEN k % 10 = 3 THEN '1998-06-01 09:00:00' ELSE '' END AS enviado_ts"""
AGENDA = f"SELECT _row, {_ROW} FROM {{raw}} WHERE k % 5 IN (0, 2, 3) AND k % 33 <> 0 UNION ALL SELECT _row, '' AS id, * EXCEPT (_row, id) FROM (SELECT _row, {_ROW} FROM {{raw}} WHERE k % 5 IN (0, 2, 3) AND k % 33 = 0) UNION ALL SELECT _row + {FAR}, {_ROW} FROM {{raw}} WHERE k % 60 = 3"


def agenda_before(spark, d) -> DataFrame:
    return spark.sql(AGENDA, raw=raw(spark, d))


def messages(spark, d) -> DataFrame:
    return G.last_messages(spark.sql(MAILS, raw=raw(spark, d)), AS_OF)


def agenda_now(spark, d) -> DataFrame:
    return cut(G.upserted(agenda_before(spark, d), cut(G.events(cut(messages(spark, d)), AS_OF))))


def agenda_messages(spark, d):
    return messages(spark, d).select("msg", "thread", "sent", "subject")


def agenda_upsert(spark, d):
    """The whole Agenda after the mails: automatic columns and source overwritten, manual columns and flags kept."""
    return agenda_now(spark, d)


def agenda_sync(spark, d):
    """The mail job: the upserted Agenda, each row with its sheet (Agenda or archive) and week."""
    return G.filed(agenda_now(spark, d), AS_OF)


def agenda_sync_dormant(spark, d):
    """Its dormant variant, which archives every row before today."""
    return G.filed(agenda_now(spark, d), AS_OF, F.lit(AS_OF).cast("date")).drop("semana")


def _base(spark, d) -> DataFrame:
    cleared = F.when(c("_row") % 7 == 0, "").otherwise(c("status"))
    return base_sheet(spark, d).select("_row", "figura", "barrio", "fecha_d", "hora", "direccion", cleared.alias("status"), F.lit("").alias("id"), "asistentes")


STAMP = f"{AS_OF} 12:00:00"


def agenda_push_base(spark, d):
    """The whole base after the Agenda's ready rows were pushed into it."""
    return G.into_base(_base(spark, d), G.ready(agenda_now(spark, d), AS_OF))


def agenda_push_marks(spark, d):
    """The whole Agenda after the push, sent rows marked with the time."""
    now = agenda_now(spark, d)
    return G.marked(now, G.ready(now, AS_OF), STAMP)


def agenda_mirror_table(spark, d):
    """The Agenda mirrored in the base's columns, by date."""
    return G.mirror(agenda_now(spark, d), AS_OF)


QUERIES |= {f.__name__: f for f in (agenda_messages, agenda_upsert, agenda_sync, agenda_sync_dormant, agenda_push_base, agenda_push_marks, agenda_mirror_table)}

# The same in SQL. Events are made from the numbers that the mails were made from, not parsed.
_AUTO, _MAN, _FLAGS = ", ".join(G.AUTO), ", ".join(G.MANUAL), ", ".join(G.FLAGS)
_PUT = lambda t: t.format(raw="raw")
_DUCK_AGENDA = _PUT(AGENDA).replace("* EXCEPT", "* EXCLUDE")
_MSG = f", mails AS ({_PUT(MAILS)}), chosen AS (SELECT thread, max(msg) AS msg FROM mails GROUP BY thread HAVING bool_or(contains(lower(subject), '{G.SUBJECT}') AND sent >= DATE '{AS_OF}' - {G.LOOK_BACK})), msgs AS (SELECT mails.* FROM mails JOIN chosen USING (thread, msg))"
_NOW = f"""{_MSG}, agenda_0 AS ({_DUCK_AGENDA}),
evs AS (SELECT msg, 0 AS pos, sent, subject, name AS persona, trim(barrio || ' centro') AS barrio, CAST({_E1} AS DATE) AS fecha, {_HORA} AS hora, CASE WHEN k % 3 = 1 THEN '' ELSE 'Calle ' || k END AS direccion FROM msgs WHERE k % 7 <> 0
  UNION ALL SELECT msg, 1, sent, subject, name, 'Retiro', CAST({_E2} AS DATE), '10:15', '' FROM msgs WHERE k % 4 = 0),
said AS (SELECT *, {D.norm('persona')} || '|' || {D.ymd('fecha')} || '|' || hora AS id FROM evs WHERE fecha >= DATE '{AS_OF}'),
lasts AS (SELECT * FROM said QUALIFY row_number() OVER (PARTITION BY id ORDER BY sent DESC, msg DESC, pos DESC) = 1), firsts AS (SELECT id, msg, pos FROM said QUALIFY row_number() OVER (PARTITION BY id ORDER BY sent, msg, pos) = 1),
tops AS (SELECT id, max(_row) AS _row FROM agenda_0 WHERE id <> '' GROUP BY id),
agenda_n AS (SELECT 'agenda' AS origen, a._row, 0 AS _pos, a.id, {', '.join(f'CASE WHEN u.id IS NULL THEN a.{x}_auto ELSE u.{x} END AS {x}_auto' for x in G.FIELDS)}, CASE WHEN u.id IS NULL THEN a.fuente ELSE u.subject END AS fuente, {_MAN}, {_FLAGS}
  FROM agenda_0 a LEFT JOIN tops t ON a._row = t._row AND a.id = t.id LEFT JOIN lasts u ON t.id = u.id
  UNION ALL SELECT 'mail', f.msg, f.pos, id, {', '.join(f'l.{x}' for x in G.FIELDS)}, l.subject, {', '.join("''" for _ in G.MANUAL)}, false, false, '' FROM lasts l JOIN firsts f USING (id) WHERE id NOT IN (SELECT id FROM tops))"""
_EFF = lambda x: f"coalesce(nullif({D.clean(x + '_manual')}, ''), nullif({D.clean(x + '_auto')}, ''))"
_DAY = f"coalesce({D.date('fecha_manual')}, fecha_auto)"
_MONDAY = f"(DATE '{AS_OF}' - (isodow(DATE '{AS_OF}') - 1)::INT)"
_OLD = lambda limit: f"coalesce({_DAY} < {limit}, false)"
_FILED = lambda limit: f"CASE WHEN {_OLD(limit)} THEN 'Agenda ya incorporada' ELSE 'Agenda' END AS destino"
_LIMIT = f"{_MONDAY} - {G.KEEP_DAYS}"
_TIME = f"coalesce(nullif({D.hora('hora_manual')}, ''), nullif({D.hora('hora_auto')}, ''), '')"
_READY = f""", r_0 AS (SELECT origen, _row, _pos, {_EFF('persona')} AS figura, {_EFF('barrio')} AS b, {_DAY} AS fecha_d, {_TIME} AS hora, coalesce({_EFF('direccion')}, '') AS direccion FROM agenda_n WHERE listo AND NOT enviado),
r_1 AS (SELECT *, {D.barrio_keep('b')} AS barrio FROM r_0), sent AS (SELECT *, nullif({D.norm('figura')}, '') || '|' || nullif({D.norm('barrio')}, '') || '|' || {D.ymd('fecha_d')} AS key, concat_ws(' - ', figura, barrio, strftime(fecha_d, '%d/%m/%Y')) AS id FROM r_1 WHERE key IS NOT NULL)"""
_ORDER = "ORDER BY origen, _row, _pos"
_PUSH = f"""{_READY}, b_0 AS (SELECT _row, figura, barrio, {D.date('fecha')} AS fecha_d, hora, direccion, CASE WHEN _row % 7 = 0 THEN '' ELSE status END AS status, '' AS id, asistentes FROM base),
b_k AS (SELECT *, nullif({D.norm('figura')}, '') || '|' || nullif({D.norm('barrio')}, '') || '|' || {D.ymd('fecha_d')} AS key FROM b_0), b_t AS (SELECT key, max(_row) AS _row FROM b_k WHERE key IS NOT NULL GROUP BY key),
n_l AS (SELECT key, last(figura {_ORDER}) AS figura, last(barrio {_ORDER}) AS barrio, last(fecha_d {_ORDER}) AS fecha_d, last(id {_ORDER}) AS id, last(hora {_ORDER}) FILTER (hora <> '') AS hora, last(direccion {_ORDER}) FILTER (direccion <> '') AS direccion, first(origen {_ORDER}) AS origen, first(_row {_ORDER}) AS _row FROM sent GROUP BY key)
SELECT 'base' AS origen, b._row, {', '.join(f'CASE WHEN n.key IS NULL THEN b.{x} ELSE n.{x} END AS {x}' for x in ('figura', 'barrio', 'fecha_d', 'id'))}, {', '.join(f"coalesce(n.{x}, b.{x}, '') AS {x}" for x in ('hora', 'direccion'))},
  CASE WHEN n.key IS NOT NULL AND {D.clean('b.status')} = '' THEN 'en agenda' ELSE b.status END AS status, coalesce(b.asistentes, '') AS asistentes FROM b_k b LEFT JOIN b_t t ON b.key = t.key AND b._row = t._row LEFT JOIN n_l n ON t.key = n.key
UNION ALL SELECT origen, _row, figura, barrio, fecha_d, id, coalesce(hora, ''), coalesce(direccion, ''), 'en agenda', '' FROM n_l WHERE key NOT IN (SELECT key FROM b_t)"""
_PLACE = ", ".join(G.PLACE)
_MIRROR = f""", m_0 AS (SELECT {_PLACE}, {_EFF('persona')} AS figura, coalesce(nullif({D.barrio_blank('barrio_manual')}, ''), nullif({D.barrio_blank('barrio_auto')}, ''), '') AS barrio, {_DAY} AS fecha, {_TIME} AS hora, coalesce({_EFF('direccion')}, '') AS direccion, 'en agenda' AS status FROM agenda_n)
SELECT *, concat_ws(' - ', figura, nullif(barrio, ''), strftime(fecha, '%d/%m/%Y')) AS id FROM m_0 WHERE figura IS NOT NULL AND fecha IS NOT NULL ORDER BY fecha, {_PLACE}"""
_WEEK = f"CASE WHEN {_OLD(_LIMIT)} THEN NULL WHEN {_DAY} >= {_MONDAY} + 7 THEN 'future' WHEN {_DAY} >= {_MONDAY} THEN 'current' WHEN {_DAY} >= {_MONDAY} - 7 THEN 'past' END AS semana"
SQL |= {
    "agenda_messages": f"{sql_with()}{_MSG} SELECT msg, thread, CAST(sent AS DATE) AS sent, subject FROM msgs",
    "agenda_upsert": f"{sql_with()}{_NOW} SELECT * FROM agenda_n",
    "agenda_sync": f"{sql_with()}{_NOW} SELECT *, {_FILED(_LIMIT)}, {_WEEK} FROM agenda_n",
    "agenda_sync_dormant": f"{sql_with()}{_NOW} SELECT *, {_FILED(f"DATE '{AS_OF}'")} FROM agenda_n",
    "agenda_push_base": f"{sql_with('base')}{_NOW}{_PUSH}",
    "agenda_push_marks": f"{sql_with()}{_NOW}{_READY} SELECT a.* EXCLUDE (enviado, enviado_ts), a.enviado OR s.key IS NOT NULL AS enviado, CASE WHEN s.key IS NULL THEN a.enviado_ts ELSE '{STAMP}' END AS enviado_ts FROM agenda_n a LEFT JOIN sent s USING ({_PLACE})",
    "agenda_mirror_table": f"{sql_with()}{_NOW}{_MIRROR}",
}
