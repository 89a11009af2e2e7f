"""Queries over a sheet whose cells are of mixed types, and their SQL, which keeps one column for each type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cells as V
from ..sources.sheets import AS_OF, raw, sql_with
from . import dialect as D

QUERIES: dict = {}
SQL: dict[str, str] = {}
c = F.col

# Two cells of a row, each in one of three columns: text, a number, an instant. Half of the second cells say the same as the first.
_T = "CASE WHEN k % 3 = 0 THEN CASE WHEN k % 12 = 0 THEN '  ' WHEN k % 9 = 0 THEN fecha ELSE ' ' || hora || ' ' END END"
_N = "CASE WHEN k % 3 = 1 THEN CASE WHEN k % 15 = 1 THEN CAST(k % 40 AS DOUBLE) ELSE CAST(k % 1013 AS DOUBLE) / 1013 END END"
_I = "CASE WHEN k % 3 = 2 AND k % 21 <> 2 THEN CAST(CAST(d AS STRING) || ' ' || lpad(CAST(k % 24 AS STRING), 2, '0') || ':05:' || lpad(CAST(k % 60 AS STRING), 2, '0') AS {ntz}) END"
_U = "CASE WHEN k % 2 = 0 THEN CASE WHEN k % 15 = 1 THEN CAST(k % 40 AS STRING) ELSE trim(a_text) END WHEN k % 7 = 0 THEN CAST(d AS STRING) END"
_M = "CASE WHEN k % 2 = 0 AND k % 15 <> 1 THEN a_num WHEN k % 2 = 1 AND k % 7 = 1 THEN 1.5 END"
_J = "CASE WHEN k % 2 = 0 AND k % 15 <> 1 THEN a_time WHEN k % 2 = 1 AND k % 7 = 2 THEN a_time + INTERVAL 1 HOUR END"
FORMS = f"SELECT *, {_U} AS b_text, {_M} AS b_num, {_J} AS b_time FROM (SELECT _row, k, d, {_T} AS a_text, {_N} AS a_num, {_I} AS a_time FROM {{raw}})"


def forms(spark, d) -> DataFrame:
    return spark.sql(FORMS.replace("{ntz}", "TIMESTAMP_NTZ"), raw=raw(spark, d))


def sheet(spark, d) -> DataFrame:
    """_row and two cells."""
    return forms(spark, d).select("_row", *[V.cell(*[c(f"{x}_{t}") for t in ("text", "num", "time")]).alias(x) for x in ("a", "b")])


def typed_cells(spark, d):
    """The kind and the text of every cell."""
    return sheet(spark, d).select("_row", V.kind(c("a")).alias("clase"), V.shown(c("a")).alias("texto"))


def typed_hora(spark, d):
    """The time in every cell: of text, of a fraction of a day, of an instant."""
    return sheet(spark, d).select("_row", V.hora(c("a")).alias("hora"), V.hora(c("a"), seconds=False).alias("hora_corta"))


def typed_equal(spark, d):
    """Whether two cells are equal, and whether they say the same day."""
    return sheet(spark, d).select("_row", V.equal(c("a"), c("b")).alias("iguales"), V.same_day(c("a"), c("b"), AS_OF).alias("mismo_dia"))


QUERIES |= {f.__name__: f for f in (typed_cells, typed_hora, typed_equal)}

_FROM = f"{sql_with()}, f AS ({FORMS.replace('{ntz}', 'TIMESTAMP').format(raw='raw')})"
_KIND = lambda x: f"CASE WHEN {x}_time IS NOT NULL THEN 'fecha' WHEN {x}_num IS NOT NULL THEN 'numero' WHEN {D.clean(f'{x}_text')} <> '' THEN 'texto' END"
_SHOWN = lambda x: f"coalesce(strftime({x}_time, '%Y-%m-%d %H:%M:%S'), {D.number_text(f'{x}_num')}, {D.clean(f'{x}_text')})"
_TWO = lambda x: f"lpad(CAST(CAST(floor({x}) AS BIGINT) AS VARCHAR), 2, '0')"
_SEC, _MIN = "floor(a_num * 86400 + 0.5)", "floor(a_num * 1440 + 0.5)"
_DAY = lambda x: f"coalesce(CAST({x}_time AS DATE), {D.date(f'{x}_text')})"
SQL |= {
    "typed_cells": f"{_FROM} SELECT _row, {_KIND('a')} AS clase, {_SHOWN('a')} AS texto FROM f",
    "typed_hora": f"{_FROM} SELECT _row, CASE WHEN a_time IS NOT NULL THEN strftime(a_time, '%H:%M:%S') WHEN a_num IS NOT NULL THEN {_TWO(f'{_SEC} / 3600')} || ':' || {_TWO(f'{_SEC} % 3600 / 60')} || ':' || {_TWO(f'{_SEC} % 60')} ELSE {D.hora('a_text')} END AS hora, "
    f"CASE WHEN a_time IS NOT NULL THEN strftime(a_time, '%H:%M') WHEN a_num IS NOT NULL THEN {_TWO(f'{_MIN} / 60')} || ':' || {_TWO(f'{_MIN} % 60')} ELSE {D.hora('a_text', False)} END AS hora_corta FROM f",
    "typed_equal": f"{_FROM} SELECT _row, CASE WHEN a_time IS NOT NULL AND b_time IS NOT NULL THEN a_time = b_time WHEN a_time IS NOT NULL OR b_time IS NOT NULL THEN false ELSE {_SHOWN('a')} = {_SHOWN('b')} END AS iguales, {_DAY('a')} IS NOT DISTINCT FROM {_DAY('b')} AS mismo_dia FROM f",
}
