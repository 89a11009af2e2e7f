"""Jobs: whole tables in, whole tables or reports out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.dictionaries import CANON, STATUSES
from ..operators import parse
from ..operators import relational as R
from ..operators import steps as S
from ..operators.stage import cut
from ..sources.sheets import AS_OF, raw, sheet, sheet_of, sql_with
from . import dialect as D
from . import relations as Q

QUERIES: dict = {}
SQL: dict[str, str] = {}
c = F.col


def query(name: str, sql: str | None, *sheets: str):
    def put(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = f"{sql_with(*sheets)}{'' if sql.startswith(',') else ' '}{sql}"
        return f

    return put


LAST = lambda n: f", {n}_l AS (SELECT * FROM {n}_k WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row DESC) = 1)"


def last(spark, d, name: str) -> DataFrame:
    return R.keep(Q.keyed(spark, d, name), "key")


@query("sync_b_to_b2", f", b AS (SELECT nullif({D.norm('name')}, '') || '|' || CAST(inscriptos AS VARCHAR) AS key, * FROM raw), f AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row) = 1), t AS (SELECT DISTINCT key FROM b WHERE k % 2 = 0) SELECT f.key, CASE WHEN t.key IS NULL THEN 'insert' ELSE 'refresh' END AS accion, e18, CAST(greatest(0, inscriptos - (e18 + e25 + e40 + e56 + e66)) AS BIGINT) AS sin_identificar, CAST(facebook + google + programmatic AS BIGINT) AS rrss_total FROM f LEFT JOIN t USING (key)")
def sync_b_to_b2(spark, d):
    b = raw(spark, d).withColumn("key", X.key_b(c("name"), c("inscriptos")))
    there = b.where("k % 2 = 0").select("key").distinct().withColumn("there", F.lit(True))
    first = R.keep(b, "key", last=False).join(there, "key", "left")
    ages = c("e18") + c("e25") + c("e40") + c("e56") + c("e66")
    return first.select("key", F.when(c("there").isNull(), "insert").otherwise("refresh").alias("accion"), "e18", F.greatest(F.lit(0), c("inscriptos") - ages).cast("long").alias("sin_identificar"), (c("facebook") + c("google") + c("programmatic")).cast("long").alias("rrss_total"))


@query("sync_a_to_a2", f"{Q.STAGED('raw')}{Q.STAGED('a2')}, e AS (SELECT exact, max(_row) AS by_exact FROM a2_s GROUP BY exact), p AS (SELECT pair, min(_row) AS by_pair FROM a2_s GROUP BY pair HAVING count(*) = 1), m AS (SELECT raw_s.*, coalesce(by_exact, by_pair) AS match FROM raw_s LEFT JOIN e USING (exact) LEFT JOIN p USING (pair)) SELECT 'update' AS accion, match AS _row, arg_max({D.num('asistentes')}, _row) AS asis, arg_max(coalesce({D.time('hora')}, ''), _row) AS hora FROM m WHERE match IS NOT NULL GROUP BY match UNION ALL SELECT 'insert', _row, {D.num('asistentes')}, coalesce({D.time('hora')}, '') FROM m WHERE match IS NULL", "a2")
def sync_a_to_a2(spark, d):
    source = Q._stage(spark, d, "raw_all")
    matched = R.two_stage(source, Q._stage(spark, d, "a2").select("exact", "pair", "_row")).withColumns({"asis": X.num_parse(c("asistentes")), "hh": F.coalesce(X.parse_time_ampm(c("hora")), F.lit(""))})
    update = matched.where("match is not null").groupBy("match").agg(F.max_by("asis", "_row").alias("asis"), F.max_by("hh", "_row").alias("hora"))
    insert = matched.where("match is null").select(F.lit("insert").alias("accion"), "_row", "asis", c("hh").alias("hora"))
    return update.select(F.lit("update").alias("accion"), c("match").alias("_row"), "asis", "hora").unionByName(insert)


@query("sync_a_to_a2_transition", f"{Q.KEYED('raw', 'a2')}{LAST('a2')}, f AS (SELECT * FROM raw_k WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row) = 1) SELECT f.key, a2_l._row FROM f JOIN a2_l USING (key) WHERE {D.status('f.status')} LIKE 'realizad%' AND a2_l.k % 2 = 0", "a2")
def sync_a_to_a2_transition(spark, d):
    """Dormant variant: only rows that were scheduled before and are done now."""
    first = R.keep(Q.keyed(spark, d, "raw_all"), "key", last=False).where(X.status_prefix(c("status")) == "realizada").select("key")
    return first.join(last(spark, d, "a2").where("k % 2 = 0").select("key", "_row"), "key").select("key", "_row")


@query("upsert_base_attendance", f"{Q.KEYED('a2', 'base')}{LAST('base')}, s AS (SELECT key, max(asis) AS top FROM a2_k WHERE asis > 0 GROUP BY key) SELECT base_l._row, greatest(base_l.asis, coalesce(top, 0)) AS asistentes, CASE WHEN top >= base_l.asis THEN 'Realizada' ELSE base_l.status END AS status FROM base_l LEFT JOIN s USING (key)", "a2", "base")
def upsert_base_attendance(spark, d):
    top = Q.keyed(spark, d, "a2").where("asis > 0").groupBy("key").agg(F.max("asis").alias("top"))
    base = last(spark, d, "base").join(top, "key", "left")
    return base.select("_row", F.greatest("asis", F.coalesce("top", F.lit(0.0))).alias("asistentes"), F.when(c("top") >= c("asis"), "Realizada").otherwise(c("status")).alias("status"))


@query("upsert_base_channels", f"{Q.KEYED('b2', 'base')}{LAST('base')}, s AS (SELECT * FROM b2_k WHERE NOT {Q.DONE} AND key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row DESC) = 1) SELECT base_l._row, s.inscriptos, CASE WHEN {D.clean('s.rrss')} <> '' THEN {D.num('s.rrss')} ELSE CAST(s.facebook + s.google + s.programmatic AS DOUBLE) END AS rrss, s.e18 FROM base_l JOIN s USING (key)", "b2", "base")
def upsert_base_channels(spark, d):
    fresh = R.keep(Q.keyed(spark, d, "b2").where(~Q.done()), "key")
    parts = (c("facebook") + c("google") + c("programmatic")).cast("double")
    fresh = fresh.select("key", "inscriptos", X.rrss_fallback(c("rrss"), parts).alias("rrss"), "e18")
    return last(spark, d, "base").select("key", "_row").join(fresh, "key").select("_row", "inscriptos", "rrss", "e18")


@query("fill_if_empty", f"{Q.KEYED('a2', 'base')}{LAST('base')}, s AS (SELECT key, arg_min(asis, _row) AS first_useful FROM a2_k WHERE asis > 0 GROUP BY key) SELECT base_l._row, CASE WHEN base_l.asis = 0 THEN coalesce(first_useful, 0) ELSE base_l.asis END AS asis FROM base_l LEFT JOIN s USING (key)", "a2", "base")
def fill_if_empty(spark, d):
    first = Q.keyed(spark, d, "a2").where("asis > 0").groupBy("key").agg(F.min_by("asis", "_row").alias("useful"))
    return last(spark, d, "base").join(first, "key", "left").select("_row", F.when(c("asis") == 0, F.coalesce("useful", F.lit(0.0))).otherwise(c("asis")).alias("asis"))


_SOURCE = f"CASE WHEN {D.clean('barrio_manual')} <> '' THEN barrio_manual ELSE barrio END"


@query("fill_barrion", f"SELECT _row, CASE WHEN {D.clean(_SOURCE)} = '' THEN {D.barrio_keep('barrio')} ELSE {D.barrio_title(_SOURCE)} END AS barrion FROM b2", "b2")
def fill_barrion(spark, d):
    source = F.coalesce(X.blank_null(c("barrio_manual")), X.blank_null(c("barrio")))
    return sheet(spark, d, "b2").select("_row", F.when(source.isNull(), X.barrio_canon(c("barrio"))).otherwise(X.barrio_canon_title(source)).alias("barrion"))


@query("backfill_ages_b2", f", b AS (SELECT nullif({D.norm('name')}, '') || '|' || CAST(inscriptos AS VARCHAR) AS key, _row, e18, e25, e40, e56, e66 FROM raw), l AS (SELECT * FROM b WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row DESC) = 1) SELECT t._row, l.e18, l.e25, l.e40, l.e56, l.e66 FROM (SELECT *, nullif({D.norm('figura')}, '') || '|' || CAST(inscriptos AS VARCHAR) AS key FROM b2) t JOIN l USING (key)", "b2")
def backfill_ages_b2(spark, d):
    source = raw(spark, d).select(X.key_b(c("name"), c("inscriptos")).alias("key"), "_row", *S.AGES)
    found = R.keep(source, "key").select("key", *S.AGES)
    return sheet(spark, d, "b2").select("_row", X.key_b(c("figura"), c("inscriptos")).alias("key")).join(found, "key").select("_row", *S.AGES)


_AGES = [f"b2_l.{x}" for x in S.AGES]
_SUM = "(" + " + ".join(_AGES) + ")"


@query("backfill_ages_base", f"{Q.KEYED('b2', 'base')}{LAST('base')}{LAST('b2')} SELECT base_l._row, {', '.join(_AGES)}, CAST(CASE WHEN b2_l.e66 = 0 AND b2_l.inscriptos > 0 AND {_SUM} > 0 THEN greatest(0, b2_l.inscriptos - {_SUM}) ELSE b2_l.e66 END AS BIGINT) AS sin FROM base_l JOIN b2_l USING (key)", "b2", "base")
def backfill_ages_base(spark, d):
    ages = sum((c(x) for x in S.AGES[1:]), c(S.AGES[0]))
    sin = F.when((c("e66") == 0) & (c("inscriptos") > 0) & (ages > 0), F.greatest(F.lit(0), c("inscriptos") - ages)).otherwise(c("e66")).cast("long")
    return last(spark, d, "base").select("key", "_row").join(last(spark, d, "b2").select("key", *S.AGES, sin.alias("sin")), "key").select("_row", *S.AGES, "sin")


def _missing(a: str, b: str):
    def f(spark, d):
        other = Q.keyed(spark, d, b).where("key is not null").select("key").distinct()
        return last(spark, d, a).join(other, "key", "left_anti").select("key", "_row", "figura", "barrio", "inscriptos")

    return f


for _a, _b in (("a2", "b2"), ("b2", "a2")):
    query(f"missing_in_{_b}", f"{Q.KEYED('a2', 'b2')}{LAST(_a)} SELECT key, _row, figura, barrio, inscriptos FROM {_a}_l WHERE key NOT IN (SELECT key FROM {_b}_k WHERE key IS NOT NULL)", "a2", "b2")(_missing(_a, _b))


_FIRST = ", base_f AS (SELECT * FROM base_k WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row) = 1)"
_CANON_SQL = ", ".join(map(D.quoted, CANON))
_STATUS_SQL = ", ".join(map(D.quoted, STATUSES))


#: Fields that the validator compares: name, column, as numbers.
_A2_FIELDS = [("Figura", "figura", False), ("Barrio", "barrio", False), ("HORA", "hora", False), ("Dirección", "direccion", False), ("Asistentes", "asistentes", True)]
_B2_FIELDS = [("Inscriptos", "inscriptos", True), ("Mail", "mail", True), ("Call Center", "callc", True), ("IVR", "ivr", True), ("RRSS", "rrss", True), ("Difusión", "difusion", True), ("Maculinos", "ins_m", True), ("Femeninos", "ins_f", True)]
_CHECKED = list(dict.fromkeys(x for _, x, _ in _A2_FIELDS + _B2_FIELDS))
_text = lambda x, numeric: D.number_text(D.num(x)) if numeric else D.clean(x)
_ROWS = ", ".join(f"{_text(x, n)} AS {x}" for _, x, n in _A2_FIELDS + _B2_FIELDS)
_MAPPED = f", {D.map_status('status')} AS mapped, {D.clean('status')} AS estado"


def _diffs(side: str, fields) -> str:
    return "".join(f" UNION ALL SELECT '{side}', CAST(_row AS VARCHAR), key, 'DIFERENCIA', '{campo}', {x}, b_{x} FROM j_{side} WHERE bkey IS NOT NULL AND {x} <> b_{x}" for campo, x, _ in fields)


_ONE_SIDE = lambda n, side: (
    f" SELECT '{side}' AS origen, CAST(_row AS VARCHAR) AS fila, key, 'FALTA EN BASE FINAL' AS tipo, '' AS campo, '' AS valor_origen, '' AS valor_base FROM j_{side} WHERE bkey IS NULL"
    f" UNION ALL SELECT '{side}', CAST(_row AS VARCHAR), key, 'BARRIO NO CANÓNICO', 'Barrio', barrio, '' FROM j_{side} WHERE bkey IS NOT NULL AND barrio NOT IN ({_CANON_SQL})"
)
_BASE_SIDE = "".join(f", {x} AS b_{x}" for x in _CHECKED)


@query("validate_findings", f"{Q.KEYED('a2', 'base', 'b2')}" + "".join(f", {n}_t AS (SELECT _row, key, {_ROWS}{_MAPPED} FROM {n}_k WHERE key IS NOT NULL)" for n in ("a2", "b2", "base"))
    + f", hit AS (SELECT key AS bkey, _row AS b_row, estado AS b_estado{_BASE_SIDE} FROM base_t QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row) = 1), j_A2 AS (SELECT * FROM a2_t LEFT JOIN hit ON key = bkey), j_B2 AS (SELECT * FROM b2_t LEFT JOIN hit ON key = bkey)"
    + f", orphan AS (SELECT * FROM hit WHERE bkey NOT IN (SELECT key FROM a2_t) AND bkey NOT IN (SELECT key FROM b2_t))"
    + _ONE_SIDE("a2", "A2") + _diffs("A2", _A2_FIELDS) + " UNION ALL SELECT 'A2', CAST(_row AS VARCHAR), key, 'DIFERENCIA', 'STATUS REUNIÓN', mapped, b_estado FROM j_A2 WHERE bkey IS NOT NULL AND mapped <> b_estado"
    + f" UNION ALL SELECT 'BaseFinal', CAST(b_row AS VARCHAR), key, 'STATUS NO PERMITIDO', 'STATUS REUNIÓN', '', b_estado FROM j_A2 WHERE b_estado <> '' AND b_estado NOT IN ({_STATUS_SQL})"
    + " UNION ALL" + _ONE_SIDE("b2", "B2") + _diffs("B2", _B2_FIELDS)
    + " UNION ALL SELECT 'BaseFinal', string_agg(CAST(_row AS VARCHAR), ',' ORDER BY _row), key, 'DUPLICADO EN BASE FINAL', '', '', '' FROM base_t GROUP BY key HAVING count(*) > 1"
    + " UNION ALL SELECT 'BaseFinal', CAST(b_row AS VARCHAR), bkey, 'ORPHAN EN BASE FINAL', '', '', '' FROM orphan"
    + f" UNION ALL SELECT 'BaseFinal', CAST(b_row AS VARCHAR), bkey, 'BARRIO NO CANÓNICO', 'Barrio', b_barrio, '' FROM orphan WHERE b_barrio <> '' AND b_barrio NOT IN ({_CANON_SQL})"
    + f" UNION ALL SELECT 'BaseFinal', CAST(b_row AS VARCHAR), bkey, 'STATUS NO PERMITIDO', 'STATUS REUNIÓN', '', b_estado FROM orphan WHERE b_estado <> '' AND b_estado NOT IN ({_STATUS_SQL})", "a2", "b2", "base")
def validate_findings(spark, d):
    """The source is written once, and so is each sheet with its key. Source rows meet the first base row of their key in a left join, whose hot keys Spark
    can split; base rows of no source are found by an anti join on keys, and rows are listed for keys that repeat only."""
    fields = _A2_FIELDS + _B2_FIELDS
    source = cut(raw(spark, d))
    whole = {f.name for f in source.schema if f.dataType.simpleString() in ("int", "bigint")}  # need no parsing
    cell = lambda x, numeric: c(x).cast("string") if x in whole else X.number_text(c(f"{x}_n")) if numeric else X.str_clean(c(x))

    def rows(name: str, own) -> DataFrame:
        dated = sheet_of(source, name).withColumns({"fecha_d": X.parse_date_lenient(c("fecha"), AS_OF), **{f"{x}_n": X.num_parse(c(x)) for f, x, n in own if n and x not in whole}})
        texts = F.array(*[cell(x, n) if (f, x, n) in own else F.lit(None).cast("string") for f, x, n in fields])
        keyed = S.with_key(dated).select("key", "_row", X.str_clean(c("barrio")).alias("barrio"), texts.alias("texts"), X.map_status(c("status")).alias("mapped"), X.str_clean(c("status")).alias("estado"))
        return cut(keyed.where("key is not null"))

    a2, b2, base = rows("a2", _A2_FIELDS), rows("b2", _B2_FIELDS), rows("base", fields)
    ends = cut(base.groupBy("key").agg(F.min("_row").alias("_row"), F.count("*").alias("veces")))
    hits = base.join(ends.select("key", "_row"), ["key", "_row"], "left_semi").select("key", F.struct("_row", "barrio", "texts", "estado").alias("hit"))
    sides = a2.withColumn("side", F.lit("A2")).unionByName(b2.withColumn("side", F.lit("B2")))
    both = sides.join(hits, "key", "left")
    there, own, its = c("hit").isNotNull(), c("_row").cast("string"), c("hit._row").cast("string")

    def finding(cond, tipo, campo="", value=F.lit(""), base_value=F.lit(""), origen=None, fila=own):
        said = F.struct((F.lit(origen) if origen else c("side")).alias("origen"), fila.alias("fila"), F.lit(tipo).alias("tipo"), F.lit(campo).alias("campo"), value.alias("valor_origen"), base_value.alias("valor_base"))
        return F.when(cond, said)

    def differs(campo, i):
        x, y = F.get("texts", i), F.get("hit.texts", i)  # a field of the other sheet is null, and so differs from nothing
        return F.when(there & (x != y), F.struct(c("side").alias("origen"), own.alias("fila"), F.lit("DIFERENCIA").alias("tipo"), campo.alias("campo"), x.alias("valor_origen"), y.alias("valor_base")))

    estado, barrio = c("hit.estado"), c("hit.barrio")
    forbidden = (estado != "") & ~estado.isin(STATUSES)
    status = lambda cond: finding(cond & forbidden, "STATUS NO PERMITIDO", "STATUS REUNIÓN", base_value=estado, origen="BaseFinal", fila=its)
    checks = F.array(
        finding(~there, "FALTA EN BASE FINAL"), finding(there & ~c("barrio").isin(CANON), "BARRIO NO CANÓNICO", "Barrio", c("barrio")),
        finding(there & (c("side") == "A2") & (c("mapped") != estado), "DIFERENCIA", "STATUS REUNIÓN", c("mapped"), estado), status(c("side") == "A2"),
    )
    compared = F.transform(F.array(*[F.lit(f) for f, _, _ in fields]), differs)
    told = lambda df, found: df.select("key", F.explode(F.array_compact(found)).alias("f")).select("f.origen", "f.fila", "key", "f.tipo", "f.campo", "f.valor_origen", "f.valor_base")
    orphans = hits.join(sides.select("key"), "key", "left_anti")
    alone = F.array(finding(F.lit(True), "ORPHAN EN BASE FINAL", origen="BaseFinal", fila=its), finding((barrio != "") & ~barrio.isin(CANON), "BARRIO NO CANÓNICO", "Barrio", barrio, origen="BaseFinal", fila=its), status(F.lit(True)))
    filas = F.array_join(F.transform(F.sort_array(F.collect_list("_row")), lambda r: r.cast("string")), ",").alias("fila")
    again = base.select("key", "_row").join(ends.where("veces > 1").select("key"), "key", "left_semi").groupBy("key").agg(filas)
    again = again.select(F.lit("BaseFinal").alias("origen"), "fila", "key", F.lit("DUPLICADO EN BASE FINAL").alias("tipo"), *[F.lit("").alias(x) for x in ("campo", "valor_origen", "valor_base")])
    return told(both, F.concat(checks, compared)).unionByName(told(orphans, alone)).unionByName(again)


@query("findings_union", f"{Q.KEYED('a2', 'b2')} SELECT 'A2' AS origen, _row FROM a2_k WHERE key IS NULL UNION ALL SELECT 'B2', _row FROM b2_k WHERE key IS NULL", "a2", "b2")
def findings_union(spark, d):
    part = lambda n: Q.keyed(spark, d, n).where("key is null").select(F.lit(n.upper()).alias("origen"), "_row")
    return part("a2").unionByName(part("b2"))


# Two-way sync: which cell is filled from which side. A formula in a cell of the user's table protects it.
_RULE = "CASE WHEN u = p THEN NULL WHEN u = '' AND col = 'status' THEN 'NO se rellena usuario (bloqueada)' WHEN u = '' AND formula THEN 'NO se rellena usuario (tiene fórmula)' WHEN u = '' THEN 'Relleno usuario desde Para Revisar' WHEN p = '' AND {num} THEN 'NO se rellena Para Revisar (numérico)' WHEN p = '' THEN 'Relleno Para Revisar desde usuario' ELSE 'Diferencia' END"
_SYNC = f"{Q.KEYED('rvd', 'base')}{LAST('rvd')}{LAST('base')}, cells AS (" + " UNION ALL ".join(f"SELECT u.key, '{x}' AS col, trim(u.{x}) AS u, trim(p.{x}) AS p, (u._row, '{x}') IN (SELECT (_row, col) FROM rvd_formulas) AS formula FROM rvd_l u JOIN base_l p USING (key)" for x in Q.CELLS) + "), acted AS (SELECT *, " + _RULE.format(num=f"regexp_matches({D.comma('u')}, '{D.NUMBER}')") + " AS tipo FROM cells)"
_ONLY = " UNION ALL SELECT key, '' AS col, 'Solo en usuario → agregado a Para Revisar' FROM rvd_l WHERE key NOT IN (SELECT key FROM base_l) UNION ALL SELECT key, '', 'Solo en Para Revisar' FROM base_l WHERE key NOT IN (SELECT key FROM rvd_l)"


def synced(spark, d) -> DataFrame:
    """key, col, u, p, tipo of each cell of the keys on both sides, and one row without cell for each other key; from one full outer join."""
    last_of = lambda n: R.keep(Q.keyed(spark, d, n).select("key", "_row", *Q.CELLS), "key")
    user = S.with_formulas(last_of("rvd"), sheet(spark, d, "rvd_formulas")).select("key", F.struct(*Q.CELLS, "formulas").alias("u"))
    base = last_of("base").select("key", F.struct(*Q.CELLS).alias("p"))
    text = lambda x: F.trim(F.coalesce(c(x), F.lit("")))
    cell = lambda x, u, p, formula: F.struct(F.lit(x).alias("col"), u.alias("u"), p.alias("p"), formula.alias("formula"))
    cells = F.array(*[cell(x, text(f"u.{x}"), text(f"p.{x}"), F.coalesce(F.array_contains("u.formulas", x), F.lit(False))) for x in Q.CELLS])
    none = F.array(cell("", F.lit(""), F.lit(""), F.lit(False)))
    both = user.join(base, "key", "full_outer")
    rows = both.select("key", c("u").isNull().alias("no_u"), c("p").isNull().alias("no_p"), F.explode(F.when(c("u").isNull() | c("p").isNull(), none).otherwise(cells)).alias("x"))
    rule = F.expr(_RULE.format(num="numeric"))
    tipo = F.when(c("no_p"), "Solo en usuario → agregado a Para Revisar").when(c("no_u"), "Solo en Para Revisar").otherwise(rule)
    return rows.select("key", "x.*", "no_u", "no_p").withColumn("numeric", X.numeric_like(c("u"))).select("key", "col", "u", "p", tipo.alias("tipo"))


@query("two_way_sync_log", f"{_SYNC} SELECT key, col, tipo FROM acted WHERE tipo IS NOT NULL{_ONLY}", "rvd", "base", "rvd_formulas")
def two_way_sync_log(spark, d):
    return synced(spark, d).where("tipo is not null").select("key", "col", "tipo")


@query("two_way_sync_result", f"{_SYNC} SELECT key, col, CASE WHEN tipo = 'Relleno usuario desde Para Revisar' THEN p ELSE u END AS usuario, CASE WHEN tipo = 'Relleno Para Revisar desde usuario' THEN u ELSE p END AS para_revisar FROM acted", "rvd", "base", "rvd_formulas")
def two_way_sync_result(spark, d):
    acted = synced(spark, d).where("col != ''")
    return acted.select("key", "col", F.when(c("tipo") == "Relleno usuario desde Para Revisar", c("p")).otherwise(c("u")).alias("usuario"), F.when(c("tipo") == "Relleno Para Revisar desde usuario", c("u")).otherwise(c("p")).alias("para_revisar"))


@query("sync_counters", f"{_SYNC}, l AS (SELECT key, col, tipo FROM acted WHERE tipo IS NOT NULL{_ONLY}) SELECT tipo, count(*) AS n FROM l GROUP BY tipo", "rvd", "base", "rvd_formulas")
def sync_counters(spark, d):
    return two_way_sync_log(spark, d).groupBy("tipo").agg(F.count("*").alias("n"))


# Agenda


_AUTO = f"coalesce(nullif({D.clean('barrio_manual')}, ''), nullif({D.clean('barrio')}, ''))"


@query("agenda_push", f"{Q.KEYED('base')}, r AS (SELECT _row, {D.clean('figura')} AS figura, {D.barrio_keep(_AUTO)} AS barrio, {D.date('fecha')} AS fecha, {D.hora('hora')} AS hora FROM raw WHERE k % 2 = 0 AND k % 3 <> 0), q AS (SELECT *, nullif({D.norm('figura')}, '') || '|' || nullif({D.norm('barrio')}, '') || '|' || {D.ymd('fecha')} AS key FROM r), l AS (SELECT key, arg_max(hora, _row) AS hora, concat_ws(' - ', arg_max(figura, _row), arg_max(barrio, _row), strftime(arg_max(fecha, _row), '%d/%m/%Y')) AS id FROM q WHERE key IS NOT NULL GROUP BY key) SELECT key, id, hora, CASE WHEN key IN (SELECT key FROM base_k WHERE key IS NOT NULL) THEN 'UPDATE' ELSE 'INSERT' END AS accion FROM l", "base")
def agenda_push(spark, d):
    barrio = X.barrio_canon(F.coalesce(X.blank_null(c("barrio_manual")), X.blank_null(c("barrio"))))
    ready = raw(spark, d).where("k % 2 = 0 and k % 3 <> 0").select("_row", X.str_clean(c("figura")).alias("figura"), barrio.alias("barrio"), X.parse_date_lenient(c("fecha"), AS_OF).alias("fecha"), X.format_hora(c("hora")).alias("hora"))
    ready = R.keep(ready.withColumn("key", X.key_fbf(c("figura"), c("barrio"), c("fecha"))), "key")
    base = Q.keyed(spark, d, "base").where("key is not null").select("key").distinct().withColumn("there", F.lit(True))
    return ready.join(base, "key", "left").select("key", F.concat_ws(" - ", "figura", "barrio", X.dmy(c("fecha"))).alias("id"), "hora", F.when(c("there"), "UPDATE").otherwise("INSERT").alias("accion"))


@query("agenda_mirror", f"SELECT _row, {D.clean('figura')} AS figura, coalesce(nullif({D.barrio_blank('barrio_manual')}, ''), nullif({D.barrio_blank('barrio')}, ''), '') AS barrio, {D.date('fecha')} AS fecha, 'en agenda' AS status FROM raw WHERE {D.clean('figura')} <> '' AND {D.date('fecha')} IS NOT NULL ORDER BY fecha, _row")
def agenda_mirror(spark, d):
    blank = lambda x: F.nullif(X.barrio_canon(c(x), "blank"), F.lit(""))
    rows = raw(spark, d).select("_row", X.str_clean(c("figura")).alias("figura"), F.coalesce(blank("barrio_manual"), blank("barrio"), F.lit("")).alias("barrio"), X.parse_date_lenient(c("fecha"), AS_OF).alias("fecha"), F.lit("en agenda").alias("status"))
    return rows.where("figura != '' and fecha is not null").orderBy("fecha", "_row")


_MAIL = """SELECT _row AS msg, 'Lunes ' || CAST(day(d) AS STRING) || '/' || CAST(month(d) AS STRING) || chr(10) || 'Evento: Encuentro con vecinos ' || name || ' (sala), ' || CASE WHEN k % 7 = 0 THEN 'NO PARTICIPA' ELSE barrio || ' centro' END || chr(10) || 'Hora: 9:15h' || chr(10) || 'HORA: ' || CAST(k % 12 + 8 AS STRING) || ':30h' || chr(10) || 'Lugar: ' || CASE WHEN k % 3 = 0 THEN 'A confirmar' ELSE 'Calle ' || CAST(k AS STRING) END AS body, name, barrio, d, k FROM {raw}"""


def mails(spark, d) -> DataFrame:
    return spark.sql(_MAIL, raw=raw(spark, d))


@query("parse_agenda", f", m AS ({_MAIL.format(raw='raw')}) SELECT msg, name AS persona, trim(barrio || ' centro') AS barrio, make_date({AS_OF[:4]}, 1, 1) + to_months(CAST(month(d) AS INT) - 1) + to_days(CAST(day(d) AS INT) - 1) AS ts, CAST(k % 12 + 8 AS VARCHAR) || ':30' AS hora, CASE WHEN k % 3 = 0 THEN '' ELSE 'Calle ' || CAST(k AS VARCHAR) END AS direccion FROM m WHERE k % 7 <> 0".replace(" AS ts,", " AS fecha_ts,"))
def parse_agenda(spark, d):
    events = parse.agenda(mails(spark, d), "msg", "body", AS_OF)
    return events.select("msg", "persona", "barrio", c("fecha").cast("timestamp_ntz").alias("fecha_ts"), "hora", "direccion")


def base_updates(spark, d) -> DataFrame:
    """What attendance and channels change in each keyed base row."""
    attendance, channels = upsert_base_attendance(spark, d), upsert_base_channels(spark, d)
    return attendance.join(channels, "_row", "left").select("_row", "asistentes", "status", "inscriptos", "rrss", "e18")


QUERIES["base_updates"] = base_updates
SQL["base_updates"] = f"WITH a AS ({SQL['upsert_base_attendance']}), b AS ({SQL['upsert_base_channels']}) SELECT a._row, asistentes, status, inscriptos, rrss, e18 FROM a LEFT JOIN b USING (_row)"
