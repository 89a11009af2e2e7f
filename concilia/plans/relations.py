"""Queries for sources, filters, joins, duplicates, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..functions.dictionaries import CANON
from ..operators import relational as R
from ..sources.sheets import AS_OF, raw, sheet, sql_with, table
from . import dialect as D

QUERIES: dict = {}
SQL: dict[str, str] = {}
c = F.col


def query(name: str, sql: str | None, *sheets: str):
    """Register a function as a query; its SQL follows the WITH clause of the sheets it names."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = f"{sql_with(*sheets)}{sql}" if sql.startswith(",") else f"{sql_with(*sheets)} {sql}"
        return f

    return put


def keyed(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A sheet with its key, date and number of attendees."""
    dated = sheet(spark, d, name).withColumn("fecha_d", X.parse_date_lenient(c("fecha"), AS_OF))
    return dated.withColumns({"key": X.key_fbf(c("figura"), c("barrio"), c("fecha_d")), "asis": X.num_parse(c("asistentes"))})


KEYED = lambda *names: "".join(f", {n}_k AS (SELECT *, {D.date('fecha')} AS fecha_d, {D.fbf()} AS key, {D.num('asistentes')} AS asis FROM {n})" for n in names)
DONE = "(lower(procesado) = 'true' OR trim(procesado) = '1')"


def done():
    return (F.lower("procesado") == "true") | (F.trim("procesado") == "1")


@query("scan_sheet", "SELECT _row, figura, barrio, fecha, hora FROM a2", "a2")
def scan_sheet(spark, d):
    return sheet(spark, d, "a2").select("_row", "figura", "barrio", "fecha", "hora")


@query("row_lookup", "SELECT _row, figura, barrio FROM a2 WHERE _row = 142", "a2")
def row_lookup(spark, d):
    return sheet(spark, d, "a2").where("_row = 142").select("_row", "figura", "barrio")


QUERIES["latest_message_per_thread"] = lambda spark, d: table(spark, d, "conversations").groupBy("conv_id").agg(F.max("turn").alias("turn"), F.max_by("text", "turn").alias("text"))
SQL["latest_message_per_thread"] = "SELECT conv_id, turn, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1"


@query("mail_recent_threads", f"SELECT _row, status, d FROM raw WHERE contains(lower(status), 'agenda') AND d >= DATE '{AS_OF}' - 21 AND d <= DATE '{AS_OF}'")
def mail_recent_threads(spark, d):
    day = F.lit(AS_OF).cast("date")
    return raw(spark, d).where(F.lower("status").contains("agenda") & (c("d") >= F.date_sub(day, 21)) & (c("d") <= day)).select("_row", "status", "d")


@query("ensure_columns", "SELECT _row, barrio, CAST(NULL AS VARCHAR) AS \"BarrioN\" FROM a2", "a2")
def ensure_columns(spark, d):
    return R.ensure_columns(sheet(spark, d, "a2").select("_row", "barrio"), ["Barrio", "BarrioN"])


@query("alias_projection", "SELECT _row, figura AS value, CAST(NULL AS VARCHAR) AS missing FROM a2", "a2")
def alias_projection(spark, d):
    df = sheet(spark, d, "a2").withColumnRenamed("figura", ' "Figurá" ')
    return df.select("_row", R.resolve(df, ["persona", "figura"]).alias("value"), R.resolve(df, ["provincia"], optional=True).alias("missing"))


@query("ready_not_sent", "SELECT _row FROM raw WHERE k % 2 = 0 AND NOT (k % 3 = 0)")
def ready_not_sent(spark, d):
    ready, sent = F.when(c("k") % 2 == 0, True), F.when(c("k") % 3 == 0, True)
    return raw(spark, d).where(ready.eqNullSafe(True) & ~F.coalesce(sent, F.lit(False))).select("_row")


@query("unprocessed_rows", f"SELECT _row, procesado FROM b2 WHERE NOT {DONE}", "b2")
def unprocessed_rows(spark, d):
    return sheet(spark, d, "b2").where(~F.coalesce(done(), F.lit(False))).select("_row", "procesado")


@query("future_events", f"SELECT _row, d FROM raw WHERE d >= DATE '{AS_OF}'")
def future_events(spark, d):
    return raw(spark, d).where(c("d") >= F.lit(AS_OF).cast("date")).select("_row", "d")


@query("archive_split", f"SELECT _row, coalesce({D.date('fecha')} < CAST(date_trunc('week', DATE '{AS_OF}') AS DATE) - 3, false) AS archived FROM raw")
def archive_split(spark, d):
    old = X.parse_date_lenient(c("fecha"), AS_OF) < F.date_sub(X.monday(AS_OF), 3)
    return raw(spark, d).select("_row", F.coalesce(old, F.lit(False)).alias("archived"))


@query("status_flip", rf"SELECT _row, CASE WHEN {D.status('status')} = 'en agenda' AND coalesce(TRY_CAST(regexp_extract({D.comma('asistentes')}, '^\s*([+-]?[0-9]+(?:\.[0-9]+)?)', 1) AS DOUBLE), 0) >= 1 THEN 'Realizada' ELSE status END AS status FROM base", "base")
def status_flip(spark, d):
    flip = (X.normalize_status(c("status")) == "en agenda") & (X.num_prefix_parse(c("asistentes")) >= 1)
    return sheet(spark, d, "base").select("_row", F.when(flip, "Realizada").otherwise(c("status")).alias("status"))


@query("not_in_canon", f"SELECT _row, barrio FROM base WHERE barrio NOT IN ({', '.join(map(D.quoted, CANON))})", "base")
def not_in_canon(spark, d):
    return sheet(spark, d, "base").where(~c("barrio").isin(CANON)).select("_row", "barrio")


@query("dedup_keep_last", f"{KEYED('base')} SELECT key, max(_row) AS _row FROM base_k WHERE key IS NOT NULL GROUP BY key", "base")
def dedup_keep_last(spark, d):
    return R.keep(keyed(spark, d, "base").select("key", "_row", "asis"), "key").select("key", "_row")


@query("dedup_keep_first", f"{KEYED('base')} SELECT key, arg_min(asis, _row) AS asis FROM base_k WHERE key IS NOT NULL GROUP BY key", "base")
def dedup_keep_first(spark, d):
    return R.keep(keyed(spark, d, "base").select("key", "_row", "asis"), "key", last=False).select("key", "asis")


@query("join_last_wins", f"{KEYED('a2', 'base')}, l AS (SELECT key, max(_row) AS base_row, arg_max(status, _row) AS base_status FROM base_k WHERE key IS NOT NULL GROUP BY key) SELECT a2_k._row, key, base_row, base_status FROM a2_k JOIN l USING (key)", "a2", "base")
def join_last_wins(spark, d):
    last = R.keep(keyed(spark, d, "base").select("key", "_row", "status"), "key").select("key", c("_row").alias("base_row"), c("status").alias("base_status"))
    return keyed(spark, d, "a2").join(last, "key").select("_row", "key", "base_row", "base_status")


@query("key_match_report", f"{KEYED('a2', 'b2', 'base')}, l AS (SELECT key, max(_row) AS fila_base FROM base_k WHERE key IS NOT NULL GROUP BY key), s AS (SELECT 'A2' AS origen, _row, key FROM a2_k UNION ALL SELECT 'B2', _row, key FROM b2_k) SELECT origen, _row, s.key AS clave, CASE WHEN fila_base IS NULL THEN 'No' ELSE 'Sí' END AS match, fila_base FROM s LEFT JOIN l USING (key)", "a2", "b2", "base")
def key_match_report(spark, d):
    last = R.keep(keyed(spark, d, "base").select("key", "_row"), "key").select("key", c("_row").alias("fila_base"))
    both = keyed(spark, d, "a2").select(F.lit("A2").alias("origen"), "_row", "key").unionByName(keyed(spark, d, "b2").select(F.lit("B2").alias("origen"), "_row", "key"))
    return both.join(last, "key", "left").select("origen", "_row", c("key").alias("clave"), F.when(c("fila_base").isNull(), "No").otherwise("Sí").alias("match"), "fila_base")


@query("anti_both_ways", f"{KEYED('a2', 'b2')} SELECT DISTINCT 'A2' AS solo_en, key FROM a2_k ANTI JOIN b2_k USING (key) WHERE key IS NOT NULL UNION ALL SELECT DISTINCT 'B2', key FROM b2_k ANTI JOIN a2_k USING (key) WHERE key IS NOT NULL", "a2", "b2")
def anti_both_ways(spark, d):
    a, b = (keyed(spark, d, n).where("key is not null").select("key").distinct() for n in ("a2", "b2"))
    return a.join(b, "key", "left_anti").select(F.lit("A2").alias("solo_en"), "key").union(b.join(a, "key", "left_anti").select(F.lit("B2").alias("solo_en"), "key"))


@query("key_set_ops", f"{KEYED('a2', 'b2')}, a AS (SELECT DISTINCT key FROM a2_k WHERE key IS NOT NULL), b AS (SELECT DISTINCT key FROM b2_k WHERE key IS NOT NULL) SELECT 'intersect' AS op, key FROM a WHERE key IN (SELECT key FROM b) UNION ALL SELECT 'union', key FROM (SELECT key FROM a UNION SELECT key FROM b)", "a2", "b2")
def key_set_ops(spark, d):
    a, b = (keyed(spark, d, n).where("key is not null").select("key").distinct() for n in ("a2", "b2"))
    return a.join(b, "key", "left_semi").select(F.lit("intersect").alias("op"), "key").union(a.union(b).distinct().select(F.lit("union").alias("op"), "key"))


def _orphans(name: str):
    def f(spark, d):
        base = keyed(spark, d, "base").where("key is not null").select("key").distinct()
        return keyed(spark, d, name).where("key is not null").join(base, "key", "left_anti").select("_row", "key", "figura", "barrio", X.ymd(c("fecha_d")).alias("ymd"), "asis")

    return f


for _n in ("a2", "b2"):
    query(f"orphans_{_n}", f"{KEYED(_n, 'base')} SELECT _row, key, figura, barrio, {D.ymd('fecha_d')} AS ymd, asis FROM {_n}_k WHERE key IS NOT NULL AND key NOT IN (SELECT key FROM base_k WHERE key IS NOT NULL)", _n, "base")(_orphans(_n))


@query("base_orphans", f"{KEYED('a2', 'b2', 'base')} SELECT key, min(_row) AS _row FROM base_k WHERE key IS NOT NULL AND key NOT IN (SELECT key FROM a2_k WHERE key IS NOT NULL UNION SELECT key FROM b2_k WHERE key IS NOT NULL) GROUP BY key", "a2", "b2", "base")
def base_orphans(spark, d):
    sources = keyed(spark, d, "a2").select("key").union(keyed(spark, d, "b2").select("key")).where("key is not null").distinct()
    first = R.keep(keyed(spark, d, "base").select("key", "_row"), "key", last=False)
    return first.join(sources, "key", "left_anti").select("key", "_row")


@query("full_outer_classify", f"{KEYED('rvd', 'base')}, u AS (SELECT DISTINCT key FROM rvd_k WHERE key IS NOT NULL), p AS (SELECT DISTINCT key FROM base_k WHERE key IS NOT NULL) SELECT coalesce(u.key, p.key) AS key, CASE WHEN p.key IS NULL THEN 'onlyUser' WHEN u.key IS NULL THEN 'onlyPR' ELSE 'inBoth' END AS side FROM u FULL JOIN p ON u.key = p.key", "rvd", "base")
def full_outer_classify(spark, d):
    u, p = (keyed(spark, d, n).where("key is not null") for n in ("rvd", "base"))
    return R.full_outer(u, p, "key", ("onlyUser", "onlyPR", "inBoth"))


def _stage(spark, d, name: str) -> DataFrame:
    fecha, hora = X.parse_date_lenient(c("fecha"), AS_OF), X.parse_time_ampm(c("hora"))
    figura = X.sanitize_figura(c("figura"))
    return sheet(spark, d, name).withColumns({"exact": X.key_a(figura, fecha, hora), "pair": X.key_a(figura, fecha)})


_F = D.norm(D.clean("split_part(figura, '&', 1)"))
_PAIR = f"{_F} || '|' || coalesce({D.ymd(D.date('fecha'))}, '')"
STAGED = lambda n: f", {n}_s AS (SELECT *, {_PAIR} AS pair, {_PAIR} || '|' || coalesce({D.time('hora')}, '') AS exact FROM {n})"


@query("two_stage_match", f"{STAGED('b2')}{STAGED('a2')}, e AS (SELECT exact, max(_row) AS by_exact FROM a2_s GROUP BY exact), p AS (SELECT pair, min(_row) AS by_pair FROM a2_s GROUP BY pair HAVING count(*) = 1) SELECT b2_s._row, coalesce(by_exact, by_pair) AS match FROM b2_s LEFT JOIN e USING (exact) LEFT JOIN p USING (pair)", "a2", "b2")
def two_stage_match(spark, d):
    return R.two_stage(_stage(spark, d, "b2"), _stage(spark, d, "a2").select("exact", "pair", "_row")).select("_row", "match")


@query("lookup_fill", f", t AS (SELECT _row, k, nullif({D.norm('name')}, '') || '|' || {D.ymd('d')} AS pf, CASE WHEN k % 2 = 0 THEN '' ELSE barrio END AS barrio FROM a2), l AS (SELECT nullif({D.norm('name')}, '') || '|' || {D.ymd('d')} AS pf, arg_max(barrio, _row) AS found FROM base GROUP BY 1) SELECT _row, CASE WHEN t.barrio = '' THEN coalesce(found, '') ELSE t.barrio END AS barrio FROM t LEFT JOIN l USING (pf)", "a2", "base")
def lookup_fill(spark, d):
    pf = F.concat(F.nullif(X.normalize_text(c("name")), F.lit("")), F.lit("|"), X.ymd(c("d")))
    found = R.keep(sheet(spark, d, "base").select("_row", "barrio", pf.alias("pf")), "pf").select("pf", c("barrio").alias("found"))
    target = sheet(spark, d, "a2").withColumn("pf", pf).withColumn("barrio", F.when(c("k") % 2 == 0, "").otherwise(c("barrio")))
    return target.join(found, "pf", "left").select("_row", F.when(c("barrio") == "", F.coalesce("found", F.lit(""))).otherwise(c("barrio")).alias("barrio"))


_EFF, _BA = f"coalesce(nullif({D.barrio_keep(D.clean('barrio_manual'))}, ''), {D.barrio_keep(D.clean('barrio'))})", D.barrio_keep(D.clean("barrio"))
_FBF = lambda f, b, x: f"nullif({D.norm(f)}, '') || '|' || nullif({D.norm(b)}, '') || '|' || {D.ymd(x)}"
_CHAIN = ["principal", "barrio automático", "fecha automática", "persona, barrio y fecha automáticos"]


@query("fallback_chain_match", f"{KEYED('a2', 'base')}, p AS (SELECT key, max(_row) AS r FROM base_k WHERE key IS NOT NULL GROUP BY key), e AS (SELECT _row, name, figura, coalesce(fecha_d, d) AS fe, d AS fa, {_EFF} AS be, {_BA} AS ba FROM a2_k), k AS (SELECT _row, {_FBF('figura', 'be', 'fe')} AS k1, {_FBF('figura', 'ba', 'fe')} AS k2, {_FBF('figura', 'be', 'fa')} AS k3, {_FBF('name', 'ba', 'fa')} AS k4 FROM e) SELECT _row, coalesce(p1.r, p2.r, p3.r, p4.r) AS match, CASE WHEN p1.r IS NOT NULL THEN '{_CHAIN[0]}' WHEN p2.r IS NOT NULL THEN '{_CHAIN[1]}' WHEN p3.r IS NOT NULL THEN '{_CHAIN[2]}' WHEN p4.r IS NOT NULL THEN '{_CHAIN[3]}' END AS por FROM k LEFT JOIN p p1 ON k1 = p1.key LEFT JOIN p p2 ON k2 = p2.key LEFT JOIN p p3 ON k3 = p3.key LEFT JOIN p p4 ON k4 = p4.key", "a2", "base")
def fallback_chain_match(spark, d):
    """Four keys in turn: effective person, neighbourhood and date; the automatic neighbourhood; the automatic date; all automatic."""
    base = R.keep(keyed(spark, d, "base").select("key", "_row"), "key")
    auto = X.barrio_canon(X.str_clean(c("barrio")))
    eff = F.coalesce(F.nullif(X.barrio_canon(X.str_clean(c("barrio_manual"))), F.lit("")), auto)
    date = F.coalesce("fecha_d", "d")
    keys = [X.key_fbf(c("figura"), eff, date), X.key_fbf(c("figura"), auto, date), X.key_fbf(c("figura"), eff, c("d")), X.key_fbf(c("name"), auto, c("d"))]
    out = keyed(spark, d, "a2").select("_row", *[k.alias(f"k{n}") for n, k in enumerate(keys)])
    for n in range(len(keys)):
        out = out.join(base.select(c("key").alias(f"k{n}"), c("_row").alias(f"r{n}")), f"k{n}", "left")
    por = F.lit(None).cast("string")
    for n in reversed(range(len(keys))):
        por = F.when(c(f"r{n}").isNotNull(), _CHAIN[n]).otherwise(por)
    return out.select("_row", F.coalesce(*[f"r{n}" for n in range(len(keys))]).alias("match"), por.alias("por"))


@query("row_pair_compare", f"{KEYED('a2', 'base')} SELECT a2_k.key AS clave_test, base_k.key AS clave_base, CASE WHEN a2_k.key = base_k.key THEN 'Sí' ELSE 'No' END AS iguales FROM a2_k, base_k WHERE a2_k._row = 340 AND base_k._row = 136", "a2", "base")
def row_pair_compare(spark, d):
    t = keyed(spark, d, "a2").where("_row = 340").select(c("key").alias("clave_test"), F.lit(1).alias("one"))
    b = keyed(spark, d, "base").where("_row = 136").select(c("key").alias("clave_base"), F.lit(1).alias("one"))
    return t.join(b, "one").select("clave_test", "clave_base", F.when(c("clave_test") == c("clave_base"), "Sí").otherwise("No").alias("iguales"))


@query("duplicate_rows", f"{KEYED('base')} SELECT key, count(*) OVER (PARTITION BY key) AS repeticiones, _row, figura, barrio, status, asis FROM base_k WHERE key IS NOT NULL QUALIFY repeticiones > 1", "base")
def duplicate_rows(spark, d):
    return R.duplicates(keyed(spark, d, "base"), "key").select("key", "repeticiones", "_row", "figura", "barrio", "status", "asis")


@query("duplicate_row_lists", f"{KEYED('base')} SELECT key, string_agg(CAST(_row AS VARCHAR), ',' ORDER BY _row) AS filas FROM base_k WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1", "base")
def duplicate_row_lists(spark, d):
    rows = R.duplicates(keyed(spark, d, "base").select("key", "_row"), "key")
    return rows.groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list("_row")), lambda r: r.cast("string")), ",").alias("filas"))


@query("running_max_accept", f", s AS (SELECT _row, name, {D.num('asistentes')} AS asis, 5.0::DOUBLE AS cur FROM b2), w AS (SELECT *, max(asis) OVER (PARTITION BY name ORDER BY _row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM s WHERE asis > 0) SELECT _row, name, asis, asis >= greatest(coalesce(seen, cur), cur) AS accepted FROM w", "b2")
def running_max_accept(spark, d):
    s = sheet(spark, d, "b2").select("_row", "name", X.num_parse(c("asistentes")).alias("asis"), F.lit(5.0).alias("cur")).where("asis > 0")
    return R.running_max(s, "name", "asis", "cur").select("_row", "name", "asis", "accepted")


@query("compare_summary", f"{KEYED('a2', 'b2')}, a AS (SELECT key, count(*) AS n FROM a2_k WHERE key IS NOT NULL GROUP BY key), b AS (SELECT key, count(*) AS n FROM b2_k WHERE key IS NOT NULL GROUP BY key) SELECT 'claves A2' AS metrica, count(*) AS valor FROM a UNION ALL SELECT 'claves B2', count(*) FROM b UNION ALL SELECT 'en ambas', count(*) FROM a JOIN b USING (key) UNION ALL SELECT 'faltan en B2', count(*) FROM a ANTI JOIN b USING (key) UNION ALL SELECT 'faltan en A2', count(*) FROM b ANTI JOIN a USING (key) UNION ALL SELECT 'duplicadas A2', count(*) FROM a WHERE n > 1 UNION ALL SELECT 'duplicadas B2', count(*) FROM b WHERE n > 1", "a2", "b2")
def compare_summary(spark, d):
    a, b = (keyed(spark, d, n).where("key is not null").groupBy("key").agg(F.count("*").alias(n)) for n in ("a2", "b2"))
    both = a.join(b, "key", "full_outer")
    n = lambda cond: F.count(F.when(cond, 1))
    row = both.agg(
        n(c("a2").isNotNull()).alias("claves A2"), n(c("b2").isNotNull()).alias("claves B2"), n(c("a2").isNotNull() & c("b2").isNotNull()).alias("en ambas"), n(c("b2").isNull()).alias("faltan en B2"),
        n(c("a2").isNull()).alias("faltan en A2"), n(c("a2") > 1).alias("duplicadas A2"), n(c("b2") > 1).alias("duplicadas B2"),
    )
    return row.unpivot([], row.columns, "metrica", "valor")


@query("skip_causes", f"{KEYED('b2', 'base')} SELECT CASE WHEN {DONE} THEN 'procesada' WHEN key IS NULL THEN 'sin clave' WHEN key NOT IN (SELECT key FROM base_k WHERE key IS NOT NULL) THEN 'sin match' ELSE 'actualizada' END AS causa, count(*) AS n FROM b2_k GROUP BY 1", "b2", "base")
def skip_causes(spark, d):
    base = keyed(spark, d, "base").where("key is not null").select("key").distinct().withColumn("there", F.lit(True))
    rows = keyed(spark, d, "b2").join(base, "key", "left")
    causa = F.when(done(), "procesada").when(c("key").isNull(), "sin clave").when(c("there").isNull(), "sin match").otherwise("actualizada")
    return rows.groupBy(causa.alias("causa")).agg(F.count("*").alias("n"))


@query("sorted_base", f"{KEYED('base')} SELECT _row, fecha_d, hora, figura FROM base_k ORDER BY fecha_d NULLS LAST, hora NULLS LAST, figura, _row", "base")
def sorted_base(spark, d):
    return keyed(spark, d, "base").select("_row", "fecha_d", "hora", "figura").orderBy(c("fecha_d").asc_nulls_last(), c("hora").asc_nulls_last(), "figura", "_row")


@query("audit_sorted", f"{KEYED('base')} SELECT key, count(*) OVER (PARTITION BY key) AS repeticiones, _row FROM base_k WHERE key IS NOT NULL QUALIFY repeticiones > 1", "base")
def audit_sorted(spark, d):
    return R.duplicates(keyed(spark, d, "base").select("key", "_row"), "key").select("key", "repeticiones", "_row").orderBy(F.collate("key", "UNICODE"), "_row")


CELLS = ["hora", "asistentes", "status"]


@query("cell_diff", f"{KEYED('rvd', 'base')}, u AS (SELECT * FROM rvd_k WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row DESC) = 1), p AS (SELECT * FROM base_k WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row DESC) = 1) " + " UNION ALL ".join(f"SELECT u.key, '{x}' AS col, trim(u.{x}) AS l, trim(p.{x}) AS r FROM u JOIN p USING (key) WHERE trim(u.{x}) <> trim(p.{x})" for x in CELLS), "rvd", "base")
def cell_diff(spark, d):
    u, p = (R.keep(keyed(spark, d, n).select("key", "_row", *CELLS), "key") for n in ("rvd", "base"))
    return R.cell_pairs(u, p, "key", CELLS).where("l != r")
