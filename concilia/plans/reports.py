"""Reports of whole runs: the comparison in blocks, the counters of the upsert, tables found in several catalogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import report as B
from ..operators import runner
from ..operators import steps as S
from ..operators.stage import cut, settled
from ..sources.catalog import Catalogs
from . import dialect as D
from . import flagship as L

QUERIES: dict = {}
SQL: dict[str, str] = {}
c = F.col

_A = {"Key": "key", "ID (A2)": "id", "Figura": "figura", "BarrioN": "barrion", "FECHA": "fecha", "HORA": "hora", "Dirección": "direccion", "Asistentes": "asistentes", "STATUS": "status", "Fila A2": "_row"}
_B = {"Key": "key", "ID (B2)": "id", "Persona": "persona", "BarrioN": "barrion", "FECHA": "fecha", "Inscriptos": "inscriptos", "Mail": "mail", "Call": "callc", "IVR": "ivr", "RRSS": "rrss", "Difusión": "difusion", "Maculino": "masculinos", "Femenino": "femeninos", "Fila B2": "_row"}
_TITLES = ("Faltan en B2 (están en A2)", "Faltan en A2 (están en B2)")


def comparison_report(spark, d):
    """A2 against B2 after the first three steps: a summary and the rows that either lacks, where their key first stands, with the values of its last row."""
    sides = []
    for df, headers in zip(L.Run(spark, d).named, (_A, _B)):
        shown = {"fecha": X.dmy(c("fecha_d")), "asistentes": X.number_text(c("asistentes")) if headers is _A else None, "rrss": X.number_text(c("rrss")) if headers is _B else None, "key": c("base_key")}
        rows = df.select("_row", *[(c(x) if shown.get(x) is None else shown[x]).alias(x) for x in headers.values() if x != "_row"])
        ends = cut(B.first_place_last_value(rows, "key"))
        # How often a key occurs is told by its ends: a second row lies after the first.
        sides.append((ends, headers))
    (a, _), (b, _) = sides
    keys = a.select("key", F.lit(1).alias("a"), (c("_row") > c("_first")).alias("da")).join(b.select("key", F.lit(1).alias("b"), (c("_row") > c("_first")).alias("db")), "key", "full_outer")
    n = lambda cond: F.count(F.when(cond, 1))
    m = keys.agg(n(c("a") == 1), n(c("b") == 1), n((c("a") == 1) & (c("b") == 1)), n(c("b").isNull()), n(c("a").isNull()), n(c("da")), n(c("db"))).first()
    names = ["A2 - total (todas)", "B2 - total (todas)", "Intersección", *_TITLES, "Claves duplicadas en A2", "Claves duplicadas en B2"]
    blocks = [(title, list(headers), mine.join(other.select("key"), "key", "left_anti"), [c(x) for x in headers.values()]) for title, (mine, headers), other in ((_TITLES[0], sides[0], b), (_TITLES[1], sides[1], a))]
    return B.laid_out(spark, list(zip(names, m)), blocks)


def _side(name: str, of: str, headers: dict, shown: dict) -> str:
    cells = ", ".join(f"coalesce(CAST({shown.get(x, x)} AS VARCHAR), '')" for x in headers.values())
    return f", {name}_e AS (SELECT key, concat_ws(chr(9), {cells}) AS texto, first, _row > first AS again FROM (SELECT *, min(_row) OVER (PARTITION BY key) AS first FROM {of} WHERE key IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row DESC) = 1)"


_DMY = {"fecha": "strftime(fecha_d, '%d/%m/%Y')", "rrss": D.number_text("rrss"), "asistentes": D.number_text("asistentes")}
_BLOCK = lambda mine, other, k, line: f"SELECT {k}, {line} + 1 + row_number() OVER (ORDER BY first), 'fila', texto FROM {mine}_e WHERE key NOT IN (SELECT key FROM {other}_e)"
_COUNT = lambda x, where="true": f"(SELECT count(*) FROM {x}_e WHERE {where})"
_ONLY = {x: _COUNT(x, f"key NOT IN (SELECT key FROM {y}_e)") for x, y in (("ra", "rb"), ("rb", "ra"))}
_SECOND = f"(10 + CASE WHEN {_ONLY['ra']} = 0 THEN 3 ELSE {_ONLY['ra']} + 3 END)"
_HEAD = lambda k, line, title, headers, n: f"SELECT {k}, {line}, 'título', {D.quoted(title)} UNION ALL SELECT {k}, {line} + 1, CASE WHEN {n} = 0 THEN 'vacío' ELSE 'cabecera' END, CASE WHEN {n} = 0 THEN '{B.EMPTY}' ELSE {D.quoted('@').replace('@', '@')} END".replace("'@'", "concat_ws(chr(9), " + ", ".join(map(D.quoted, headers)) + ")")
_METRICS = [("A2 - total (todas)", _COUNT("ra")), ("B2 - total (todas)", _COUNT("rb")), ("Intersección", _COUNT("ra", "key IN (SELECT key FROM rb_e)")), (_TITLES[0], _ONLY["ra"]), (_TITLES[1], _ONLY["rb"]), ("Claves duplicadas en A2", _COUNT("ra", "again")), ("Claves duplicadas en B2", _COUNT("rb", "again"))]
QUERIES["comparison_report"] = comparison_report
SQL["comparison_report"] = (
    f"{L._ALL}{L.A2}{L.B2}{L.BASE}, ra AS (SELECT *, {L._FBF('figura', 'barrion')} AS key FROM a2_b), rb AS (SELECT * EXCLUDE (key, base_key), base_key AS key FROM b2_k){_side('ra', 'ra', _A, _DMY)}{_side('rb', 'rb', _B, _DMY)}"
    " SELECT 0 AS block, CAST(1 AS BIGINT) AS line, 'cabecera' AS clase, 'Métrica' || chr(9) || 'Valor' AS texto"
    + "".join(f" UNION ALL SELECT 0, {k + 2}, 'fila', {D.quoted(name)} || chr(9) || {n}" for k, (name, n) in enumerate(_METRICS))
    + f" UNION ALL {_HEAD(1, 10, _TITLES[0], _A, _ONLY['ra'])} UNION ALL {_BLOCK('ra', 'rb', 1, 10)} UNION ALL {_HEAD(2, _SECOND, _TITLES[1], _B, _ONLY['rb'])} UNION ALL {_BLOCK('rb', 'ra', 2, _SECOND)}"
)

# Why a row of B2 is left out of the base, in the order in which it is asked; and how many of A2's rows the base takes.
CAUSES = ["processedTrue", "noFigura", "noBarrioN", "noFecha", "noMatch", "updated"]


def _with_cause(tables):
    there = tables["base"].where("key is not null").select(c("key").alias("base_key")).distinct().withColumn("there", F.lit(True))
    blank = lambda x: X.str_clean(c(x)) == ""
    causa = F.when(c("procesado"), "processedTrue").when(blank("persona"), "noFigura").when(blank("barrion"), "noBarrioN").when(c("fecha_d").isNull(), "noFecha").when(c("there").isNull(), "noMatch").otherwise("updated")
    return tables["b2"].join(there, "base_key", "left").withColumn("causa", causa)


def jobs() -> list[runner.Job]:
    """The upsert's two halves as jobs with their needs and counters."""
    n = lambda cond: F.count(F.when(cond, 1))
    return [
        runner.Job("a2_marcada", lambda t: S.marked_a2(t["a2"], t["base"]), {"a2": [("figura", "persona", "nombre"), ("barrion", "barrio"), ("fecha_d",)], "base": [("asistentes",)]}, {"updatesA": n(c("procesado")), "skippedA": n(~c("procesado"))}),
        runner.Job("b2_marcada", _with_cause, {"b2": [("persona", "figura"), ("barrion",), ("fecha_d",), ("procesado",)]}, {x: n(c("causa") == x) for x in CAUSES}),
    ]


def upsert_counters(spark, d):
    """contador, n: what the upsert took and left out, by cause, counted while its tables are written."""

    def counted():
        run = L.Run(spark, d)
        _, said = runner.run(jobs(), {"a2": run.named[0], "b2": run.named[1], "base": run.before}, lambda name, df: cut(df))
        rows = [(k, int(v)) for job in said.values() for k, v in job.items() if k != "seconds"]
        return spark.createDataFrame(rows, "contador string, n long")

    return settled(counted)


_BLANK = lambda x: f"{D.clean(x)} = ''"
QUERIES["upsert_counters"] = upsert_counters
SQL["upsert_counters"] = (
    f"{L._ALL}{L.A2}{L.B2}{L.BASE}, marked AS ({L.MARKED.lstrip(', ').join(['WITH ', ''])}), w AS (SELECT CASE WHEN procesado THEN 'processedTrue' WHEN {_BLANK('persona')} THEN 'noFigura' WHEN {_BLANK('barrion')} THEN 'noBarrioN' WHEN fecha_d IS NULL THEN 'noFecha' WHEN base_key IS NULL OR base_key NOT IN (SELECT key FROM base_l) THEN 'noMatch' ELSE 'updated' END AS causa FROM b2_k)"
    " SELECT 'updatesA' AS contador, count(*) FILTER (procesado) AS n FROM marked UNION ALL SELECT 'skippedA', count(*) FILTER (NOT procesado) FROM marked"
    + "".join(f" UNION ALL SELECT '{x}', count(*) FILTER (causa = '{x}') FROM w" for x in CAUSES)
)


# Backfills of the age bands, whole tables. Every eighth person and every tenth date of B2 has a manual value.
_B2_OUT = [x for x in L._B2_COLUMNS if x != "key"]


def _manual(b2):
    return b2.withColumns({"persona_manual": F.when(c("_row") % 8 == 3, c("nombre")).otherwise(""), "fecha_manual": F.when(c("_row") % 10 == 4, "15/6/1998").when(c("_row") % 10 == 5, "pronto").otherwise("")})


def backfill_b2(spark, d):
    """B2 with the age bands of the source's last row of its name and registrations."""
    run = L.Run(spark, d)
    source = cut(run.rows.select("_row", X.key_b(c("name"), c("inscriptos")).alias("key"), "inscriptos", *S.AGES))
    return S.ages_into_b2(source.where("key is not null and _row % 3 <> 0"), cut(L.b2_cells(run.dated("b2")))).select(*_B2_OUT)


def backfill_base(spark, d):
    """The base with the age bands of B2's last row of a key, by effective person, neighbourhood and date."""
    run = L.Run(spark, d)
    b2 = settled(lambda: S.effective_b2(_manual(run.b2()).drop("key"), L.AS_OF))
    return S.ages_into_base(run.before, b2).drop("key")


QUERIES |= {"backfill_b2": backfill_b2, "backfill_base": backfill_base}
_BANDS = [*S.AGES, "sin"]
_TAKE = lambda cols, hit: ", ".join(f"CASE WHEN {hit} IS NULL THEN t.{x} ELSE f.{x} END AS {x}" if x in _BANDS else f"t.{x}" for x in cols)
_TOTAL = "(" + " + ".join(S.AGES) + ")"
SQL["backfill_b2"] = (
    f"{L._ALL}{L.A2}{L.B2}, s AS (SELECT _row, {L._KEYB} AS key, {L._AGES}, {L._SIN} AS sin FROM (SELECT *, name AS nombre FROM src) WHERE _row % 3 <> 0), f AS (SELECT * FROM s WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row DESC) = 1)"
    f" SELECT {_TAKE(_B2_OUT, 'f.key')} FROM b2_0 t LEFT JOIN b2_l l ON t._row = l._row LEFT JOIN f ON l.key = f.key"
)
_BASE_OUT = ["_row", "figura", "barrio", "fecha_d", "hora", "direccion", "status", "asistentes", *L.CELLS, "comuna"]
_FIRST = lambda *xs: "coalesce(" + ", ".join(f"nullif({D.clean(x)}, '')" for x in xs) + ")"
SQL["backfill_base"] = (
    f"{L._ALL}{L.A2}{L.B2}{L.BASE}, man AS (SELECT * EXCLUDE (fecha_d), fecha_d AS fecha_own, CASE WHEN _row % 8 = 3 THEN nombre ELSE '' END AS persona_manual, CASE WHEN _row % 10 = 4 THEN '15/6/1998' WHEN _row % 10 = 5 THEN 'pronto' ELSE '' END AS fecha_manual FROM b2_b),"
    f" eff AS (SELECT _row, inscriptos, {L._AGES}, sin, {_FIRST('persona_manual', 'persona')} AS who, {_FIRST('barrio_manual', 'barrion', 'barrio')} AS place, coalesce({D.date('fecha_manual')}, fecha_own) AS fecha_d FROM man),"
    f" ek AS (SELECT _row, {L._AGES}, CAST(CASE WHEN sin = 0 AND inscriptos > 0 AND {_TOTAL} > 0 THEN greatest(0, inscriptos - {_TOTAL}) ELSE sin END AS BIGINT) AS sin, {L._FBF('who', 'place')} AS key FROM eff), f AS (SELECT * FROM ek WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY _row DESC) = 1)"
    f" SELECT {_TAKE(_BASE_OUT, 'f.key')} FROM base_0 t LEFT JOIN base_l l ON t._row = l._row LEFT JOIN f ON l.key = f.key"
)


# The variant of the upsert that only fills. Some of the base's channels are cleared first, so that there is something to fill.
_CLEARED = {"inscriptos": 9, "mail": 4, "callc": 6, "rrss": 7, "masculinos": 8}


def fill_only_base(spark, d):
    """The base after the fill-only upsert: blank or zero cells take the first useful value of A2 and B2."""
    run = L.Run(spark, d)
    base = run.before.withColumns({x: F.when(c("_row") % n == 0, F.lit(0).cast(run.before.schema[x].dataType)).otherwise(c(x)) for x, n in _CLEARED.items()})
    return S.filled_base(base, *run.named).drop("key")


QUERIES["fill_only_base"] = fill_only_base
_USEFUL = lambda *names: ", ".join(f"arg_min({x}, _row) FILTER ({x} > 0) AS f_{x}" for x in names)
_CLEAR = ", ".join(f"CASE WHEN _row % {n} = 0 THEN 0 ELSE {x} END AS {x}" for x, n in _CLEARED.items())
_EMPTY = f"({D.clean('asistentes')} = '' OR (regexp_matches({D.comma('asistentes')}, '{D.NUMBER}') AND {D.num('asistentes')} = 0))"
SQL["fill_only_base"] = (
    f"{L._ALL}{L.A2}{L.B2}{L.BASE}, fa AS (SELECT {L._FBF('figura', 'barrion')} AS key, {_USEFUL('asistentes')} FROM a2_b GROUP BY 1), fb AS (SELECT base_key AS key, {_USEFUL(*S.CHANNELS)} FROM b2_k GROUP BY 1), bc AS (SELECT * REPLACE ({_CLEAR}) FROM base_0)"
    f" SELECT {', '.join(f't.{x}' for x in _BASE_OUT if x not in ('asistentes', *S.CHANNELS))}, CASE WHEN f_asistentes IS NOT NULL AND {_EMPTY} THEN {D.number_text('f_asistentes')} ELSE asistentes END AS asistentes,"
    f" {', '.join(f'CASE WHEN f_{x} IS NOT NULL AND coalesce({x}, 0) = 0 THEN f_{x} ELSE {x} END AS {x}' for x in S.CHANNELS)} FROM bc t LEFT JOIN base_l l ON t._row = l._row LEFT JOIN fa ON l.key = fa.key LEFT JOIN fb ON l.key = fb.key"
)


def first_existing_table(spark, d):
    """Rows by status of the first table that one catalog has among several names, beside the customers of another."""
    found = Catalogs(spark, agenda=d, base=d)
    orders, people = found.table("agenda", "Hoja de pedidos", "pedidos", "orders"), found.table("base", "clientes", "customer")
    return orders.join(people, c("o_custkey") == c("c_custkey")).groupBy(c("o_orderstatus").alias("estado")).agg(F.count("*").alias("filas"), F.countDistinct("c_custkey").alias("clientes"))


QUERIES["first_existing_table"] = first_existing_table
SQL["first_existing_table"] = "SELECT o_orderstatus AS estado, count(*) AS filas, count(DISTINCT c_custkey) AS clientes FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"
