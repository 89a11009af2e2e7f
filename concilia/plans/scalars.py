"""One query per scalar rule: _row and value over every raw row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..sources.sheets import AS_OF, raw, sql_with, table
from . import dialect as D

QUERIES: dict = {}
SQL: dict[str, str] = {}
c = F.col


#: The estimated neighbourhood, last in precedence.
ESTIMATED = "CASE WHEN k % 2 = 0 THEN 'Flores' ELSE 'nowhere' END"


def rule(name: str, value: Callable[[], Column], sql: str) -> None:
    QUERIES[name] = lambda spark, d: raw(spark, d).withColumn("estimado", F.expr(ESTIMATED)).select("_row", value().alias("value"))
    SQL[name] = f"{sql_with()} SELECT _row, {sql} AS value FROM (SELECT *, {ESTIMATED} AS estimado FROM raw)"


AGES = lambda: c("e18") + c("e25") + c("e40") + c("e56") + c("e66")
AGES_SQL = "(e18 + e25 + e40 + e56 + e66)"
MONDAY = f"CAST(date_trunc('week', DATE '{AS_OF}') AS DATE)"
FIGURA, BARRIO = D.clean("split_part(figura, '&', 1)"), r"trim(regexp_replace(coalesce(barrio, ''), '\s+', ' ', 'g'))"

rule("str_clean", lambda: X.str_clean(c("figura")), D.clean("figura"))
rule("normalize_text", lambda: X.normalize_text(c("figura")), D.norm("figura"))
rule("normalize_text_nodash", lambda: X.normalize_text(c("figura"), dashes=False), D.norm("figura", False))
rule("normalize_status", lambda: X.normalize_status(c("status")), D.status("status"))
rule("title_case", lambda: X.title_case(c("barrio")), D.title(r"trim(regexp_replace(lower(barrio), '\s+', ' ', 'g'))"))
rule("barrio_canon_keep", lambda: X.barrio_canon(c("barrio")), D.barrio_keep("barrio"))
rule("barrio_canon_blank", lambda: X.barrio_canon(c("barrio"), "blank"), D.barrio_blank("barrio"))
rule("barrio_canon_title", lambda: X.barrio_canon_title(c("barrio")), D.barrio_title("barrio"))
rule("map_status", lambda: X.map_status(c("status")), D.map_status("status"))
rule("status_prefix", lambda: X.status_prefix(c("status")), f"CASE WHEN {D.status('status')} LIKE 'realizad%' THEN 'realizada' WHEN {D.status('status')} LIKE 'programad%' THEN 'programada' ELSE '' END")
rule("sanitize_figura", lambda: X.sanitize_figura(c("figura")), FIGURA)
rule("sanitize_barrio", lambda: X.sanitize_barrio(c("barrio")), BARRIO)
rule("persona_from_text", lambda: X.persona_from_text(F.concat("figura", F.lit(" y otros (sala)"))), D.clean("split_part(split_part(figura || ' y otros', ' & ', 1), ' y ', 1)"))
rule("exclude_marker_text", lambda: X.excluded(F.concat("status", F.when(c("k") % 5 == 0, " No  Participa").when(c("k") % 5 == 1, " NO PARTICIPÁ").otherwise(""))), "lower(strip_accents(status || CASE k % 5 WHEN 0 THEN ' No  Participa' WHEN 1 THEN ' NO PARTICIPÁ' ELSE '' END)) LIKE '%no participa%'")
rule("num_parse", lambda: X.num_parse(c("asistentes")), D.num("asistentes"))
rule("num_prefix_parse", lambda: X.num_prefix_parse(c("asistentes")), rf"coalesce(TRY_CAST(regexp_extract({D.comma('asistentes')}, '^\s*([+-]?[0-9]+(?:\.[0-9]+)?)', 1) AS DOUBLE), 0.0)")
rule("numeric_like", lambda: X.numeric_like(c("asistentes")), f"regexp_matches({D.comma('asistentes')}, '{D.NUMBER}')")
rule("empty_or_zero", lambda: X.empty_or_zero(c("asistentes")), f"{D.clean('asistentes')} = '' OR (regexp_matches({D.comma('asistentes')}, '{D.NUMBER}') AND {D.num('asistentes')} = 0)")
rule("parse_date_lenient", lambda: X.parse_date_lenient(c("fecha"), AS_OF).cast("string"), f"CAST({D.date('fecha')} AS VARCHAR)")
rule("parse_time_ampm", lambda: X.parse_time_ampm(c("hora")), D.time("hora"))
rule("format_hora_seconds", lambda: X.format_hora(c("hora")), D.hora("hora"))
rule("format_hora_minutes", lambda: X.format_hora(c("hora"), seconds=False), D.hora("hora", False))
rule("week_bucket", lambda: X.week_bucket(c("d"), AS_OF), f"CASE WHEN d >= {MONDAY} + 7 THEN 'future' WHEN d >= {MONDAY} THEN 'current' WHEN d >= {MONDAY} - 7 THEN 'past' END")
rule("channel_rollup", lambda: (c("facebook") + c("google") + c("programmatic")).cast("long"), "CAST(facebook + google + programmatic AS BIGINT)")
rule("rrss_fallback", lambda: X.rrss_fallback(c("rrss"), (c("facebook") + c("google") + c("programmatic")).cast("double")), f"CASE WHEN {D.clean('rrss')} <> '' THEN {D.num('rrss')} ELSE CAST(facebook + google + programmatic AS DOUBLE) END")
rule("age_residual", lambda: F.greatest(F.lit(0), c("inscriptos") - AGES()).cast("long"), f"CAST(greatest(0, inscriptos - {AGES_SQL}) AS BIGINT)")
rule("age_residual_backfill", lambda: F.when((c("e66") == 0) & (c("inscriptos") > 0) & (AGES() > 0), F.greatest(F.lit(0), c("inscriptos") - AGES())).otherwise(c("e66")).cast("long"), f"CAST(CASE WHEN e66 = 0 AND inscriptos > 0 AND {AGES_SQL} > 0 THEN greatest(0, inscriptos - {AGES_SQL}) ELSE e66 END AS BIGINT)")
rule("gender_allocation", lambda: X.gender_allocation(c("inscriptos"), c("ins_m"), c("unicos")), "CAST(CASE WHEN unicos > 0 THEN floor(inscriptos * (CAST(ins_m AS DOUBLE) / unicos) + 0.5) ELSE 0 END AS BIGINT)")
rule("build_id_final", lambda: F.concat_ws(" - ", X.blank_null(c("figura")), X.blank_null(c("barrio")), X.dmy(c("d"))), f"concat_ws(' - ', nullif({D.clean('figura')}, ''), nullif({D.clean('barrio')}, ''), strftime(d, '%d/%m/%Y'))")
rule("build_id_a2", lambda: F.concat_ws(" - ", X.sanitize_figura(c("figura")), X.blank_null(c("barrio")), X.dmy(c("d"))), f"concat_ws(' - ', {FIGURA}, nullif({D.clean('barrio')}, ''), strftime(d, '%d/%m/%Y'))")
rule("build_id_b2", lambda: F.concat_ws(" - ", X.blank_null(c("figura")), X.dmy(X.parse_date_lenient(c("fecha"), AS_OF))), f"concat_ws(' - ', nullif({D.clean('figura')}, ''), strftime({D.date('fecha')}, '%d/%m/%Y'))")
rule("manual_over_auto", lambda: F.coalesce(X.blank_null(c("barrio_manual")), X.blank_null(c("barrio"))), f"coalesce(nullif({D.clean('barrio_manual')}, ''), nullif({D.clean('barrio')}, ''))")
known = lambda x: F.nullif(X.barrio_canon(c(x), "blank"), F.lit(""))
rule("valid_barrio_precedence", lambda: F.coalesce(known("barrio_manual"), known("barrio")), f"coalesce(nullif({D.barrio_blank('barrio_manual')}, ''), nullif({D.barrio_blank('barrio')}, ''))")
_D, _DS = X.parse_date_lenient, D.date("fecha")
rule("num_strict", lambda: X.num_strict(c("asistentes")), D.strict("asistentes"))
rule("year_default", lambda: F.coalesce(F.year(_D(c("fecha"), AS_OF)), F.year(F.lit(AS_OF).cast("date"))), f"coalesce(CAST(year({_DS}) AS INT), {AS_OF[:4]})")
rule("three_level_precedence", lambda: F.coalesce(known("barrio_manual"), known("barrio"), known("estimado")), f"coalesce(nullif({D.barrio_blank('barrio_manual')}, ''), nullif({D.barrio_blank('barrio')}, ''), nullif({D.barrio_blank('estimado')}, ''))")
rule("key_fbf", lambda: X.key_fbf(c("figura"), c("barrio"), X.parse_date_lenient(c("fecha"), AS_OF)), D.fbf())
rule("key_b", lambda: X.key_b(c("figura"), c("inscriptos")), f"nullif({D.norm('figura')}, '') || '|' || CAST(inscriptos AS VARCHAR)")
rule("compare_cells", lambda: F.when(c("barrio") != c("barrio_manual"), F.concat_ws(" <> ", "barrio", "barrio_manual")), "CASE WHEN barrio <> barrio_manual THEN concat_ws(' <> ', barrio, barrio_manual) END")


def _page_text(spark, d):
    return table(spark, d, "pages").select("page_id", X.strip_html(c("html")).alias("value"))


def _page_lines(spark, d):
    return _page_text(spark, d).select("page_id", F.size(X.split_lines(c("value"))).cast("long").alias("lines"))


_strip = "html"
for _p, _n in ((r"(?i)<br\s*/?>", "chr(10)"), ("(?i)</p>", "chr(10)"), ("<[^>]+>", "''"), ("&nbsp;", "' '"), ("&amp;", "'&'"), (r"[ \t]+\n", "chr(10)")):
    _strip = f"regexp_replace({_strip}, '{_p}', {_n}, 'g')"
_strip = D.clean(_strip)
QUERIES |= {"strip_html": _page_text, "split_lines": _page_lines}
SQL |= {
    "strip_html": f"SELECT page_id, {_strip} AS value FROM pages",
    "split_lines": rf"SELECT page_id, CAST(len(list_filter(string_split_regex({_strip}, '\r?\n'), lambda s: {D.clean('s')} <> '')) AS BIGINT) AS lines FROM pages",
}
