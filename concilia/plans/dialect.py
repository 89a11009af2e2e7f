"""Scalar rules as DuckDB SQL, written apart from their Column forms so that one checks the other."""

from __future__ import annotations

from ..functions.dictionaries import ALIASES_BLANK, ALIASES_KEEP, ALIASES_TITLE, CANON, STATUSES
from ..sources.sheets import AS_OF

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def clean(x: str) -> str:
    return rf"coalesce(regexp_replace(CAST({x} AS VARCHAR), '^\s+|\s+$', '', 'g'), '')"


def norm(x: str, dashes: bool = True) -> str:
    inner = f"translate(coalesce({x}, ''), ' ​‌‍﻿', '     ')"
    inner = f"translate({inner}, '‒–—−', '----')" if dashes else inner
    return rf"trim(regexp_replace(lower(strip_accents({inner})), '\s+', ' ', 'g'))"


def status(x: str) -> str:
    return f"lower(strip_accents({clean(x)}))"


def title(x: str) -> str:
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def mapped(x: str, values: dict[str, str], other: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in values.items()) + f" ELSE {other} END"


def canon_case(x: str, n: str, first: dict[str, str], other: str) -> str:
    names = " ".join(f"WHEN strip_accents(lower({quoted(c)})) THEN {quoted(c)}" for c in CANON)
    return f"CASE {n} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in first.items()) + f" {names} ELSE {other} END"


def barrio_keep(x: str) -> str:
    return f"CASE WHEN {norm(x, False)} = '' THEN {x} ELSE {canon_case(x, norm(x, False), ALIASES_KEEP, x)} END"


def barrio_blank(x: str) -> str:
    return canon_case(x, norm(x, False), ALIASES_BLANK, "''")


def barrio_title(x: str) -> str:
    return mapped(norm(x, False), ALIASES_TITLE, title(norm(x, False)))


def comma(x: str) -> str:
    return f"regexp_replace({clean(x)}, '^([^,]*),', '\\1.')"


def num(x: str) -> str:
    return f"CASE WHEN regexp_matches({comma(x)}, '{NUMBER}') THEN CAST({comma(x)} AS DOUBLE) ELSE 0.0 END"


def date(x: str) -> str:
    dmy, ymd = r"^\s*(\d{1,2})[/-](\d{1,2})(?:[/-](\d{2,4}))?\s*$", r"^\s*(20\d{2})[/-](\d{1,2})[/-](\d{1,2})\s*$"
    part = lambda p, k: f"TRY_CAST(regexp_extract({x}, '{p}', {k}) AS INT)"
    y = f"coalesce({part(dmy, 3)}, {AS_OF[:4]})"
    y = f"(CASE WHEN {y} < 100 THEN {y} + 2000 ELSE {y} END)"
    rolled = lambda y, m, d: f"CAST(make_date({y}, 1, 1) + to_months({m} - 1) + to_days({d} - 1) AS DATE)"
    return f"CASE WHEN regexp_matches({x}, '{dmy}') THEN {rolled(y, part(dmy, 2), part(dmy, 1))} WHEN regexp_matches({x}, '{ymd}') THEN {rolled(part(ymd, 1), part(ymd, 2), part(ymd, 3))} END"


def time(x: str) -> str:
    p = r"(?i)^\s*(\d{1,2}):(\d{2})\s*(AM|PM)?\s*$"
    h, half = f"TRY_CAST(regexp_extract({x}, '{p}', 1) AS INT)", f"upper(regexp_extract({x}, '{p}', 3))"
    hour = f"CASE WHEN {half} = 'PM' AND {h} < 12 THEN {h} + 12 WHEN {half} = 'AM' AND {h} = 12 THEN 0 ELSE {h} END"
    return f"CASE WHEN regexp_matches({x}, '{p}') THEN lpad(CAST({hour} AS VARCHAR), 2, '0') || ':' || regexp_extract({x}, '{p}', 2) END"


def hora(x: str, seconds: bool = True) -> str:
    p = r"^(\d{1,2}):(\d{2})(?::(\d{2}))?$" if seconds else r"^(\d{1,2}):(\d{2})$"
    g = lambda k: f"regexp_extract({clean(x)}, '{p}', {k})"
    tail = f" || ':' || CASE WHEN {g(3)} = '' THEN '00' ELSE {g(3)} END" if seconds else ""
    return f"CASE WHEN regexp_matches({clean(x)}, '{p}') THEN lpad({g(1)}, 2, '0') || ':' || {g(2)}{tail} ELSE {clean(x)} END"


def strict(x: str) -> str:
    return f"CASE WHEN {clean(x)} = '' THEN 0.0 WHEN regexp_matches({clean(x)}, '{NUMBER}') THEN CAST({clean(x)} AS DOUBLE) END"


def number_text(x: str) -> str:
    return f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"


def ymd(d: str) -> str:
    return f"strftime({d}, '%Y%m%d')"


def fbf(figura: str = "figura", barrio: str = "barrio", fecha: str = "fecha") -> str:
    return f"nullif({norm(figura)}, '') || '|' || nullif({norm(barrio)}, '') || '|' || {ymd(date(fecha))}"


def map_status(x: str) -> str:
    n = status(x)
    return (
        f"CASE WHEN {clean(x)} IN ({', '.join(map(quoted, STATUSES))}) THEN {clean(x)} WHEN {n} LIKE 'realizad%' THEN 'Realizada' WHEN {n} LIKE 'programad%' THEN 'en agenda' "
        f"WHEN {n} LIKE 'reprogramad%' THEN 'Reprogramada' WHEN {n} LIKE '%suspendid%' OR {n} LIKE 'cancelad%' THEN 'Suspendida' WHEN {n} LIKE '%se modifico barrio%' OR {n} LIKE '%modifico el barrio%' THEN 'Se modifico el barrio' ELSE 'en agenda' END"
    )
