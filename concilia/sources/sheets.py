"""Sheets: dirty, header-addressed tables derived from the driver's tables.

The SQL below is in the dialect that Spark and DuckDB share, so queries and their SQL read the same
rows. ``_row`` is the 2-based row number of a sheet; it decides which duplicate wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.dictionaries import CANON

AS_OF = "1998-06-17"
#: Added to the row number of a second row; beyond the number of any row.
FAR = 1 << 50
BARRIOS = ",".join([*CANON, "Velez", "Pompeya"])
ACCENTS = ("áéíóúüñÁÉÍÓÚÜÑ", "aeiouunAEIOUUN")

RAW = f"""
SELECT o_orderkey + 2 AS _row, o_orderkey AS k, c_name AS name,
  CASE o_orderkey % 7 WHEN 0 THEN upper(c_name) WHEN 1 THEN '  ' || c_name || '  ' WHEN 2 THEN c_name || ' & Ana' WHEN 3 THEN replace(c_name, '#', '–') ELSE c_name END AS figura,
  CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN translate(split_part('{BARRIOS}', ',', CAST(o_orderkey % 50 + 1 AS INT)), '{ACCENTS[0]}', '{ACCENTS[1]}')
       ELSE split_part('{BARRIOS}', ',', CAST(o_orderkey % 50 + 1 AS INT)) END AS barrio,
  CASE WHEN o_orderkey % 11 = 0 THEN 'a confirmar'
       WHEN o_orderkey % 5 = 0 THEN CAST(day(o_orderdate) AS STRING) || '-' || CAST(month(o_orderdate) AS STRING) || '-' || CAST(year(o_orderdate) AS STRING)
       WHEN o_orderkey % 5 = 1 AND year(o_orderdate) >= 2000 THEN CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '-' || lpad(CAST(day(o_orderdate) AS STRING), 2, '0')
       WHEN o_orderkey % 5 = 2 THEN CAST(31 AS STRING) || '/' || CAST(month(o_orderdate) AS STRING) || '/' || CAST(year(o_orderdate) AS STRING)
       ELSE lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '/' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' || CAST(year(o_orderdate) AS STRING) END AS fecha,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 12 + 1 AS STRING) || ':' || lpad(CAST(o_orderkey * 7 % 60 AS STRING), 2, '0') || ' PM'
       WHEN o_orderkey % 17 = 0 THEN '18:30:00' ELSE CAST(o_orderkey % 12 + 8 AS STRING) || ':' || lpad(CAST(o_orderkey * 7 % 60 AS STRING), 2, '0') END AS hora,
  CASE WHEN o_orderkey % 9 = 0 THEN CAST(o_orderkey % 40 AS STRING) || ',5' WHEN o_orderkey % 10 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN CAST(o_orderkey % 40 AS STRING) || ' personas' ELSE CAST(o_orderkey % 40 AS STRING) END AS asistentes,
  CASE o_orderstatus WHEN 'F' THEN 'Realizado' WHEN 'O' THEN ' PROGRAMADA ' ELSE CASE o_orderkey % 3 WHEN 0 THEN 'Reprogramado' WHEN 1 THEN 'Fue suspendida' ELSE 'en agenda' END END AS status,
  CAST(o_orderkey % 23 AS INT) AS e18, CAST(o_orderkey % 7 AS INT) AS e25, CAST(o_orderkey % 5 AS INT) AS e40, CAST(o_orderkey % 3 AS INT) AS e56, CAST(o_orderkey % 2 AS INT) AS e66,
  CAST(o_orderkey % 41 AS INT) AS inscriptos, CAST(o_orderkey % 6 AS INT) AS facebook, CAST(o_orderkey % 4 AS INT) AS google, CAST(o_orderkey % 3 AS INT) AS programmatic,
  CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE CAST(o_orderkey % 15 AS STRING) END AS rrss,
  CAST(o_orderkey % 9 AS INT) AS ins_m, CAST(o_orderkey % 12 AS INT) AS unicos,
  CASE WHEN o_orderkey % 6 = 0 THEN 'true' WHEN o_orderkey % 6 = 1 THEN ' 1 ' WHEN o_orderkey % 6 = 2 THEN 'TRUE' ELSE '' END AS procesado,
  CASE WHEN o_orderkey % 6 = 3 THEN 'xyz' WHEN o_orderkey % 6 = 4 THEN 'boca' ELSE '' END AS barrio_manual,
  CAST(o_orderdate AS DATE) AS d,
  CAST(o_orderkey % 8 AS INT) AS mail, CAST(o_orderkey % 10 AS INT) AS callc, CAST(o_orderkey % 3 AS INT) AS ivr, CAST(o_orderkey % 14 AS INT) AS difusion, CAST(o_orderkey % 2 AS INT) AS otros, CAST(o_orderkey % 11 AS INT) AS ins_f,
  'Calle ' || CAST(o_orderkey % 97 AS STRING) AS direccion, 'Comuna ' || CAST(o_orderkey % 15 + 1 AS STRING) AS comuna
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
"""

AGES, CHANNELS = "e18, e25, e40, e56, e66", "facebook, google, programmatic, rrss, ins_m, unicos"

#: Sheets as filters of RAW. Base and the user's table hold some keys twice.
SHEETS = {
    "raw_all": "SELECT * FROM raw",
    "a2": "SELECT * FROM raw WHERE k % 3 <> 0",
    "b2": "SELECT * FROM raw WHERE k % 4 <> 1",
    "base": f"SELECT _row, k, name, figura, barrio, fecha, hora, asistentes, status, {AGES}, CASE WHEN k % 11 = 3 THEN inscriptos + 2 ELSE inscriptos END AS inscriptos, {CHANNELS}, procesado, barrio_manual, d, CASE WHEN k % 7 = 1 THEN mail + 1 ELSE mail END AS mail, callc, ivr, difusion, otros, ins_f, CASE WHEN k % 9 = 1 THEN '' WHEN k % 9 = 2 THEN 'Avenida 1' ELSE direccion END AS direccion, comuna FROM raw WHERE k % 5 <> 0 UNION ALL SELECT _row + {FAR}, k, name, name, barrio, fecha, hora, '7', 'en agenda', {AGES}, inscriptos, {CHANNELS}, procesado, barrio_manual, d, mail, callc, ivr, difusion, otros, ins_f, direccion, comuna FROM raw WHERE k % 40 = 1",
    "rvd": f"SELECT _row, k, name, upper(name) AS figura, barrio, fecha, CASE WHEN k % 3 = 0 THEN '' ELSE hora END AS hora, CASE WHEN k % 4 = 0 THEN '' ELSE '12' END AS asistentes, CASE WHEN k % 6 = 0 THEN 'Realizada' ELSE status END AS status, {AGES}, inscriptos, {CHANNELS}, procesado, barrio_manual, d, mail, callc, ivr, difusion, otros, ins_f, CASE WHEN k % 6 = 5 THEN '' ELSE direccion END AS direccion, CASE WHEN k % 2 = 0 THEN '' ELSE comuna END AS comuna FROM raw WHERE k % 5 <> 1",
    # Cells that hold a formula: a row for each, of the user's table and of the base.
    "rvd_formulas": "SELECT _row, 'asistentes' AS col FROM raw WHERE k % 7 = 5 AND k % 5 <> 1 UNION ALL SELECT _row, 'hora' FROM raw WHERE k % 12 = 3 AND k % 5 <> 1",
    "base_formulas": "SELECT _row, 'direccion' AS col FROM raw WHERE k % 4 = 2 AND k % 5 <> 0 UNION ALL SELECT _row, 'comuna' FROM raw WHERE k % 6 = 5 AND k % 5 <> 0",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan of few splits dealt to all cores, before costly expressions; larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < 2 * cores else df


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW, orders=spread(table(spark, sf_dir, "orders")), customer=table(spark, sf_dir, "customer"))


def sheet_of(rows: DataFrame, name: str) -> DataFrame:
    """The named sheet of rows that raw() gave."""
    return rows.sparkSession.sql(SHEETS[name].replace("FROM raw", "FROM {raw}"), raw=rows)


def sheet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sheet_of(raw(spark, sf_dir), name)


def sql_with(*names: str) -> str:
    """The WITH clause that defines raw and the named sheets for SQL."""
    parts = [f"raw AS ({RAW.format(orders='orders', customer='customer')})", *[f"{n} AS ({SHEETS[n]})" for n in names]]
    return "WITH " + ", ".join(parts)
