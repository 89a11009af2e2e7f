"""Operators on tables of their own: tables that are replaced, jobs in a row, reports, running maxima, large row numbers."""

import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from concilia.functions import cells as V
from concilia.operators import agenda as G
from concilia.operators import relational as R
from concilia.operators import report, runner, stage
from concilia.operators import steps as S
from concilia.plans import agenda, catalog, flagship
from concilia.sources.catalog import Catalogs
from concilia.sources.sinks import Table

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_table_is_replaced_at_once(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    with pytest.raises(LookupError):
        table.read()
    assert table.replace(spark.range(5), "one") and rows(table.read()) == [(k,) for k in range(5)]
    # A run that is staged and not committed (its driver was lost) leaves the old table; run again, it gives the new one.
    table.stage(spark.range(9), "two")
    assert rows(table.read()) == [(k,) for k in range(5)]
    assert table.replace(spark.range(7), "two") and rows(table.read()) == [(k,) for k in range(7)]
    # Repeated after its commit it changes nothing.
    assert not table.replace(spark.range(3), "two") and table.current() == "two" and table.read().count() == 7
    with pytest.raises(LookupError):
        table.commit("never staged")


def test_archive_is_two_tables_of_one_pass(spark, tmp_path):
    now = agenda.agenda_now(spark, SF)
    table = Table(spark, f"file://{tmp_path}/agenda")
    table.replace(G.filed(now, agenda.AS_OF), "1998-06-17", "destino")
    kept, gone = (table.read().where(F.col("destino") == x) for x in ("Agenda", "Agenda ya incorporada"))
    limit = G.filed(now, agenda.AS_OF).where("destino <> 'Agenda'").agg(F.max(G.effective_date(agenda.AS_OF))).first()[0]
    assert kept.count() + gone.count() == now.count() and gone.count() > 0 and str(limit) < "1998-06-12"
    assert rows(kept.unionByName(gone).select(*G.PLACE, *G.COLUMNS)) == rows(now.select(*G.PLACE, *G.COLUMNS))
    assert kept.where(G.effective_date(agenda.AS_OF).isNull()).count() == now.where(G.effective_date(agenda.AS_OF).isNull()).count()


def test_catalogs(spark):
    found = Catalogs(spark, here=SF, there="/root/testdata/sf0.01")
    assert found.path("there", "nada", "orders", "customer").endswith("sf0.01/orders.parquet")
    assert found.table("here", "region").count() == 5
    with pytest.raises(LookupError, match="nada | otra"):
        found.table("here", "nada", "otra")
    with pytest.raises(KeyError):
        found.table("nowhere", "region")


def test_a_failing_precondition_stops_before_any_write(spark):
    wrote = []

    def write(name, df):
        wrote.append(name)
        return spark.createDataFrame(df.collect(), df.schema)

    t = {"x": spark.range(6).withColumnRenamed("id", ' "Figurá" ')}
    good = runner.Job("y", lambda t: t["x"].toDF("n"), {"x": [("persona", "figura")]}, {"rows": F.count("*"), "odd": F.count(F.when(F.col("n") % 2 == 1, 1))})
    after = runner.Job("z", lambda t: t["y"].where("n > 3"), {"y": [("n",)]}, {"rows": F.count("*")})
    tables, said = runner.run([good, after], t, write)
    assert wrote == ["y", "z"] and (said["y"]["rows"], said["y"]["odd"], said["z"]["rows"]) == (6, 3, 2) and tables["z"].count() == 2
    wrote.clear()
    for bad in (runner.Job("w", None, {"x": [("barrio",)]}), runner.Job("w", None, {"nada": []})):
        with pytest.raises(runner.Missing):
            runner.run([good, bad], t, write)
    assert wrote == []


def test_report_lines(spark):
    one = spark.createDataFrame([(5, "b"), (2, "a"), (9, "c")], "_first long, v string").repartition(3)
    got = report.laid_out(spark, [("m", 4)], [("uno", ["V"], one, [F.col("v")]), ("dos", ["V"], one.limit(0), [F.col("v")]), ("tres", ["V", "F"], one.where("v = 'b'"), [F.col("v"), F.col("_first")])])
    assert [r.texto for r in got.orderBy("line").collect()] == ["Métrica\tValor", "m\t4", "uno", "V", "a", "b", "c", "dos", report.EMPTY, "tres", "V\tF", "b\t5"]
    assert [r.line for r in got.orderBy("line").collect()] == [1, 2, 4, 5, 6, 7, 8, 10, 11, 13, 14, 15]


def test_first_place_last_value(spark):
    df = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "x", 3), (4, None, 4)], "_row long, key string, v int")
    assert rows(report.first_place_last_value(df, "key").select("key", "_first", "_row", "v")) == [("x", 1, 3, 3), ("y", 2, 2, 2)]


@pytest.mark.parametrize("block", [1, 7, 10**6])
def test_running_max_in_blocks(spark, block):
    rng = random.Random(block)
    made = [(k, rng.choice("ab"), float(rng.randrange(30)), 5.0) for k in range(200)]
    seen, want = {}, set()
    for k, key, v, start in made:
        if v >= seen.get(key, start):
            want.add(k)
            seen[key] = v
    df = spark.createDataFrame(made, "_row long, key string, v double, cur double")
    assert {r._row for r in R.running_max(df, "key", "v", "cur", block=block).where("accepted").collect()} == want


def test_inserted_rows_have_numbers_of_their_own(spark):
    """Row numbers above 10^9, as of a large table: nothing that is inserted takes the number of a row that was there."""
    big = 10**9
    a = spark.createDataFrame([(k, f"p{k}", "Retiro", None, "9:30", "", "3", "x") for k in (2, 3, big + 2, 2 * big + 3)], "_row long, figura string, barrio string, fecha_d date, hora string, direccion string, asistentes string, status string")
    a2 = a.where(f"_row in (2, {big + 2})").withColumns({"id": F.lit(""), "asistentes": F.lit(0.0)}).withColumn("_row", F.col("_row") + 1)
    new = S.attendance_into_a2(a, a2)
    assert sorted(r._row for r in new.collect()) == [3, big + 3, S.AFTER + 3, S.AFTER + 2 * big + 3]


def test_the_base_seeds_the_mark(spark):
    base = spark.createDataFrame([(2, "k", "9"), (3, "k", "4"), (4, "t", "cuatro"), (5, None, "1")], "_row long, key string, asistentes string")
    a2 = spark.createDataFrame([(2, "k", 3.0), (3, "k", 4.0), (4, "k", 7.0), (5, "k", 6.0), (6, "k", 7.0), (7, "t", 9.0), (8, None, 5.0), (9, "new", 5.0), (10, "k", 0.0)], "_row long, base_key string, asistentes double")
    assert {r._row for r in S.marked_a2(a2, base).where("procesado").collect()} == {3, 4, 6}


def test_both_tables_are_the_two_tables(spark):
    both = flagship.Run(spark, SF).synced
    tables = S.both_tables(both, flagship.REVIEWED)
    assert rows(tables.where("tabla = 'usuario'").drop("tabla")) == rows(S.users(both, flagship.REVIEWED))
    assert rows(tables.where("tabla <> 'usuario'").drop("tabla")) == rows(S.reviewed(both, flagship.REVIEWED))
    assert {r.tipo for r in both.select(F.explode("cells.tipo").alias("tipo")).collect()} >= {"NO se rellena usuario (tiene fórmula)", "NO se rellena Para Revisar (tiene fórmula)", "NO se rellena usuario (bloqueada)"}


def test_the_agenda_keeps_what_is_manual(spark):
    schema = "_row long, id string, persona_auto string, barrio_auto string, fecha_auto date, hora_auto string, direccion_auto string, fuente string, persona_manual string, barrio_manual string, fecha_manual string, hora_manual string, direccion_manual string, listo boolean, enviado boolean, enviado_ts string"
    there = spark.createDataFrame([(k, i, "old", "old", None, "1:00", "old", "old", "P", "B", "F", "H", "D", True, False, "") for k, i in ((2, "x"), (3, "x"), (4, ""), (5, None))], schema)
    said = spark.sql("SELECT id, 'new' AS persona_auto, n AS barrio_auto, DATE '1998-06-20' AS fecha_auto, '9:30' AS hora_auto, '' AS direccion_auto, 's' AS fuente, struct(DATE '1998-06-01' AS sent, m AS msg, 0 AS pos) AS place FROM VALUES ('x', 'one', 7L), ('x', 'two', 8L), ('z', 'one', 6L), ('z', 'two', 9L) AS t(id, n, m)")
    got = {(r.origen, r._row): r for r in G.upserted(there, said).collect()}
    assert set(got) == {("agenda", 2), ("agenda", 3), ("agenda", 4), ("agenda", 5), ("mail", 6)}
    assert got["agenda", 3].barrio_auto == "two" and got["agenda", 3].barrio_manual == "B" and got["agenda", 3].listo and got["agenda", 3].fuente == "s"
    assert got["agenda", 2].barrio_auto == got["agenda", 4].barrio_auto == "old" and got["mail", 6].barrio_auto == "two" and not got["mail", 6].listo


def test_cells_of_mixed_types(spark):
    df = spark.sql("SELECT CAST('  ' AS VARIANT) AS t, CAST(0.999999 AS DOUBLE)::VARIANT AS n, TIMESTAMP_NTZ '1899-12-30 09:05:07'::VARIANT AS i, CAST(NULL AS VARIANT) AS z, 5::VARIANT AS whole, ' 5 '::VARIANT AS five, ' 9:05 '::VARIANT AS h, DATE '1998-06-17'::VARIANT AS d, '17/6/1998'::VARIANT AS dt")
    x = df.select(*[V.hora(F.col(k)).alias(k) for k in df.columns]).first()
    assert (x.t, x.n, x.i, x.h) == ("", "24:00:00", "09:05:07", "09:05:00")
    e = df.select(V.equal(F.col("t"), F.col("z")), V.equal(F.col("whole"), F.col("five")), V.equal(F.col("i"), F.col("h")), V.equal(F.col("d"), F.col("d")), V.same_day(F.col("d"), F.col("dt"), "1998-01-01"), V.same_day(F.col("n"), F.col("z"), "1998-01-01"), V.same_day(F.col("d"), F.col("z"), "1998-01-01")).first()
    assert list(e) == [True, True, False, True, True, True, False]


def test_numbers_in_plain_digits(spark):
    import duckdb

    from concilia.functions import scalars as X
    from concilia.plans import dialect as D

    rows = [(k, x) for k, x in enumerate([1 / 1013, -1 / 1013, 12345678.5, -98765432.125, 4503599627370495.5, 0.1, 1e-4, 1.25e-5, 5e-7, 1.5e-12, 2.5e-123, 3.0, -0.0, 20_000_000.0, 0.30000000000000004, None])]
    df = spark.createDataFrame(rows, "k int, x double")
    got = {r.k: r.t for r in df.select("k", X.number_text(F.col("x")).alias("t")).collect()}
    told = {k: duckdb.execute(f"SELECT {D.number_text('x')} FROM (SELECT CAST(? AS DOUBLE) AS x)", [x]).fetchone()[0] for k, x in rows}
    assert got == told
    assert [r.t for r in df.where("x = 1e0 / 1013").select(V.shown(F.col("x").cast("variant")).alias("t")).collect()] == ["0.0009871668311944718"]


def shuffle_bytes(spark):
    """Bytes of each shuffle file on this machine's disk."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name: os.path.getsize(f"{d}/{name}") for top in folders for d, _, names in os.walk(top) for name in names if re.match(r"shuffle_.*\.data$", name)}


def steps(spark):
    return set(os.listdir(stage.folder(spark.range(1)).removeprefix("file:")))


def left_on_disk(spark, job):
    """What job() returns, the folders of steps that it leaves, and the bytes of shuffle files."""
    shuffles, folders = shuffle_bytes(spark), steps(spark)
    out = job()
    for _ in range(50):  # shuffle files are removed in the background
        left = sum(n for name, n in shuffle_bytes(spark).items() if name not in shuffles)
        if not left:
            break
        time.sleep(0.1)
    return out, steps(spark) - folders, left


def test_steps_are_small_and_leave_no_shuffle_files(spark):
    df = spark.range(60_000).repartition(4, "id").select("id", F.concat(F.lit("a cell that is often the same "), F.col("id") % 7).alias("t"), *[(F.col("id") % k).alias(f"c{k}") for k in range(2, 22)])
    kept, new, left = left_on_disk(spark, lambda: stage.cut(df))
    at = [f"{stage.folder(df).removeprefix('file:')}/{x}" for x in new]
    assert left == 0 and len(at) == 1
    assert sum(os.path.getsize(f"{d}/{x}") for top in at for d, _, names in os.walk(top) for x in names) < 60_000 * 40  # 22 columns take 240 bytes a row as rows
    assert rows(kept) == rows(df) and kept.rdd.getNumPartitions() <= 4


def test_steps_of_a_step_go_with_it(spark):
    df = spark.range(1000).withColumn("n", F.col("id") % 7)
    inner = lambda: stage.cut(stage.cut(df).groupBy("n").agg(F.sum("id").alias("s")))
    out, new, left = left_on_disk(spark, lambda: stage.settled(lambda: stage.settled(inner).unionByName(inner())))
    assert len(new) == 1 and left == 0 and rows(out) == sorted([(k, sum(range(k, 1000, 7))) for k in range(7)] * 2, key=repr)


#: Steps that a query leaves for its last one, which its caller runs; before, it left all that it had written, and its shuffle files.
LEAVES = {
    "full_pipeline": 3,  # the source, the base, the two tables that met
    "pipeline_log": 3,
    "pipeline_tables": 3,
    "pipeline_base": 2,
    "backfill_base": 3,
    "pipeline_b2": 3,
    "upsert_counters": 1,
    "pipeline_user": 3,
    "fill_only_base": 4,
    "pipeline_a2": 2,
}


@pytest.mark.parametrize("name", sorted(LEAVES))
def test_queries_leave_few_steps(spark, name):
    _, new, left = left_on_disk(spark, lambda: catalog.QUERIES[name](spark, SF))
    assert len(new) <= LEAVES[name] and left == 0
