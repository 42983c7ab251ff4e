"""Writes that switch, writes of changed partitions only, and writes that fail at any step."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from waybill.operators import sinks
from waybill.operators.sinks import changed_groups, create_schema, replace_partitions, write_changed, write_table

KIND = "v int, pickup_year int, pickup_month int"
LAYOUT = ("pickup_year", "pickup_month")


@pytest.fixture(scope="module", autouse=True)
def schema(spark):
    create_schema(spark, "switching")


def frame(spark, values):
    return spark.createDataFrame(values, KIND)


def files_of(df):
    """Data files with the time of their last change."""
    found = df.select("_metadata.file_path", "_metadata.file_modification_time").distinct()
    return {r[0]: r[1] for r in found.collect()}


def failing_at(monkeypatch, step):
    """The step-th statement of a switch fails, as if the driver had died before it."""
    done = []

    def run(spark, statement):
        if len(done) == step:
            raise RuntimeError("lost")
        done.append(statement)
        return spark.sql(statement)

    monkeypatch.setattr(sinks, "run_step", run)
    return done


def test_switch_keeps_the_entry(spark, monkeypatch):
    done = failing_at(monkeypatch, -1)
    write_table(frame(spark, [(1, 2023, 1)]), "switching.plain")
    done.clear()
    write_table(frame(spark, [(2, 2023, 1)]), "switching.plain", comments={"v": "value"}, table_comment="a table")
    assert [s.split()[:4] for s in done][0] == ["ALTER", "TABLE", "switching.plain", "SET"] and not any("DROP" in s for s in done)
    assert rows(spark.table("switching.plain"), "v") == [(2,)]
    assert spark.catalog.listColumns("switching.plain")[0].description == "value"
    assert spark.catalog.getTable("switching.plain").description == "a table"


@pytest.mark.parametrize("layout", [(), LAYOUT])
def test_every_step_may_fail(spark, monkeypatch, layout):
    """At no point is there no table; each partition is the old or the new one; a repeat completes it."""
    name = f"switching.steps{len(layout)}"
    old, new = [(1, 2023, 1), (2, 2023, 2)], [(10, 2023, 1), (30, 2023, 3), (31, None, 3)]
    write_table(frame(spark, old), name, layout)
    step = 0
    while True:
        with monkeypatch.context() as patch:
            failing_at(patch, step)
            try:
                write_table(frame(spark, new), name, layout)
                break
            except RuntimeError:
                pass
        there = set(rows(spark.table(name)))
        assert there <= set(old) | set(new) and there
        if not layout:
            assert there == set(old)
        step += 1
    assert step == (0 if not layout else 4) + 1
    assert rows(spark.table(name)) == sorted(new, key=str)
    write_table(frame(spark, old), name, layout)
    assert rows(spark.table(name)) == old


def test_another_schema_comes_back_if_creating_fails(spark, monkeypatch):
    name = "switching.reshaped"
    write_table(frame(spark, [(1, 2023, 1)]), name, LAYOUT)
    for step in range(4):
        with monkeypatch.context() as patch:
            failing_at(patch, step)
            with pytest.raises(RuntimeError):
                write_table(spark.sql("SELECT 'x' AS v, 2024 AS pickup_year, 1 AS pickup_month"), name, LAYOUT)
        assert rows(spark.table(name)) == [(1, 2023, 1)]
    write_table(spark.sql("SELECT 'x' AS v, 2024 AS pickup_year, 1 AS pickup_month"), name, LAYOUT)
    assert rows(spark.table(name)) == [("x", 2024, 1)]


def test_failed_writes_leave_no_folder(spark):
    database = spark.catalog.getDatabase("switching").locationUri
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(database)
    listed = lambda: {s.getPath().getName() for s in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)}
    before = listed()
    with pytest.raises(Exception, match="no"):
        write_table(spark.sql("SELECT CAST(raise_error('no') AS STRING) AS v"), "switching.never")
    assert listed() == before


def test_one_month_landed_again(spark):
    name = "switching.months"
    rows_of = [(i, 2023, 1 + i % 3) for i in range(30)] + [(100, 2022, 12)]
    write_table(frame(spark, rows_of), name, LAYOUT)
    before = files_of(spark.table(name))
    assert write_changed(frame(spark, rows_of), name, LAYOUT) == []
    assert files_of(spark.table(name)) == before

    again = [(v + 1000 if m == 2 else v, y, m) for v, y, m in rows_of if y == 2023] + [(7, 2023, 4)]
    touched = write_changed(frame(spark, again), name, LAYOUT)
    assert sorted((t["pickup_year"], t["pickup_month"]) for t in touched) == [(2022, 12), (2023, 2), (2023, 4)]
    assert rows(spark.table(name)) == sorted(again, key=lambda r: tuple(map(str, r)))
    after = files_of(spark.table(name))
    kept = {f: t for f, t in before.items() if "pickup_month=1/" in f or "pickup_month=3/" in f}
    assert kept and kept.items() <= after.items() and len([f for f in before if f in after]) == len(kept)
    assert {r[0] for r in rows(spark.sql(f"SHOW PARTITIONS {name}"))} == {f"pickup_year=2023/pickup_month={m}" for m in (1, 2, 3, 4)}
    # a later whole write takes the replaced partitions' files with it
    write_table(frame(spark, rows_of[:3]), name, LAYOUT)
    assert rows(spark.table(name)) == rows_of[:3]


def test_replacing_partitions_may_fail_at_any_step(spark, monkeypatch):
    name = "switching.parts"
    old = [(1, 2023, 1), (2, 2023, 2), (3, 2023, 3)]
    write_table(frame(spark, old), name, LAYOUT)
    new, gone = [(10, 2023, 1), (20, 2023, 2), (40, 2023, 4)], [{"pickup_year": 2023, "pickup_month": 3}]
    for step in range(4):
        with monkeypatch.context() as patch:
            failing_at(patch, step)
            with pytest.raises(RuntimeError):
                replace_partitions(frame(spark, new), name, gone)
        there = rows(spark.table(name))
        assert len({m for _, _, m in there}) == len(there) and set(there) <= set(old) | set(new)
    replace_partitions(frame(spark, new), name, gone)
    assert rows(spark.table(name)) == new
    with pytest.raises(ValueError):
        replace_partitions(frame(spark, new).withColumn("more", F.lit(1)), name)


def test_changed_groups_see_every_column(spark):
    old = spark.sql("SELECT * FROM VALUES (1, 'a', 1), (1, 'a', 1), (2, NULL, 1), (3, 'c', 1), (NULL, 'n', 1) AS t(k, v, at)")
    new = spark.sql("SELECT * FROM VALUES (1, 'a', 9), (1, 'b', 9), (2, NULL, 9), (4, 'd', 9), (NULL, 'n', 9) AS t(k, v, at)")
    changed, gone = changed_groups(old, new, ["k"], ignore=("at",))
    assert sorted(g["k"] for g in changed) == [1, 4] and gone == [{"k": 3}]
    assert len(changed_groups(old, new, ["k"])[0]) == 4


def test_observed_while_writing(spark):
    seen = write_table(
        frame(spark, [(1, 2023, 1), (None, 2023, 2)]),
        "switching.seen",
        LAYOUT,
        observe={"rows": F.count(F.lit(1)), "blank": F.count_if(F.col("v").isNull())},
        rebalance=True,
    )
    assert seen == {"rows": 2, "blank": 1}
