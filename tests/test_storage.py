"""Parts with an index, bucketed tables, probes of files, reading that resumes."""

import os

import pytest

from pyspark.sql import functions as F

from ledgerbeam.operators import audit
from ledgerbeam.plans.verdict import Refused
from ledgerbeam.sources import parts, probe

SIDE = "run bigint, luminosityBlock bigint, event bigint, genTtbarId int, Expanded_genTtbarId int, nAddBJets int, nAddBJetsMulti int"


def events(spark, n, runs=3):
    """n rows over some runs, with gaps in the events."""
    k = F.col("id")
    return spark.range(n).select(
        (k % runs + 1).alias("run"), F.call_function("div", k, F.lit(500)).alias("luminosityBlock"), (k * 3).alias("event"), (k % 60).cast("int").alias("genTtbarId"),
        (k % 60).cast("int").alias("Expanded_genTtbarId"), (k % 3).cast("int").alias("nAddBJets"), F.lit(0).alias("nAddBJetsMulti"),
    )


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_parts_are_exact_sorted_and_indexed(spark, tmp_path):
    index = parts.write_parts(events(spark, 10_250), f"{tmp_path}/p", 1000)
    assert sorted((r["part"], r["rows"]) for r in index.collect()) == [*((k, 1000) for k in range(10)), (10, 250)]
    key = F.struct(*parts.KEY)
    back = spark.read.parquet(f"{tmp_path}/p").groupBy("part").agg(F.count("*").alias("n"), F.min(key).alias("a"), F.max(key).alias("b")).orderBy("part").collect()
    assert [r["n"] for r in back] == [1000] * 10 + [250]
    assert all(tuple(x["b"]) < tuple(y["a"]) for x, y in zip(back, back[1:]))
    for folder, _, names in os.walk(tmp_path / "p"):
        for name in (n for n in names if n.endswith(".parquet")):
            rows = [tuple(r) for r in spark.read.parquet(f"{folder}/{name}").select(*parts.KEY).collect()]
            assert rows == sorted(rows)


def test_a_narrow_lookup_reads_few_files(spark, tmp_path):
    out, side = f"{tmp_path}/p", events(spark, 20_000)
    parts.write_parts(side, out, 500)
    probe = side.where("luminosityBlock = 7 and event % 9 = 0").select(*parts.KEY, "genTtbarId")
    found = parts.lookup(probe, out)
    assert found.where("side is null").count() == 0 and found.count() == probe.count() > 0
    assert len(found.inputFiles()) - len(probe.inputFiles()) < 12 < len(spark.read.parquet(out).inputFiles())
    assert len(parts.parts_hit(probe, out)) <= 6
    whole = {tuple(r[:3]): r["side"] for r in audit.match(probe, side).collect()}
    assert {tuple(r[:3]): r["side"] for r in found.collect()} == whole


def test_lookups_outside_all_parts(spark, tmp_path):
    out, side = f"{tmp_path}/p", events(spark, 2000)
    parts.write_parts(side, out, 300)
    away = side.limit(5).select((F.col("run") + 90).alias("run"), "luminosityBlock", "event", "genTtbarId")
    assert parts.parts_hit(away, out) == []
    assert [r["side"] for r in parts.lookup(away, out).collect()] == [None] * 5
    between = side.where("event = 30").select("run", "luminosityBlock", (F.col("event") + 1).alias("event"), "genTtbarId")
    assert [r["side"] for r in parts.lookup(between, out).collect()] == [None]
    assert parts.parts_hit(side, out) == list(range(7))
    none = side.limit(0)
    assert parts.parts_hit(none, out) == []


def test_equal_keys_on_a_border_are_found_in_both_parts(spark, tmp_path):
    same = spark.createDataFrame([(1, 1, 5, k, k, 0, 0) for k in range(7)] + [(1, 1, 9, 0, 0, 0, 0)], SIDE)
    out = f"{tmp_path}/p"
    parts.write_parts(same, out, 3)
    probe = spark.createDataFrame([(1, 1, 5, 0)], "run bigint, luminosityBlock bigint, event bigint, genTtbarId int")
    assert parts.parts_hit(probe, out) == [0, 1, 2]
    assert parts.lookup(probe, out).first()["side_rows"] == 7


def test_a_bucketed_side_is_not_exchanged(spark, tmp_path):
    side = events(spark, 5000)
    table = parts.write_bucketed(side, f"{tmp_path}/b", f"side_{os.path.basename(tmp_path)}".replace("-", "_"), 8)
    assert len([n for n in os.listdir(tmp_path / "b") if n.endswith(".parquet")]) == 8
    probe = side.select(*parts.KEY, "genTtbarId")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain, bucketed = audit.match(probe, side), audit.match(probe, parts.open_bucketed(spark, table))
        assert (exchanges(plain), exchanges(bucketed)) == (2, 1)
        assert bucketed.where("side is not null").count() == 5000
        spark.sql(f"DROP TABLE {table.name}")
        again = audit.match(probe, parts.open_bucketed(spark, table))
        assert exchanges(again) == 1 and again.where("side.genTtbarId = genTtbarId").count() == 5000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_thousand_files_are_probed_in_one_job(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for k in range(1000):
        pq.write_table(pa.table({"run": list(range(k % 5)), "event": list(range(k % 5))}), tmp_path / f"{k:04d}.parquet")
    broken, lost, other = (f"{tmp_path}/{k:04d}.parquet" for k in (11, 12, 13))
    open(broken, "wb").write(b"PAR1 not a table PAR1")
    os.unlink(lost)
    pq.write_table(pa.table({"run": [1]}), other)
    files = [f"{tmp_path}/{k:04d}.parquet" for k in range(1000)]
    states = {r["file"]: r for r in probe.probe(probe.table_of(spark, files), ["run", "event"], attempts=2, wait=0.01).collect()}
    assert len(states) == 1000
    assert (states[broken]["status"], states[lost]["status"], states[other]["status"]) == ("no_table", "bad_open", "bad_columns")
    assert states[lost]["round"] == 1 and states[broken]["round"] == 0
    assert sum(r["status"] == "empty" for r in states.values()) == 200 and states[files[4]]["rows"] == 4


def test_a_file_that_comes_late_is_found_by_a_later_round(spark, tmp_path):
    import threading

    import pyarrow as pa
    import pyarrow.parquet as pq

    late = f"{tmp_path}/late.parquet"
    threading.Timer(2.0, lambda: pq.write_table(pa.table({"run": [1, 2]}), late)).start()
    row = probe.probe(probe.table_of(spark, [late]), attempts=4, wait=2.0).first()
    assert row["status"] == "ok" and row["rows"] == 2 and row["round"] > 0


def flaky(folder, always=()):
    """Opens each file only at the second attempt, and those in always never."""

    def opener(path):
        mark = f"{folder}/{os.path.basename(path)}.seen"
        if path in always or not os.path.exists(mark):
            open(mark, "w").close()
            raise OSError("connection lost")
        return pa.OSFile(path), os.path.getsize(path)

    import pyarrow as pa

    return opener


def test_reading_takes_up_what_was_lost(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for k in range(4):
        pq.write_table(pa.table({"run": list(range(10)), "x": [k] * 10}), tmp_path / f"{k}.parquet", row_group_size=5)
    marks = tmp_path / "marks"
    marks.mkdir()
    for k in (1, 2):
        (marks / f"{k}.parquet.seen").touch()
    files = [f"{tmp_path}/{k}.parquet" for k in range(4)]
    states = probe.probe(probe.table_of(spark, files), ["run"])
    schema = spark.createDataFrame([], "run bigint").schema
    rows, ledger = probe.read(states, schema, wait=0.01, per_task=2, reader=flaky(marks))
    assert rows.count() == 40 and rows.agg(F.sum("run")).first()[0] == 4 * 45
    rounds = {(os.path.basename(r["path"]), r["round"]): r for r in ledger.groupBy("path", "round").agg(F.count("read").alias("read"), F.count("error").alias("failed")).collect()}
    assert rounds["1.parquet", 0]["failed"] == 0 and ("1.parquet", 1) not in rounds
    assert rounds["0.parquet", 0]["failed"] >= 1 and rounds["0.parquet", 1]["read"] == rounds["0.parquet", 0]["failed"]
    assert ledger.where("read is not null").dropDuplicates(["path", "group"]).count() == 8 == ledger.where("read is not null").count()
    with pytest.raises(Refused) as e:
        probe.read(states, schema, wait=0.01, reader=flaky(marks, always=(files[3],)))
    assert e.value.code == 10 and files[3] in e.value.why and files[2] not in e.value.why


def test_a_file_that_changed_since_the_probe_is_no_ok(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = f"{tmp_path}/a.parquet"
    pq.write_table(pa.table({"run": list(range(10))}), path)
    states = probe.probe(probe.table_of(spark, [path]), ["run"])
    assert [r["status"] for r in probe.statuses(states, ["run"]).collect()] == ["ok"]
    pq.write_table(pa.table({"run": list(range(500))}), path)
    assert [r["status"] for r in probe.statuses(states, ["run"]).collect()] == ["read_errors"]
    with pytest.raises(Refused, match="exit 10"):
        probe.read(states, spark.createDataFrame([], "run bigint").schema, wait=0.01)


def test_nothing_to_probe(spark):
    states = probe.probe(probe.table_of(spark, []))
    assert states.count() == 0 and probe.statuses(states, ["x"]).count() == 0
    rows, ledger = probe.read(states, spark.createDataFrame([], "run bigint").schema)
    assert rows.count() == 0 and ledger.count() == 0


def test_files_of_a_store_that_only_spark_knows(spark, tmp_path):
    from ledgerbeam.sources import manifest

    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.probe.link./in", f"file://{tmp_path}")
    spark.range(7).write.parquet(f"{tmp_path}/good")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.parquet").write_text("no table")
    files = [f"viewfs://probe/in/{x}" for x in ("good", "bad", "lost")]
    states = {r["file"].rsplit("/", 1)[1]: (r["status"], r["rows"]) for r in probe.probe(probe.table_of(spark, files), ["id"], attempts=1).collect()}
    assert states == {"good": ("ok", 7), "bad": ("no_table", None), "lost": ("bad_open", None)}
    assert manifest.open_check(spark, files, attempts=1, allow_missing=True).total == 7
    assert sorted(r["status"] for r in manifest.file_statuses(spark, files, ["id", "x"]).collect()) == ["bad_columns", "bad_open", "no_table"]
    with pytest.raises(ValueError, match="no ranges"):
        probe.read(probe.probe_once(probe.table_of(spark, files[:1])), spark.range(1).schema)
