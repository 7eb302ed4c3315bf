import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerbeam.operators import audit
from ledgerbeam.plans.verdict import Refused
from ledgerbeam.sources import manifest, sinks
from ledgerbeam.streaming import incremental

ROWS = [(1, 1, k, 53, 61, 3, 0) for k in range(10)]
SIDE = "run bigint, luminosityBlock bigint, event bigint, genTtbarId int, Expanded_genTtbarId int, nAddBJets int, nAddBJetsMulti int"


def refused(f, code):
    with pytest.raises(Refused) as e:
        f()
    assert e.value.code == code


def test_manifests(spark, tmp_path):
    p = tmp_path / "list"
    p.write_text("# head\n\n  a.parquet  \nb.parquet\n#c\n")
    assert manifest.read_manifest(spark, str(p)) == ["a.parquet", "b.parquet"]
    (tmp_path / "none").write_text("# nothing\n")
    refused(lambda: manifest.read_manifest(spark, str(tmp_path / "none")), 3)
    refused(lambda: manifest.read_manifest(spark, str(tmp_path / "absent")), 3)


def test_one_file_has_one_name(tmp_path):
    (tmp_path / "d").mkdir()
    f = tmp_path / "d" / "f"
    f.write_text("")
    os.symlink(f, tmp_path / "link")
    names = [str(f), f"{tmp_path}//d/../d/./f", str(tmp_path / "link"), f"file://{f}"]
    assert len({manifest.normalise(n) for n in names}) == 1
    assert manifest.normalise("root://host.x//store/a.parquet?q=1") == "/store/a.parquet"
    refused(lambda: manifest.check_unique({"x": [names[0]], "y": [names[1]]}), 2)
    manifest.check_unique({"x": ["/a"], "y": ["/b"]})


def test_scans_fail_closed(spark, tmp_path):
    for k in range(2):
        spark.createDataFrame(ROWS[k * 5 : k * 5 + 5], SIDE).coalesce(1).write.parquet(f"{tmp_path}/f{k}")
    files = [f"{tmp_path}/f0", f"{tmp_path}/f1"]
    df = manifest.scan(spark, files)
    assert df.count() == 10 and sorted(r["pos"] for r in df.collect()) == sorted([*range(5)] * 2)
    assert manifest.row_counts(spark, files).agg(F.sum("rows")).first()[0] == 10
    manifest.check_complete(10, 10)
    refused(lambda: manifest.check_complete(9, 10), 4)
    refused(lambda: manifest.scan(spark, [*files, f"{tmp_path}/lost"]), 4)
    assert manifest.scan(spark, files, max_files=1).count() == 5
    found = manifest.columns_by_file(spark, files)
    manifest.require_columns(found, ["event"])
    refused(lambda: manifest.require_columns(found, ["Generator_x1"]), 5)
    refused(lambda: manifest.columns_by_file(spark, [f"{tmp_path}/lost"]), 5)


def test_files_are_opened_beforehand(spark, tmp_path):
    spark.createDataFrame(ROWS, SIDE).coalesce(1).write.parquet(f"{tmp_path}/f")
    lost = [f"{tmp_path}/lost{k}" for k in range(12)]
    whole = manifest.open_check(spark, [f"{tmp_path}/f"])
    assert whole.total == 10 and not whole.indicative
    with pytest.raises(Refused, match="and 2 more") as e:
        manifest.open_check(spark, [f"{tmp_path}/f", *lost], attempts=2, wait=0.01)
    assert e.value.code == 4
    part = manifest.open_check(spark, [f"{tmp_path}/f", *lost], attempts=1, allow_missing=True)
    assert part.total == 10 and part.indicative and part.bad == lost
    refused(lambda: manifest.open_check(spark, lost, attempts=1, allow_missing=True), 4)


def test_statuses_of_files(spark, tmp_path):
    spark.createDataFrame(ROWS, SIDE).coalesce(1).write.parquet(f"{tmp_path}/good")
    spark.createDataFrame([], SIDE).write.parquet(f"{tmp_path}/empty")
    spark.range(3).write.parquet(f"{tmp_path}/other")
    (tmp_path / "text").write_text("x")
    files = [f"{tmp_path}/{x}" for x in ("good", "empty", "other", "text", "lost")]
    got = [r["status"] for r in manifest.file_statuses(spark, files, ["run", "event"]).orderBy("status").collect()]
    assert got == ["bad_columns", "bad_open", "empty", "no_table", "ok"]
    df = spark.read.parquet(f"{tmp_path}/good")
    assert manifest.looped(df) == 10
    for f in (tmp_path / "good").glob("part-*"):
        f.write_bytes(f.read_bytes()[:-20])
    refused(lambda: manifest.looped(df), 10)


def test_large_events(spark):
    ok = spark.createDataFrame([(2**63 - 1,)], "event bigint").select(F.col("event").cast("decimal(20,0)"))
    assert manifest.checked_event(ok).first()["event"] == 2**63 - 1
    with pytest.raises(Exception, match="out of range"):
        manifest.checked_event(ok.select((F.col("event") + 1).cast("decimal(20,0)").alias("event"))).collect()


def test_row_files_and_dumps(spark, tmp_path):
    (tmp_path / "r").write_text("1 1 101 53 61 3 3 .25 .5 21 21\n")
    df = manifest.read_rows(spark, str(tmp_path / "r"), fingerprint=True)
    assert df.first()["Generator_x1"] == 0.25
    assert sinks.dump(df.select("run", "event"), {"format": "3"}) == ["NAMED format 3", "LEAF run bigint", "LEAF event bigint", "ROW 1 101"]


def test_staged_output(spark, tmp_path):
    out, df = f"file://{tmp_path}/out", spark.createDataFrame(ROWS, SIDE)
    sinks.write_staged({"data": df} | sinks.lookup_metadata(spark, 2, ["/b", "/a", "/b"], df.limit(1)), out)
    assert [r["dataset"] for r in spark.read.parquet(f"{out}/nano_datasets").orderBy("datasetIdx").collect()] == ["/a", "/b"]
    refused(lambda: sinks.write_staged({"data": df}, out), 4)

    def fail(*_):
        raise Refused(8, "no")

    refused(lambda: sinks.write_staged({"data": df.limit(1)}, out, replace=True, check=fail), 8)
    assert spark.read.parquet(f"{out}/data").count() == 10 and os.listdir(tmp_path) == ["out"]
    sinks.write_staged({"data": df.limit(3)}, out, replace=True)
    assert spark.read.parquet(f"{out}/data").count() == 3 and os.listdir(tmp_path) == ["out"]
    refused(lambda: sinks.write_staged({"data": df}, f"file://{tmp_path}/no/out"), 4)


def test_shards_on_disk(spark, tmp_path):
    index = sinks.write_shards(spark.createDataFrame(ROWS, SIDE), f"{tmp_path}/s", 4)
    assert sorted((r["rows"], r["first_event"], r["last_event"]) for r in index.collect()) == [(2, 8, 9), (4, 0, 3), (4, 4, 7)]
    assert spark.read.parquet(f"{tmp_path}/s_index").count() == 3


def test_text_forms(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "x string, y int")
    assert [r["value"] for r in sinks.task_tsv(df).collect()] == ["#x\ty", "a\t1", "b\t"]
    sinks.write_tsv(df.orderBy(F.desc("x")), f"file://{tmp_path}/plan.tsv")
    assert (tmp_path / "plan.tsv").read_text() == "#x\ty\nb\t\na\t1\n"
    refused(lambda: sinks.write_tsv(df, f"file://{tmp_path}/plan.tsv"), 4)
    with pytest.raises(Exception, match="bad cell"):
        sinks.task_tsv(spark.createDataFrame([("a\tb",)], "x string")).collect()
    assert json.loads(sinks.counters_json(df.limit(1)).first()["value"]) == {"x": "a", "y": 1}
    assert json.loads(sinks.maps_json({"m": {61: 2, 5: 1}})) == {"m": {"5": 1, "61": 2}}
    sinks.order_csv(df, f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).count() == 2
    sinks.write_sidecar(spark.createDataFrame(ROWS, SIDE), f"{tmp_path}/side")


def test_chunk_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"sample": "s", "chunk": 1, "matched": 5, "expanded_sub_counts": {"61": 2}}, indent=1))
    (tmp_path / "b.json").write_text("{broken")
    got = manifest.read_chunks(spark, [f"{tmp_path}/a.json", f"{tmp_path}/b.json"]).cache()
    assert got.where("corrupt is not null").count() == 1 and got.where("matched = 5").first()["expanded_sub_counts"] == {"61": 2}


def test_walks_and_catalogues(spark, tmp_path):
    for name in ("sidecar_1.bin", "other.bin", "extend_2.bin"):
        (tmp_path / name).write_text("x")
    assert manifest.walk(spark, str(tmp_path), ("sidecar", "extend")).count() == 2
    cat = manifest.catalogue(spark, json.dumps({"2017": {"datasets": [{"name": "a", "dataset": "/A/B/C", "enabled": True}]}}))
    assert cat.first()["era"] == "2017" and cat.first()["enabled"]


def test_incremental_counters(spark, tmp_path):
    side = spark.createDataFrame(ROWS, SIDE)
    for k in range(3):
        side.where(F.col("event") % 3 == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    reference = side.select(*audit.KEY, "genTtbarId")
    q = incremental.incremental_counters(incremental.stream(spark, f"{tmp_path}/in", side.schema, 1), reference, f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(120)
    row = incremental.totals(spark, f"{tmp_path}/out", reference).first()
    assert row["matched"] == row["agree"] == 10 and row["disagree"] == row["unmatched"] == row["n_dup"] == 0
    # the same files again, and a reference with a row that nothing matches
    side.where(F.col("event") % 3 == 0).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    incremental.incremental_counters(incremental.stream(spark, f"{tmp_path}/in", side.schema, 1), reference, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    more = reference.unionByName(reference.limit(1).withColumn("event", F.lit(10**6).cast("bigint")))
    row = incremental.totals(spark, f"{tmp_path}/out", more).first()
    assert (row["nano_entries"], row["matched"], row["unmatched"], row["n_dup"]) == (11, 10, 1, 4)
    assert incremental.census(spark, f"{tmp_path}/out").agg(F.sum("n")).first()[0] == 10
