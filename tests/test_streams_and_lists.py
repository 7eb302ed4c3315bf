"""Queries over streams and lists of files make and write their tables in many tasks, and make them once."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerbeam import catalog, storage
from tests.conftest import SMALL


@pytest.mark.parametrize(("module", "name", "batches"), [(catalog, "incremental_audit", 3), (storage, "incremental_repeats", 5)])
def test_a_batch_is_written_by_several_tasks(spark, monkeypatch, tmp_path, module, name, batches):
    monkeypatch.setattr(module, "scratch", lambda s, what: f"{tmp_path}/{what}")
    assert catalog.QUERIES[name](spark, SMALL).count() == 1
    assert len(list(Path(tmp_path, "incremental", "in").glob("part-*"))) > 2 * batches


def test_the_lists_are_made_of_one_table(spark, monkeypatch):
    """Where the table comes out otherwise each time it is computed, its copies still agree."""
    whole, lot = storage.A.sidecar, F.udf(lambda k: random.getrandbits(40), "bigint").asNondeterministic()
    monkeypatch.setattr(storage.A, "sidecar", lambda s, d: whole(s, d).withColumn("luminosityBlock", lot("ev")))
    got = {r["run"]: r["code"] for r in storage.audited_files(spark, SMALL).collect()}
    assert got["all well"] == 0 and got["codes differ"] == 6
