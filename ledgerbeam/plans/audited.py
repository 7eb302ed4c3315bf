"""The audit of two lists of files from beginning to end."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import audit
from ..sources import manifest
from .verdict import AUDIT, Verdict


def audit_files(spark: SparkSession, nano: list[str], side: list[str], attempts: int = 3, wait: float = 10.0, allow_missing: bool = False, checks=AUDIT) -> Verdict:
    """The verdict over the rows of nano against those of side, with nano_entries_opencheck and nano_entries_postloop, the rows that
    the footers have before and after, and indicative.

    Refused: 2 if a file is given twice, 4 if files can't be opened (unless allow_missing, which leaves them out) or if the rows
    read aren't those that the footers had, 5 if columns are lacking, 10 if reading fails.
    """
    manifest.check_unique({"nano": nano, "side": side})
    before = {name: manifest.open_check(spark, files, attempts, wait, allow_missing=allow_missing) for name, files in (("nano", nano), ("side", side))}
    left, right = ([f for f in files if f not in set(before[name].bad)] for name, files in (("nano", nano), ("side", side)))
    manifest.require_columns(manifest.columns_by_file(spark, left), [*audit.KEY, "genTtbarId"])
    manifest.require_columns(manifest.columns_by_file(spark, right), [*audit.KEY, *audit.PAYLOAD])
    rows = [manifest.scan(spark, files).select(*columns) for files, columns in ((left, [*audit.KEY, "genTtbarId"]), (right, [*audit.KEY, *audit.PAYLOAD]))]
    manifest.looped(rows[1])
    found = audit.verdict(*rows, checks)
    manifest.check_complete(found.counters["nano_entries"], before["nano"].total)
    after = manifest.open_check(spark, left, 1).total
    manifest.check_complete(after, before["nano"].total)
    counters = found.counters | {"nano_entries_opencheck": before["nano"].total, "nano_entries_postloop": after, "indicative": any(x.indicative for x in before.values())}
    return Verdict(found.code, found.failed, counters)
