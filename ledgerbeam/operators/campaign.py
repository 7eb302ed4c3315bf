"""Roll-up of chunks to samples, and the bookkeeping of files, jobs and catalogues."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .audit import MUST_BE_ZERO

SUMS = (
    "nano_entries", "matched", "unmatched", "agree", "disagree", "nAddBJets_ge3", "expanded_sub_in_set",
    "viol_ext_but_lt3", "viol_ge3_not_ext", "viol_prefix_changed", "viol_le2_changed",
)
VIOLATIONS = SUMS[-4:]
#: Job states with a column of their own, and those known to go to "others" (fixed values).
STATES = ("finished", "running", "idle", "transferring", "failed")
OTHER_STATES = ("unsubmitted", "cooloff", "held", "killed", "killing", "toRetry", "on hold", "resubmitting")
MOST_JOBS = 10_000


def rollup(chunks: DataFrame, by: str = "sample") -> DataFrame:
    """Sums of the chunks' counters."""
    return chunks.groupBy(by).agg(F.count("*").alias("chunks"), *(F.sum(c).alias(c) for c in SUMS))


def merge_maps(chunks: DataFrame, column: str, by: str = "sample") -> DataFrame:
    """The chunks' integer maps added up by key, as rows."""
    return chunks.select(by, F.explode(column).alias("key", "n")).groupBy(by, "key").agg(F.sum("n").alias("n"))


def sample_verdict(chunks: DataFrame, expected: DataFrame, plan: DataFrame | None = None) -> DataFrame:
    """A row per sample with a column per criterion and passed.

    expected: sample, n_chunks, n_events, skip.  A missing expectation fails; only an explicit skip passes.
    plan: sample, chunk, the chunks that are expected.  A chunk that isn't in it counts for nothing, one that is must be there,
    and a sample without any fails.  n_chunks is for callers who know the number of chunks only.
    """
    if plan is not None:
        known = plan.select("sample", "chunk").distinct()
        lost = missing_chunks(known, chunks.select("sample", "chunk").distinct()).groupBy("sample").agg(F.count("*").alias("_lost"))
        wanted = known.groupBy("sample").agg(F.count("*").alias("_wanted")).join(lost, "sample", "left")
        # without a loss the chunks found are those wanted
        wanted = wanted.select("sample", F.when(F.col("_lost").isNull(), F.col("_wanted")).alias("n_chunks"))
        expected = expected.drop("n_chunks").join(wanted, "sample", "full_outer")
        chunks = chunks.join(known, ["sample", "chunk"], "left_semi")
    bad = F.count_if(F.col("exit_code") != 0)
    anomalies = F.count_if(
        F.coalesce(F.col("nano_entries") != F.col("nano_entries_opencheck"), F.lit(True)) | F.coalesce(F.col("nano_entries_postloop") != F.col("nano_entries"), F.lit(True)) | F.col("job_failed")
    )
    sums = chunks.groupBy("sample").agg(F.count_distinct("chunk").alias("chunks"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS), bad.alias("bad_exits"), anomalies.alias("anomalies"))
    all_ = expected.join(sums, "sample", "full_outer")
    none = lambda c: F.coalesce(c, F.lit(False))
    criteria = {
        "chunks_present": none(F.col("chunks") == F.col("n_chunks")),
        "events_expected": none(F.col("skip")) | none(F.col("nano_entries") == F.col("n_events")),
        "some_matched": none(F.col("matched") > 0),
        "none_unmatched": none(F.col("unmatched") == 0),
        "none_disagree": none(F.col("disagree") == 0),
        "conserved": none(F.col("nAddBJets_ge3") == F.col("expanded_sub_in_set")),
        "no_violations": none(sum((F.col(c) for c in VIOLATIONS[1:]), F.col(VIOLATIONS[0])) == 0),
        "exits_zero": none(F.col("bad_exits") == 0),
        "no_anomalies": none(F.col("anomalies") == 0),
    }
    out = all_.select("sample", *(c.alias(k) for k, c in criteria.items()))
    passed = F.lit(True)
    for k in criteria:
        passed = passed & F.col(k)
    return out.withColumn("passed", passed)


def report(verdicts: DataFrame) -> DataFrame:
    """One row per sample and criterion."""
    names = [c for c in verdicts.columns if c not in ("sample", "passed")]
    return verdicts.unpivot(["sample"], names, "criterion", "holds")


def missing_chunks(expected: DataFrame, present: DataFrame) -> DataFrame:
    return expected.join(present, ["sample", "chunk"], "left_anti")


def chunk_states(chunks: DataFrame, results: DataFrame, queue: DataFrame) -> DataFrame:
    """sample, chunk, state: a queued job overrides an older result; several queued jobs are duplicates."""
    q = queue.groupBy("sample", "chunk").agg(F.count("*").alias("queued"), F.max("job_state").alias("job_state"))
    out = chunks.join(results.select("sample", "chunk", "exit_code"), ["sample", "chunk"], "left").join(q, ["sample", "chunk"], "left")
    state = (
        F.when(F.col("queued") > 1, "duplicate").when(F.col("queued") == 1, F.col("job_state")).when(F.col("exit_code").isNull(), "missing")
        .when(F.col("exit_code") == 0, "done").otherwise("failed")
    )
    return out.select("sample", "chunk", state.alias("state"))


def id_gaps(jobs: DataFrame, n: int, job: str = "job") -> DataFrame:
    """Ids against 1..n: id and whether it is missing, extra or duplicate."""
    want = jobs.sparkSession.range(1, n + 1).select(F.col("id").alias(job), F.lit(True).alias("want"))
    have = jobs.groupBy(job).agg(F.count("*").alias("times"))
    both = want.join(have, job, "full_outer")
    status = F.when(F.col("times").isNull(), "missing").when(F.col("want").isNull(), "extra").when(F.col("times") > 1, "duplicate")
    return both.select(job, status.alias("status")).where("status is not null")


def job_states(jobs: DataFrame, by: str = "task", state: str = "state") -> DataFrame:
    """Jobs by state, with a TOTAL row; others counts all states without a column, unknown lists those nobody has heard of."""
    own = lambda *names: F.coalesce(F.col(state).isin(*names), F.lit(False))
    strange = F.when(~own(*STATES, *OTHER_STATES), F.coalesce(F.col(state), F.lit("")))
    out = jobs.rollup(by).agg(
        *(F.count_if(own(s)).alias(s) for s in STATES), F.count_if(~own(*STATES)).alias("others"), F.count("*").alias("total"),
        F.array_sort(F.collect_set(strange)).alias("unknown"),
    )
    return out.withColumn(by, F.coalesce(F.col(by), F.lit("TOTAL")))


def job_guard(tasks: DataFrame, most: int = MOST_JOBS) -> DataFrame:
    """tasks (n_files, units) with jobs = ceil(n_files / units) and status OK, WARN over 90 %, FAIL over most."""
    jobs = F.ceil(F.col("n_files") / F.col("units")).cast("bigint")
    return tasks.withColumn("jobs", jobs).withColumn("status", F.when(F.col("jobs") > most, "FAIL").when(F.col("jobs") > 0.9 * most, "WARN").otherwise("OK"))


def name_clashes(names: DataFrame, name: str, member: str) -> DataFrame:
    return names.groupBy(name).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(member)).alias("members")).where("n > 1")


def reconcile(catalogue: DataFrame, lineage: DataFrame) -> DataFrame:
    """child, catalogue parent against the recorded ones: NOT CHECKED unless one parent is recorded, then ABSENT, EMPTY, MATCH or MISMATCH."""
    by = lineage.groupBy("child").agg(F.count("parent").alias("parents"), F.min("parent").alias("found"))
    both = catalogue.join(by, "child", "full_outer")
    status = (
        F.when(F.coalesce("parents", F.lit(0)) != 1, "NOT CHECKED").when(F.col("entry").isNull(), "ABSENT").when(F.coalesce("parent", F.lit("")) == "", "EMPTY")
        .when(F.col("parent") == F.col("found"), "MATCH").otherwise("MISMATCH")
    )
    return both.select("child", "parent", "found", status.alias("status"))


def fillable(reconciled: DataFrame, prefix: str = "") -> DataFrame:
    """The catalogue's entries without a parent, and whether one can be written: one is recorded, of the child's primary part and with the campaign's prefix."""
    part = lambda c, k: F.split_part(c, F.lit("/"), F.lit(k))
    ok = (F.col("status") == "EMPTY") & (part("found", 2) == part("child", 2)) & part("found", 3).startswith(prefix)
    empty = reconciled.where((F.col("status") == "EMPTY") | ((F.col("status") == "NOT CHECKED") & (F.col("parent") == "")))
    return empty.select("child", "found", F.coalesce(ok, F.lit(False)).alias("ok"))


def update_parents(reconciled: DataFrame, catalogue: DataFrame, prefix: str = "") -> tuple[DataFrame, bool]:
    """The catalogue with empty parents filled in, if every one of them can be; else as it was.

    The new catalogue is checked before it is returned: only empty parents have changed, and each now holds the one recorded.
    """
    empty = F.coalesce("parent", F.lit("")) == ""
    todo = fillable(reconciled, prefix)
    row = todo.agg(F.count("*").alias("n"), F.count_if("ok").alias("ok")).first()
    if not row["n"] or row["ok"] != row["n"] or catalogue.where(empty).join(todo, "child", "left_anti").limit(1).count():
        return catalogue, False
    filled = catalogue.join(todo.select("child", "found"), "child", "left").withColumn("parent", F.when(empty, F.col("found")).otherwise(F.col("parent"))).select(*catalogue.columns)
    old, new = (df.select("child", F.coalesce("parent", F.lit("")).alias(name)) for df, name in ((catalogue, "old"), (filled, "new")))
    bad = old.join(new, "child", "full_outer").join(todo.select("child", "found"), "child", "left").where(
        ~F.coalesce(F.when(F.col("old") == "", F.col("new") == F.col("found")).otherwise(F.col("new") == F.col("old")), F.lit(False))
    )
    return (catalogue, False) if bad.limit(1).count() else (filled, True)


def apply_matches(reconciled: DataFrame, catalogue: DataFrame) -> tuple[DataFrame, bool]:
    """enabled and verified set on all entries, if every one is a match."""
    ok = reconciled.where("status <> 'MATCH'").limit(1).count() == 0 and reconciled.limit(1).count() == 1
    return (catalogue.withColumns({"enabled": F.lit(True), "verified": F.lit(True)}), True) if ok else (catalogue, False)


#: Data tier version in a dataset's name.
VERSION = r"(NanoAOD[A-Za-z]*v[0-9]+)"
#: Parts of campaigns that mark a special reprocessing (fixed values).
FLAVOUR = r"JMENano|BTVNano|PFNano|MuonNano|TauNano|EGMNano|HIGNano|PUFor|PU35For|FSUL|BPH_"


def latest_version(children: DataFrame, want: str, by: str = "parent", name: str = "child", pos: str | None = None) -> DataFrame:
    """Of the children of version want (v9: NanoAODv9 or NanoAODAPVv9): the plain one with the highest -vN at the end of its
    campaign, the first of these by pos (default: name); without a plain one the first of all, with version -1."""
    campaign = F.split_part(name, F.lit("/"), F.lit(3))
    token = F.regexp_extract(campaign, VERSION, 1)
    v = F.coalesce(F.expr("try_cast(regexp_extract(_campaign, '-v([0-9]+)$', 1) AS int)"), F.lit(0))
    rows = children.withColumn("_campaign", campaign).where(token.isin(f"NanoAOD{want}", f"NanoAODAPV{want}"))
    rows = rows.select(by, name, F.col(pos or name).alias("_pos"), F.when(F.col("_campaign").rlike(FLAVOUR), F.lit(-1)).otherwise(v).alias("_v"))
    best = rows.groupBy(by).agg(F.max("_v").alias("version"), F.collect_list(F.struct("_v", "_pos", name)).alias("c"))
    least = F.array_min(F.transform(F.filter("c", lambda x: x["_v"] == F.col("version")), lambda x: F.struct(x["_pos"].alias("p"), x[name].alias(name))))
    return best.select(by, least[name].alias(name), "version")


def lineage_verdicts(entries: DataFrame, children: DataFrame) -> DataFrame:
    """entries (entry, parent, version such as v9, maybe recorded) against children (entry, child, parent): entry, status, child, recorded.

    SAME_PARENT where a child of the entry's own parent names that version, NanoAODv9 or NanoAODAPVv9.  Else DIFFERENT_PARENT
    where the parent's primary has such a dataset of the same era, the part of the parent's campaign before MiniAOD; NanoAODAPV
    is looked for where there is no plain one.  Else VERSION_ABSENT.  child stands for what was found: of the entry's own
    children by the rule of latest_version.  recorded tells whether the recorded child is one of the parent's.
    """
    part = lambda c, k: F.split_part(F.col(c), F.lit("/"), F.lit(k))
    recorded = F.col("recorded") if "recorded" in entries.columns else F.lit(None).cast("string")
    asked = entries.select("entry", "parent", "version", recorded.alias("_recorded"), part("parent", 2).alias("_primary"), F.split(part("parent", 3), "MiniAOD")[0].alias("_era"))
    found = children.select(F.col("entry").alias("_e"), "child", F.col("parent").alias("_of"), part("child", 2).alias("_p"), part("child", 3).alias("_c"))
    both = asked.join(found, F.col("entry") == F.col("_e"), "left")
    own = F.coalesce(F.col("parent") == F.col("_of"), F.lit(False))
    token, version = F.regexp_extract("_c", VERSION, 1), F.col("version")
    same = own & ((token == F.concat(F.lit("NanoAOD"), version)) | (token == F.concat(F.lit("NanoAODAPV"), version)))
    special, v = F.col("_c").rlike(FLAVOUR), F.coalesce(F.expr("try_cast(regexp_extract(_c, '-v([0-9]+)$', 1) AS int)"), F.lit(0))
    # an entry whose parent is no dataset's path has no primary and no era to go by
    primary = (F.col("_primary") == "") | (F.col("_primary") == F.col("_p"))
    of_era = lambda tier: primary & F.col("_c").startswith(F.concat("_era", F.lit(tier), version))
    by = both.groupBy("entry").agg(
        F.min(F.when(same, F.struct(special.alias("s"), F.when(special, 0).otherwise(-v).alias("v"), F.col("child").alias("child")))).alias("best"),
        F.min(F.when(of_era("NanoAOD"), F.col("child"))).alias("plain"), F.min(F.when(of_era("NanoAODAPV"), F.col("child"))).alias("apv"),
        F.max(F.col("_recorded")).alias("_recorded"), F.count_if(own & (F.col("child") == F.col("_recorded"))).alias("_listed"),
    )
    other = F.coalesce("plain", "apv")
    status = F.when(F.col("best").isNotNull(), "SAME_PARENT").when(other.isNotNull(), "DIFFERENT_PARENT").otherwise("VERSION_ABSENT")
    listed = F.when(F.col("_recorded").isNotNull(), F.when(F.col("_listed") > 0, "IN_CHILD_LIST").otherwise("NOT_IN_CHILD_LIST"))
    return by.select("entry", status.alias("status"), F.coalesce(F.col("best.child"), other).alias("child"), listed.alias("recorded"))


def child_lineage(entries: DataFrame, children: DataFrame) -> DataFrame:
    """lineage_verdicts' entry and status."""
    return lineage_verdicts(entries, children).select("entry", "status")


def lineage_fanout(files: DataFrame, answers: DataFrame) -> DataFrame:
    """files against answers (file, parent, error): matched, orphan, errored."""
    by = answers.groupBy("file").agg(F.count("parent").alias("parents"), F.count("error").alias("errors"))
    out = files.dropDuplicates(["file"]).join(by, "file", "left")
    status = F.when(F.coalesce("errors", F.lit(0)) > 0, "errored").when(F.coalesce("parents", F.lit(0)) > 0, "matched").otherwise("orphan")
    return out.select("file", status.alias("status"))


def dedup_in_order(rows: DataFrame, key: str, pos: str) -> DataFrame:
    """The first of each key, with its position."""
    return rows.groupBy(key).agg(F.min(pos).alias(pos))


def one_timestamp(files: DataFrame, by: str = "sample", path: str = "path") -> DataFrame:
    """Samples and their number of distinct submission times in paths; ok if exactly one."""
    stamp = F.regexp_extract(path, r"/(\d{6}_\d{6})/", 1)
    return files.groupBy(by).agg(F.count_distinct(F.when(stamp != "", stamp)).alias("stamps")).withColumn("ok", F.col("stamps") == 1)


def production_check(tasks: DataFrame, files: DataFrame, samples: DataFrame) -> DataFrame:
    """task, status DONE or CHECK FAILED: one timestamp, ids exactly 1..n_jobs once each, rows as expected, and the invariants.

    samples: task, entries and passed, from the check of the task's files (sample_checks); a task without one fails.
    """
    ids = files.withColumn("job", F.regexp_extract("path", r"_(\d+)\.[a-z]+$", 1).cast("int"))
    by = ids.groupBy("task").agg(
        F.count_distinct(F.regexp_extract("path", r"/(\d{6}_\d{6})/", 1)).alias("stamps"), F.count("job").alias("n"), F.count_distinct("job").alias("d"), F.min("job").alias("lo"), F.max("job").alias("hi")
    )
    ok = (F.col("stamps") == 1) & (F.col("n") == F.col("n_jobs")) & (F.col("d") == F.col("n_jobs")) & (F.col("lo") == 1) & (F.col("hi") == F.col("n_jobs"))
    ok = ok & F.col("passed") & (F.col("entries") == F.col("n_events"))
    return tasks.join(by, "task", "left").join(samples, "task", "left").select("task", F.when(F.coalesce(ok, F.lit(False)), "DONE").otherwise("CHECK FAILED").alias("status"))


def sample_checks(by_file: DataFrame, by: str = "task") -> DataFrame:
    """by, entries and passed (no invariant broken, no file unreadable) of audit.by_file's rows."""
    broken = reduce(or_, (F.col(c) > 0 for c in MUST_BE_ZERO))
    bad = F.count_if(broken | F.col("unreadable")) if "unreadable" in by_file.columns else F.count_if(broken)
    return by_file.groupBy(by).agg(F.sum("entries").alias("entries"), (bad == 0).alias("passed"))


def throughput(snapshots: DataFrame, by: str = "task", most: int = 12, stall: float = 8 * 3600.0) -> DataFrame:
    """Rate over the last 12 snapshots (t seconds, done, total), what is left at that rate (null unless something moved), and
    stalled where done hasn't grown for stall seconds and isn't total."""
    w = Window.partitionBy(by).orderBy("t").rowsBetween(1 - most, 0)
    upto = Window.partitionBy(by).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    span, moved = F.greatest(F.col("t") - F.first("t").over(w), F.lit(1)), F.col("done") - F.first("done").over(w)
    out = snapshots.withColumn("_best", F.max("done").over(Window.partitionBy(by).orderBy("t").rowsBetween(Window.unboundedPreceding, -1)))
    out = out.withColumn("_progress", F.max(F.when(F.col("_best").isNull() | (F.col("done") > F.col("_best")), F.col("t"))).over(upto))
    out = out.withColumns({"rate": F.when(moved > 0, moved / span), "stalled": (F.col("done") < F.col("total")) & (F.col("t") - F.col("_progress") >= stall)})
    return out.withColumn("eta", (F.col("total") - F.col("done")) / F.col("rate")).drop("_best", "_progress")


def chunk_files(manifest: DataFrame, per_chunk: int, sample: str = "sample", path: str = "path") -> DataFrame:
    """manifest with chunk: per_chunk paths each, in order of path."""
    return manifest.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(sample).orderBy(path)) - 1) / per_chunk))


def select_entries(catalogue: DataFrame, era: str | None = None, process: str | None = None, request: str | None = None, enabled: bool | None = None) -> DataFrame:
    out = catalogue
    for column, value in (("era", era), ("process", process), ("request", request), ("enabled", enabled)):
        if value is not None:
            out = out.where(F.col(column) == value)
    return out


def campaign_match(datasets: DataFrame, prefixes: DataFrame) -> DataFrame:
    """datasets (era, version, dataset, nano_child) with matches: both campaigns start with the prefixes of the era.

    prefixes: era, version (null: any), mini, nano.  For an era that isn't in it, both campaigns must contain the era; an era
    that is, but not with this version, does not match.
    """
    p = prefixes.select(F.col("era").alias("pe"), F.col("version").alias("pv"), "mini", "nano")
    known = prefixes.groupBy(F.col("era").alias("ke")).agg(F.lit(True).alias("known"))
    mini, nano = (F.coalesce(F.split_part(c, F.lit("/"), F.lit(3)), F.lit("")) for c in ("dataset", "nano_child"))
    both = datasets.join(known, F.col("era") == F.col("ke"), "left")
    both = both.join(p, (F.col("era") == F.col("pe")) & (F.col("pv").isNull() | (F.col("pv") == F.trim(F.coalesce("version", F.lit(""))))), "left")
    listed = mini.startswith(F.col("mini")) & nano.startswith(F.col("nano"))
    matches = F.when(F.col("known").isNull(), mini.contains(F.col("era")) & nano.contains(F.col("era"))).otherwise(F.coalesce(listed, F.lit(False)))
    return both.select(*datasets.columns, matches.alias("matches"))


def catalogue_keys(shorts: DataFrame, names: DataFrame, catalogue: DataFrame) -> DataFrame:
    """shorts (short) with the catalogue's keys (era, name) of the datasets it stands for."""
    primary = catalogue.select("era", "name", F.split_part("dataset", F.lit("/"), F.lit(2)).alias("primary"))
    return shorts.join(names, "short").join(primary, "primary").select("short", "era", "name")


def request_name(name: str = "name", era: str = "era", suffix: str = "", tag: str = ""):
    """name_era[_label]_extend[_suffix][_tag]; the label is v3 for entries of that version, else the role of those that have a version."""
    label = F.when(_entry("miniaod_version") == "v3", "v3").when(_entry("miniaod_version") != "", _entry("nano_role"))
    some = lambda c: F.when(c != "", c)
    return F.concat_ws("_", F.col(name), F.col(era), some(label), F.lit("extend"), some(F.lit(suffix)), some(F.lit(tag)))


def short_names(datasets: DataFrame, names: DataFrame) -> DataFrame:
    """datasets with the short name of their primary part; null where there is none."""
    return datasets.withColumn("primary", F.split_part("dataset", F.lit("/"), F.lit(2))).join(names, "primary", "left")


#: Eras whose entries name a version and a role; versions and roles there are (fixed values).
VERSIONED_ERAS = ("2022", "2022EE", "2023", "2023BPix")
VERSIONS = ("v3", "v4")
ROLES = ("main", "ext1")


def expected_mask():
    """The name an entry's mask must have."""
    return F.concat(F.lit("crab_lumimask_"), F.col("era"), F.lit("_"), F.coalesce("name", F.lit("?")), F.lit("_v3.json"))


def _entry(c: str):
    return F.trim(F.coalesce(F.col(c), F.lit("")))


def entry_problems(catalogue: DataFrame, masks: DataFrame | None = None) -> DataFrame:
    """Entries with the rules they break, in this order; masks: mask_identity's rows, by era and name, for what their files break.

    An entry of a versioned era, or one with a version or role, needs a known version and role; v3 goes with main only; main
    bars _ext from both datasets, another role wants _role- in both.  v3 needs a mask, others have none; no checksum without
    mask; a mask has a bare name, the entry's own, and a checksum.
    """
    version, role, mask, md5 = (_entry(c) for c in ("miniaod_version", "nano_role", "lumi_mask", "lumi_mask_md5"))
    mini, nano = (F.coalesce(F.split_part(c, F.lit("/"), F.lit(3)), F.lit("")) for c in ("dataset", "nano_child"))
    ruled = F.col("era").isin(*VERSIONED_ERAS) | (version != "") | (role != "")
    known = role.isin(*ROLES)
    marked = F.concat(F.lit("_"), role, F.lit("-"))
    bare = ~mask.contains("/") & ~mask.isin(".", "..")
    rule = lambda bad, text: F.when(F.coalesce(bad, F.lit(False)), text)
    problems = F.array_compact(F.array(
        rule(ruled & ~version.isin(*VERSIONS), "unknown version"),
        rule(ruled & ~known, "unknown role"),
        rule(ruled & known & (version == "v3") & (role != "main"), "v3 with another role than main"),
        rule(ruled & (role == "main") & (mini.contains("_ext") | nano.contains("_ext")), "main role for an extension"),
        rule(ruled & known & (role != "main") & ~(mini.contains(marked) & nano.contains(marked)), "extension role for a dataset that is none"),
        rule((version == "v3") & (mask == ""), "v3 without mask"),
        rule((version != "v3") & (mask != ""), "mask on another version than v3"),
        rule((md5 != "") & (mask == ""), "checksum without mask"),
        rule((mask != "") & ~bare, "mask is not a bare name"),
        rule((mask != "") & bare & (mask != expected_mask()), "mask of another entry"),
        rule((mask != "") & bare & (mask == expected_mask()) & (md5 == ""), "mask without checksum"),
    ))
    out = catalogue.select("era", "name", problems.alias("problems"))
    if masks is not None:
        bad = masks.where(F.col("problem").isNotNull()).select(F.col("era").alias("_era"), F.col("name").alias("_name"), "problem")
        out = out.join(bad, F.col("era").eqNullSafe(F.col("_era")) & F.col("name").eqNullSafe(F.col("_name")), "left")
        out = out.select("era", "name", F.array_union("problems", F.array_compact(F.array("problem"))).alias("problems"))
    return out.where(F.size("problems") > 0)


def mask_identity(files: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Entries that name a mask, against files (path, content of a binaryFile scan): era, name, lumi_mask and the first problem.

    A bare name, the entry's own, a checksum, a file, the checksum in lower case, a mask, at least one lumi; null if all hold.
    """
    mask, md5 = _entry("lumi_mask"), F.lower(_entry("lumi_mask_md5"))
    have = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.md5("content").alias("found"), F.decode("content", "UTF-8").alias("text"))
    both = catalogue.where(mask != "").withColumns({"mask": mask, "wanted": md5}).join(have, F.col("mask") == F.col("file"), "left")
    runs = F.from_json("text", "map<string, array<array<bigint>>>")
    lumis = F.aggregate(F.flatten(F.map_values(runs)), F.lit(0).cast("bigint"), lambda n, p: n + F.get(p, F.lit(1)) - F.get(p, F.lit(0)) + 1)
    problem = (
        F.when(F.col("mask").contains("/") | F.col("mask").isin(".", ".."), "mask is not a bare name").when(F.col("mask") != expected_mask(), "mask of another entry")
        .when(F.col("wanted") == "", "mask without checksum").when(F.col("found").isNull(), "mask file missing").when(F.col("found") != F.col("wanted"), "mask with another checksum")
        .when(lumis.isNull(), "not a mask").when(lumis == 0, "mask without lumis")
    )
    return both.select("era", "name", "lumi_mask", problem.alias("problem"))


#: What replies to a resubmission say (fixed values).
NOTHING = ("found no jobs to resubmit", "no jobs to resubmit")
REFUSED = ("will not proceed with the resubmission", "status information is unavailable", "has not been submitted to the grid scheduler yet")
SENT = ("resubmit request sent to the server",)


def classify_answers(answers: DataFrame, text: str = "text", error: str = "error") -> DataFrame:
    """Replies of a resubmission: nothing or refused by what the reply or the exception says, sent by the reply alone, else error if
    there was an exception, else unclear."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    both = F.concat(low, F.lit(" "), F.lower(F.coalesce(F.col(error), F.lit(""))))
    says = lambda where, phrases: reduce(or_, (where.contains(p) for p in phrases))
    status = F.when(says(both, NOTHING), "nothing").when(says(both, REFUSED), "refused").when(says(low, SENT), "sent").when(F.col(error).isNotNull(), "error").otherwise("unclear")
    return answers.withColumn("status", status)
