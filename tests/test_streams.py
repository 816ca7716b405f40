"""Keyed tables, streams with state and writers that are run twice."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from admitflow.operators import refdata
from admitflow.sources import sinks
from admitflow.sources.keyed_table import KeyedTable, MergeConflict
from admitflow.streaming import states, streams


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k long, v string, n int")


def test_a_merge_rewrites_the_buckets_of_its_keys_only(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    assert table.manifest() is None and table.vacuum() == 0
    with pytest.raises(ValueError, match="no version"):
        table.read()
    assert table.merge(rows(spark, *[(i, "old", 0) for i in range(500)]), ["k"], buckets=32) == 0
    before = table.manifest()["merges"]
    assert len(before) == 32 and table.merge(rows(spark, (7, "new", 1), (1000, "new", 1)), ["k"]) == 1
    after = table.manifest()["merges"]
    assert 1 <= sum(before[b] != after[b] for b in after) <= 2
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == 501 and got[7] == got[1000] == "new" and got[8] == "old"
    assert table.read(0).where("v = 'new'").count() == 0
    assert table.merge(rows(spark).limit(0), ["k"]) == 1
    with pytest.raises(ValueError, match="keys are"):
        table.merge(rows(spark, (1, "x", 0)), ["v"])


def test_null_keys_repeats_and_older_rows(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    table.merge(rows(spark, (None, "a", 1), (1, "b", 5)), ["k"], buckets=4)
    table.merge(rows(spark, (None, "c", 2), (1, "late", 4)), ["k"], newer="n")
    assert {(r.k, r.v) for r in table.read().collect()} == {(None, "c"), (1, "b")}
    table.merge(rows(spark, (1, "even", 5), (2, "x", None)), ["k"], newer="n")
    assert {(r.k, r.v) for r in table.read().collect()} == {(None, "c"), (1, "even"), (2, "x")}
    other = KeyedTable(spark, str(tmp_path / "o"))
    other.merge(rows(spark, (1, "first", 1), (1, "last", 2)), ["k"], order="n")
    assert [tuple(r) for r in other.read().collect()] == [(1, "last")]


def test_a_merge_that_dies_leaves_the_table_and_a_rival_makes_it_start_anew(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"))
    table.merge(rows(spark, (1, "a", 0), (2, "a", 0)), ["k"], buckets=4)

    def die(*_):
        raise OSError("lost")

    monkeypatch.setattr(KeyedTable, "_publish", die)
    with pytest.raises(OSError):
        table.merge(rows(spark, (1, "b", 0)), ["k"])
    monkeypatch.undo()
    assert {r.v for r in table.read().collect()} == {"a"} and table.versions() == [0]
    assert table.vacuum() == 1

    publish, rivals = KeyedTable._publish, [rows(spark, (1, "rival", 0), (3, "rival", 0))]

    def beaten(self, version, manifest):
        if rivals:
            KeyedTable(spark, self.path).merge(rivals.pop(), ["k"])
        publish(self, version, manifest)

    monkeypatch.setattr(KeyedTable, "_publish", beaten)
    assert table.merge(rows(spark, (1, "mine", 0)), ["k"]) == 2
    monkeypatch.undo()
    assert {(r.k, r.v) for r in table.read().collect()} == {(1, "mine"), (2, "a"), (3, "rival")}
    with pytest.raises(MergeConflict):
        table._publish(2, {})
    assert table.versions() == [0, 1, 2] and table.vacuum(keep=1) >= 1 and table.read().count() == 3


def inbox(spark, folder, *files):
    df = spark.createDataFrame([(p, bytearray(c)) for p, c in files], "path string, content binary")
    assert sinks.write_files(df, str(folder)).count() == len(files)


def test_ingestion_under_another_checkpoint_keeps_the_table(spark, tmp_path):
    institutions = spark.createDataFrame([("uj", "UJ", "s")], "id string, name string, scoring_strategy string")
    run = lambda place, checkpoint: streams.run_ingestion(streams.read_inbox(spark, str(tmp_path / place), 2), institutions, str(tmp_path / "out"), str(tmp_path / checkpoint)).awaitTermination()
    inbox(spark, tmp_path / "one", *[(f"uj/2027/{i}.pdf", b"%PDF-" + bytes([65 + i])) for i in range(5)])
    run("one", "a")
    # Contents 3 and 4 are known, 5 is new; the copy of 5 is of a later batch or of the same.
    inbox(spark, tmp_path / "two", *[(f"uj/2026/{i}.pdf", b"%PDF-" + bytes([65 + i])) for i in (3, 4, 5)], ("uj/2026/copy.pdf", b"%PDF-F"), ("odd.pdf", b"%PDF-A"))
    run("two", "b")
    run("two", "b")
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len([r for r in got if r.error is None]) == 6 and len({r.sha256 for r in got if r.error is None}) == 6
    assert [r.path.rsplit("/", 1)[-1] for r in got if r.error] == ["odd.pdf"] and len({r.run for r in got}) == 2


def test_a_repeated_batch_writes_the_same_rows(spark, tmp_path):
    """The last batch's commit is lost, so it runs again on restart."""
    institutions = spark.createDataFrame([("uj", "UJ", "s")], "id string, name string, scoring_strategy string")
    run = lambda: streams.run_ingestion(streams.read_inbox(spark, str(tmp_path / "in"), 1), institutions, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    inbox(spark, tmp_path / "in", ("uj/2027/a.pdf", b"%PDF-1"), ("uj/2027/b.pdf", b"%PDF-2"), ("uj/2027/c.pdf", b"%PDF-1"))
    run()
    commits = sorted(p for p in (tmp_path / "cp/commits").iterdir() if p.name.isdigit())
    commits[-1].unlink()
    (tmp_path / f"cp/commits/.{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    assert sorted(r.sha256 for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted({r.sha256 for r in spark.read.parquet(str(tmp_path / "out")).collect()})
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_statuses_follow_their_order_and_stuck_documents_fail(spark, tmp_path):
    begin = datetime(2027, 1, 1)
    change = lambda key, hours, status, error=None: (key, status, error, begin + timedelta(hours=hours))

    def arrive(*changes):
        spark.createDataFrame(list(changes), "sha256 string, status string, error string, changed_at timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema("sha256 string, status string, error string, changed_at timestamp").parquet(str(tmp_path / "in"))
        streams.run_statuses(source, str(tmp_path / "out"), str(tmp_path / "cp"), "1 hour", 7200).awaitTermination()
        return {(r.sha256, r.status, r.refused, r.error) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    got = arrive(change("a", 0, "pending"), change("a", 1, "classifying"), change("b", 0, "review_ready"), change("c", 0, "pending"), change("c", 0.5, "failed", "no pages"))
    assert got == {("a", "pending", None, None), ("a", "classifying", None, None), ("b", "review_ready", "nothing can't become review_ready", None), ("c", "pending", None, None), ("c", "failed", None, "no pages")}
    got = arrive(change("a", 0.9, "failed"), change("c", 2, "pending"), change("d", 2, "pending"))
    assert ("a", "failed", "late", None) in got and ("c", "pending", None, None) in got
    got = arrive(change("d", 5, "classifying"), change("d", 5.5, "extracting"))
    stuck = ("a", "failed", None, "no change from classifying in 7200 s")
    assert stuck in got and not any(r[0] == "d" and r[3] for r in got)
    assert ("a", "pending", None, None) in arrive(change("a", 6, "pending"))


class Counted:
    """A value state that counts the calls, each of which is a message to the JVM."""

    def __init__(self):
        self.value, self.calls, self.timers = None, 0, []

    def getValueState(self, *_):
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.value, self.calls = value, self.calls + 1

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_a_key_costs_two_calls_for_its_state_and_no_frame():
    state, row = Counted(), Row("path", "error", "key")
    content = states._FirstContent()
    content.init(state)
    rows = [row("b", None, "k"), row("a", None, "k"), row("0", "odd", "k")]
    assert [r.path for r in content.handleInputRows(("k",), iter(rows), None)] == ["0", "a"] and state.calls == 2
    assert [r.path for r in content.handleInputRows(("k",), iter(rows), None)] == ["0"] and state.calls == 3
    state, change = Counted(), Row("status", "error", "at")
    status = states._Status(1000)
    status.init(state)
    told = list(status.handleInputRows(("d",), iter([change("classifying", None, 2_000_001), change("pending", None, 1_000_001), change(None, None, 2_000_001)]), None))
    assert [(r.status, r.at, r.refused) for r in told] == [("pending", 1_000_001, None), ("classifying", 2_000_001, None), (None, 2_000_001, "classifying can't become None")]
    assert state.calls == 2 and state.value == ("classifying", None, 2000) and state.timers == [3000]


def test_every_status_is_known():
    assert set(states.STATUSES) == set(states.TRANSITIONS) - {""} and set(states.AT_WORK) < set(states.STATUSES)
    assert all(after <= set(states.STATUSES) for after in states.TRANSITIONS.values())


def test_mended_files_lose_their_errors(spark, tmp_path):
    def arrive(*files):
        spark.createDataFrame(list(files), "source_file string, version int, row_id long, body string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema("source_file string, version int, row_id long, body string").parquet(str(tmp_path / "in"))

        def check(batch):
            errors = refdata.structural_errors(batch, ["name"], ["name"])
            return batch.select("row_id", "source_file").join(errors, "row_id").select("source_file", "error")

        streams.revalidate(source, check, str(tmp_path / "errors"), str(tmp_path / "cp"), buckets=2).awaitTermination()
        return {(r.source_file, r.version, r.error) for r in streams.current_errors(spark, str(tmp_path / "errors")).collect()}

    assert arrive(("a", 1, 1, "[]"), ("b", 1, 2, "{}"), ("c", 1, 3, '{"name":1}')) == {("a", 1, "not an object"), ("b", 1, "missing key name")}
    assert arrive(("a", 2, 4, '{"name":1}'), ("c", 2, 5, "7"), ("c", 3, 6, '{"odd":1}')) == {("b", 1, "missing key name"), ("c", 3, "missing key name"), ("c", 3, "unknown key odd")}
    assert arrive(("a", 1, 7, "[]"), ("b", 3, 8, '{"name":2}')) == {("c", 3, "missing key name"), ("c", 3, "unknown key odd")}


def test_runs_written_twice_leave_one_copy(spark, tmp_path):
    df = spark.createDataFrame([("uj", 2027, "a"), ("uj", 2026, "b"), ("tut", 2027, "c")], "institution_id string, academic_year int, code string")
    path = str(tmp_path / "t")
    for run, part in (("1", df), ("2", df.where("code = 'a'")), ("1", df)):
        sinks.write_by_institution(part, path, run)
    assert sorted((r.code, r.run) for r in spark.read.schema("code string, institution_id string, academic_year int, run string").parquet(path).collect()) == [("a", "1"), ("a", "2"), ("b", "1"), ("c", "1")]
    downloads = spark.createDataFrame([("u", bytearray(b"%PDF-1")), ("w", bytearray(b"%PDF-2")), ("x", bytearray(b"junk"))], "url string, content binary")
    first = {r.url: r.fetched_at for r in sinks.record_downloads(downloads, str(tmp_path / "m")).collect()}
    changed = downloads.withColumn("content", F.when(F.col("url") == "w", F.lit(b"%PDF-3")).otherwise(F.col("content")))
    second = {r.url: r.fetched_at for r in sinks.record_downloads(changed, str(tmp_path / "m")).collect()}
    assert set(first) == set(second) == {"u", "w"} and first["u"] == second["u"] and first["w"] < second["w"]
    pages = spark.createDataFrame([("d", 1, "text"), ("d", 2, "")], "doc string, page int, markdown string")
    assert sinks.store_markdown(pages, str(tmp_path / "md")) == sinks.store_markdown(pages, str(tmp_path / "md")) == 2
    assert (tmp_path / "md/d/page_0001.md").read_text() == "text"


def test_rejected_and_accepted_requests_of_a_stream(spark, tmp_path):
    from admitflow.operators import qualify as q
    from admitflow.plans import testviews as t

    sf = "/root/testdata/sf0.001"
    names = ["english_hl", "mathematics", "history", "geography", "accounting", "music"]
    good = [(s, 80) for s in names]
    spark.createDataFrame([(1, None, None, True, good), (2, 2026, ["nobody"], True, good), (3, None, None, True, good[:5]), (4, None, None, True, None), (5, None, None, True, [("alchemy", 1), *good])], streams.REQUEST).repartition(3).write.parquet(str(tmp_path / "in"))
    requests = spark.readStream.schema(streams.REQUEST).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    offer = q.offer_of(t.programmes(spark, sf), t.institutions(spark, sf)).kept()
    streams.qualify_requests(requests, offer, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.learner_id, r.rejected) for r in out.where("rejected is not null").collect()} == {(3, "number of subjects"), (4, "number of subjects"), (5, "unknown subject")}
    assert {r.learner_id for r in out.where("rejected is null").select("learner_id").collect()} == {1}


def test_rejections_judge_no_programme(spark, monkeypatch):
    from admitflow.operators import qualify
    from admitflow.plans import stream_queries

    monkeypatch.setattr(qualify, "qualify_offer", None)
    got = stream_queries.stream_rejections(spark, "/root/testdata/sf0.001").collect()
    assert got and {r.rejected for r in got} == {"number of subjects"}


def test_answers_grow_with_requests_and_not_with_programmes(spark, tmp_path):
    """The table has a row per learner, and lists what one qualification of all gives."""
    from admitflow.operators import qualify as q
    from admitflow.plans import testviews as t

    sf = "/root/testdata/sf0.001"
    taken = t.marks(spark, sf).groupBy("learner_id").agg(F.collect_list(F.struct("subject", "percentage")).alias("marks"))
    asked = t.requests(spark, sf).withColumn("academic_year", F.when(F.col("learner_id") % 2 == 0, 2026).cast("int")).join(taken, "learner_id").select("learner_id", "academic_year", "institutions", "include_near_misses", "marks")
    asked.write.parquet(str(tmp_path / "in"))
    offer = q.offer_of(t.programmes(spark, sf), t.institutions(spark, sf)).kept()
    requests = spark.readStream.schema(streams.REQUEST).parquet(str(tmp_path / "in"))
    streams.qualify_requests(requests, offer, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.select("learner_id").distinct().count()
    valid, _ = q.validate_requests(t.marks(spark, sf))
    columns = ["learner_id", "qualification_code", "margin", "failures", "bucket"]
    expected = q.qualify_offer(valid, asked.drop("marks"), offer).select(columns)
    got = q.listed(streams.answers(spark, str(tmp_path / "out"), offer)).select(columns)
    assert sorted(got.collect(), key=repr) == sorted(expected.collect(), key=repr) and got.count()


def test_programmes_of_answers_are_merged_by_the_keys_of_one_exchange(spark, tmp_path):
    from admitflow.operators import qualify as q
    from admitflow.plans import testviews as t

    sf = "/root/testdata/sf0.001"
    offer = q.offer_of(t.programmes(spark, sf), t.institutions(spark, sf)).kept()
    valid, _ = q.validate_requests(t.marks(spark, sf))
    q.judge_learners(valid, t.requests(spark, sf), offer).write.parquet(str(tmp_path / "judged"))
    judged = spark.read.parquet(str(tmp_path / "judged"))
    got = q.judge_of(judged, offer, ["qualification_code"])
    joins = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [institution_id" in line and "dealt" in line]
    assert joins and all("SortMergeJoin" in line and "rule_id" not in line for line in joins)
    of = ["learner_id", "qualification_code", "n_failures", "bucket"]
    want = q.qualify_offer(valid, t.requests(spark, sf), offer).select(of)
    assert sorted(map(tuple, q.listed(got).select(of).collect())) == sorted(map(tuple, want.collect()))


def test_small_files_of_a_batch_share_tasks(spark, tmp_path):
    from admitflow.plans import testviews as t

    (tmp_path / "in/uj/2027").mkdir(parents=True)
    for k in range(200):
        (tmp_path / f"in/uj/2027/{k}.pdf").write_bytes(b"%PDF-" + str(k).encode())
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    with streams.files_in_groups(spark):
        query = streams.run_ingestion(streams.read_inbox(spark, str(tmp_path / "in")), t.institutions(spark, "/root/testdata/sf0.001"), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200 and spark.conf.get("spark.sql.files.openCostInBytes") == before
    jobs = spark.sparkContext.statusTracker()
    stages = [jobs.getStageInfo(s) for j in jobs.getJobIdsForGroup(str(query.runId)) for s in jobs.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= 16
