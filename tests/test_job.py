"""Scan (S1, S2), snapshot publish (K1, S3), store sink (K2) and the whole job."""

from __future__ import annotations

import gzip
import json
import os
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL, make_line
from keysweep.operators import deleted_rows, kept_rows
from keysweep.plans.derived import manifest_table, read_table, run_lines, write_run_folder
from keysweep.plans.job import run_cleanup, stage_triples
from keysweep.schemas import MANIFEST
from keysweep.sinks import PublishError, delete_from_store, init_manifest, publish_snapshot
from keysweep.sources import current_version, normalize_run_folder, read_current, read_enriched, run_folder_glob
from keysweep.sources.manifest import commit_path, day_path, published_versions, read_commit, written_folders


def write_text(path, lines, compress=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = ("\n".join(lines) + "\n").encode()
    with open(path, "wb") as fh:
        fh.write(gzip.compress(data) if compress else data)


def test_run_folder_rule():
    assert normalize_run_folder("s3://enriched/archive") == "s3a://enriched/archive/"
    assert normalize_run_folder("s3n://b/run=1/") == "s3a://b/run=1/"
    assert normalize_run_folder("s3a://b/x") == "s3a://b/x/"
    assert normalize_run_folder("/data/run") == "/data/run/"
    assert run_folder_glob("hdfs:///r") == "hdfs:///r/part-*"


def test_scan_reads_only_part_files_plain_and_gzip(spark, tmp_folder):
    run = os.path.join(tmp_folder, "run")
    write_text(f"{run}/part-00000", ["a", "b"])
    write_text(f"{run}/part-00001.gz", ["c"], compress=True)
    write_text(f"{run}/part-00002.gzip", ["d", "e"], compress=True)
    write_text(f"{run}/other.txt", ["x"])
    write_text(f"{run}/nested/part-00009", ["y"])
    got = sorted(r[0] for r in read_enriched(spark, run).collect())
    assert got == ["a", "b", "c", "d", "e"]


def test_scan_keeps_quotes_and_tabs(spark, tmp_folder):
    line = '"q\tz"\t{"a": "b,c"}\t'
    write_text(os.path.join(tmp_folder, "part-0"), [line])
    assert read_enriched(spark, tmp_folder).first()[0] == line


def test_scan_of_empty_folder_fails(spark, tmp_folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_enriched(spark, tmp_folder).collect()


def manifest_root(spark, tmp_folder, rows):
    root = os.path.join(tmp_folder, "manifest")
    init_manifest(spark, spark.createDataFrame(rows, MANIFEST), root)
    return root


def run_folder(tmp_folder, lines, name="run"):
    folder = os.path.join(tmp_folder, name)
    write_text(os.path.join(folder, "part-00000"), lines)
    return folder


def test_job_deletes_only_this_runs_rows_and_second_run_deletes_nothing(spark, tmp_folder):
    t = 1500576426
    rows = [("a", "fa", t), ("b", "fb", t - 86400), ("c", "fc", t), ("x", "fx", 0)]
    root = manifest_root(spark, tmp_folder, rows)
    lines = [make_line(event_id="a", fingerprint="fa"), make_line(event_id="a", fingerprint="fa"),
             make_line(event_id="b", fingerprint="fb"), make_line(event_id="z", fingerprint="fz")]
    folder = run_folder(tmp_folder, lines)

    first = run_cleanup(spark, folder, root, quiet=True, verify=True)
    assert (first.deleted, first.skipped, first.lines, first.version) == (1, 3, 4, 2)
    assert first.report().endswith("deleted 1 events. 3 events were skipped")
    assert sorted(tuple(r) for r in read_current(spark, root).collect()) == sorted(rows[1:])

    second = run_cleanup(spark, folder, root, quiet=True)
    assert (second.deleted, second.skipped, second.version) == (0, 4, 3)


def test_job_with_override_time(spark, tmp_folder):
    t = 1500561853
    root = manifest_root(spark, tmp_folder, [("a", "fa", t), ("b", "fb", 1500576426)])
    folder = run_folder(tmp_folder, [make_line(event_id="a", fingerprint="fa", etl="junk"),
                                     make_line(event_id="b", fingerprint="fb")])
    result = run_cleanup(spark, folder, root, override_time="2017-07-20-14-44-13", quiet=True)
    assert (result.deleted, result.skipped) == (1, 1)
    assert [tuple(r) for r in read_current(spark, root).collect()] == [("b", "fb", 1500576426)]


@pytest.mark.parametrize("bad", [make_line(fingerprint=""), "", make_line(etl="2017-07-20")])
@pytest.mark.parametrize("manifest_rows", [[], [("a", "fa", 1500576426)]])
def test_job_fails_fast_and_leaves_manifest(spark, tmp_folder, bad, manifest_rows):
    root = manifest_root(spark, tmp_folder, manifest_rows)
    folder = run_folder(tmp_folder, [make_line(event_id="a", fingerprint="fa"), bad])
    with pytest.raises(Exception, match="Cannot split TSV|Cannot parse ETL timestamp"):
        run_cleanup(spark, folder, root, quiet=True)
    assert current_version(spark, root) == 1
    assert read_current(spark, root).count() == len(manifest_rows)


def test_dry_run_publishes_nothing(spark, tmp_folder):
    root = manifest_root(spark, tmp_folder, [("a", "fa", 1500576426)])
    folder = run_folder(tmp_folder, [make_line(event_id="a", fingerprint="fa")])
    result = run_cleanup(spark, folder, root, publish=False, quiet=True)
    assert (result.deleted, result.version) == (1, None)
    assert current_version(spark, root) == 1


def test_emptying_the_whole_manifest(spark, tmp_folder):
    t = 1500576426
    root = manifest_root(spark, tmp_folder, [("a", "fa", t), ("b", "fb", t)])
    folder = run_folder(tmp_folder, [make_line(event_id="a", fingerprint="fa"),
                                     make_line(event_id="b", fingerprint="fb")])
    result = run_cleanup(spark, folder, root, quiet=True)
    assert result.deleted == 2
    assert read_current(spark, root).count() == 0


def test_publish_failure_keeps_old_snapshot(spark, tmp_folder):
    root = manifest_root(spark, tmp_folder, [("a", "fa", 1)])
    rows = spark.createDataFrame([("b", "fb", 2)], MANIFEST)
    with pytest.raises(PublishError, match="expected"):
        publish_snapshot(spark, rows, root, expected_rows=5)
    assert current_version(spark, root) == 1
    assert [tuple(r) for r in read_current(spark, root).collect()] == [("a", "fa", 1)]
    # the folder of the failed attempt belongs to no version and is in nobody's way
    assert publish_snapshot(spark, rows, root, base_version=1) == (2, 1)
    assert [tuple(r) for r in read_current(spark, root).collect()] == [("b", "fb", 2)]


def test_init_refuses_repeated_keys(spark, tmp_folder):
    rows = spark.createDataFrame([("a", "fa", 1), ("a", "fa", 2)], MANIFEST)
    with pytest.raises(PublishError, match="more than once"):
        init_manifest(spark, rows, os.path.join(tmp_folder, "m"))
    assert current_version(spark, os.path.join(tmp_folder, "m")) is None


def test_key_check_stops_the_job(spark, tmp_folder):
    t = 1500576426
    root = os.path.join(tmp_folder, "manifest")   # not made by init_manifest, which refuses it
    publish_snapshot(spark, spark.createDataFrame([("a", "fa", t), ("a", "fa", t), ("b", "fb", 1)], MANIFEST), root)
    folder = run_folder(tmp_folder, [make_line(event_id="a", fingerprint="fa")])
    with pytest.raises(PublishError, match="more than once"):
        run_cleanup(spark, folder, root, check_keys=True, quiet=True)
    assert current_version(spark, root) == 1


def test_outcome_and_totals_agree(spark, tmp_folder):
    from keysweep.plans.job import run_outcome

    t = 1500576426
    root = manifest_root(spark, tmp_folder, [("a", "fa", t), ("b", "fb", t)])
    folder = run_folder(tmp_folder, [make_line(event_id=e, fingerprint="fa") for e in "aaaz"])
    result = run_cleanup(spark, folder, root, check_keys=True, quiet=True)
    outcome = run_outcome(spark, result, root)
    assert (result.deleted, result.skipped) == (outcome.where("deleted").count(), outcome.where("not deleted").count()) == (1, 3)


def test_an_overlapping_cleanup_wins_or_fails_as_a_whole(spark, tmp_folder, monkeypatch):
    """B cleans up and expires between A's write and A's commit: A fails, and its second try loses nobody's deletes."""
    from keysweep.sinks import snapshot

    t = 1500576426
    rows = [("a", "fa", t), ("b", "fb", t), ("c", "fc", t)]
    root = manifest_root(spark, tmp_folder, rows)
    a = run_folder(tmp_folder, [make_line(event_id="a", fingerprint="fa")], "run-a")
    b = run_folder(tmp_folder, [make_line(event_id="b", fingerprint="fb")], "run-b")
    real, seen = snapshot.fs.create_marker, []

    def create(session, path, content=""):
        if not seen:
            seen.append(path)
            assert run_cleanup(spark, b, root, quiet=True, keep_snapshots=1).version == 2
        return real(session, path, content)

    monkeypatch.setattr(snapshot.fs, "create_marker", create)
    with pytest.raises(PublishError, match="run the cleanup again"):
        run_cleanup(spark, a, root, quiet=True)
    assert published_versions(spark, root) == [2]
    assert sorted(r["eventid"] for r in read_current(spark, root).collect()) == ["a", "c"]
    assert run_cleanup(spark, a, root, quiet=True).version == 3
    assert [r["eventid"] for r in read_current(spark, root).collect()] == ["c"]


def test_expiry_leaves_folders_being_written(spark, tmp_folder, monkeypatch):
    from keysweep.sinks import expire_snapshots, remove_orphans, snapshot

    root = manifest_root(spark, tmp_folder, [("a", "fa", 1)])
    rows = spark.createDataFrame([("a", "fa", 1)], MANIFEST)
    publish_snapshot(spark, rows, root)
    before = written_folders(spark, root)
    real = snapshot.fs.create_marker

    def create(session, path, content=""):
        during = set(written_folders(spark, root)) - set(before)
        expire_snapshots(spark, root, keep=1)
        assert remove_orphans(spark, root) == [] and during <= set(written_folders(spark, root))
        return real(session, path, content)

    monkeypatch.setattr(snapshot.fs, "create_marker", create)
    publish_snapshot(spark, rows, root)
    assert read_current(spark, root).count() == 1
    monkeypatch.undo()
    with pytest.raises(PublishError):
        publish_snapshot(spark, rows, root, expected_rows=9)
    assert len(remove_orphans(spark, root, older_than_seconds=-60)) >= 1
    assert read_current(spark, root).count() == 1


def test_only_the_runs_days_are_rewritten(spark, tmp_folder):
    t, day = 1500576426, 86400
    rows = [(f"d{k}e{i}", "f", t - k * day) for k in range(4) for i in range(5)] + [("old", "f", 5), ("no", "f", None)]
    root = manifest_root(spark, tmp_folder, rows)
    first = read_commit(spark, root, 1)
    files = {d: sorted(os.listdir(day_path(root, w, d))) for d, (w, _) in first.days.items()}
    stamp = datetime.fromtimestamp(t - day, timezone.utc).strftime("%Y-%m-%d %H:%M:%S.000")
    lines = [make_line(event_id="d1e2", fingerprint="f", etl=stamp), make_line(event_id="zz", fingerprint="f", etl="1970-1-1 0:0:9.0")]
    result = run_cleanup(spark, run_folder(tmp_folder, lines), root, quiet=True, verify=True)
    assert (result.deleted, result.skipped) == (1, 1)
    second = read_commit(spark, root, 2)
    changed = {d for d in first.days if second.days[d][0] != first.days[d][0]}
    assert changed == {str((t - day) // day), "0"} and len(first.days) == 6
    for d in set(first.days) - changed:
        assert second.days[d] == first.days[d] and sorted(os.listdir(day_path(root, second.days[d][0], d))) == files[d]
    assert sorted(map(repr, (tuple(r) for r in read_current(spark, root).collect()))) == sorted(map(repr, [r for r in rows if r[0] != "d1e2"]))
    # one old line adds its own day to what is read, not the days between
    assert second.only({str(result.etl_days[0]), str(result.etl_days[1])}).days.keys() == changed


def test_publish_refuses_a_moved_manifest(spark, tmp_folder):
    root = manifest_root(spark, tmp_folder, [("a", "fa", 1)])
    rows = spark.createDataFrame([("b", "fb", 2)], MANIFEST)
    publish_snapshot(spark, rows, root, base_version=1)
    with pytest.raises(PublishError, match="moved"):
        publish_snapshot(spark, rows, root, base_version=1)
    assert current_version(spark, root) == 2


def test_forced_shuffle_and_broadcast_jobs_agree(spark, tmp_folder):
    events = read_table(spark, SF_SMALL, "events")
    folder = write_run_folder(spark, run_lines(events))
    results = []
    for cap in (0, 1 << 30):
        root = os.path.join(tmp_folder, f"m{cap}")
        init_manifest(spark, manifest_table(events), root)
        result = run_cleanup(spark, folder, root, broadcast_max_bytes=cap, quiet=True, verify=True)
        results.append((result.deleted, result.skipped, sorted(tuple(r) for r in read_current(spark, root).collect())))
        assert result.broadcast == (cap > 0)
    assert results[0] == results[1]


def test_staged_triples_equal_direct_form(spark):
    events = read_table(spark, SF_CHECK, "events")
    lines = run_lines(events)
    staged = stage_triples(spark, lines)
    assert staged.lines == lines.count()
    triples = spark.read.parquet(staged.path)
    assert triples.select("rid").distinct().count() == staged.lines
    manifest = manifest_table(events)
    assert deleted_rows(manifest, triples).count() == 6666
    assert kept_rows(manifest, triples).count() == 3667


def test_store_sink_sends_every_row_once(spark, tmp_folder):
    class FileStore:
        """A keyed store kept in a JSON file; deletes are logged one file per task."""

        def __init__(self, folder):
            self.folder = folder
            with open(os.path.join(folder, "store.json")) as fh:
                self.rows = {tuple(k.split("|")): v for k, v in json.load(fh).items()}
            self.log = open(os.path.join(folder, f"log-{os.getpid()}-{id(self)}"), "a")

        def delete(self, event_id, fingerprint, etl_time):
            ok = self.rows.get((event_id, fingerprint)) == etl_time
            self.log.write(json.dumps([event_id, fingerprint, etl_time, ok]) + "\n")
            return ok

        def close(self):
            self.log.close()

    rows = {f"e{i}|f": i % 3 for i in range(100)}
    with open(os.path.join(tmp_folder, "store.json"), "w") as fh:
        json.dump(rows, fh)
    df = spark.createDataFrame([(f"e{i}", "f", 1 if i < 90 else 7) for i in range(100)],
                               "eventid string, fingerprint string, etltime int").repartition(4)
    deleted, skipped, retried = delete_from_store(df, lambda: FileStore(tmp_folder))
    logged = []
    for name in os.listdir(tmp_folder):
        if name.startswith("log-"):
            with open(os.path.join(tmp_folder, name)) as fh:
                logged += [json.loads(line) for line in fh]
    assert len(logged) == 100 and len({tuple(x[:2]) for x in logged}) == 100
    assert deleted == sum(1 for i in range(90) if i % 3 == 1) and deleted + skipped == 100 and retried == 0


def test_versions_may_become_empty(spark, tmp_folder):
    root = manifest_root(spark, tmp_folder, [("a", "fa", 1)])
    publish_snapshot(spark, read_current(spark, root).where(F.lit(False)), root)
    assert current_version(spark, root) == 2
    assert read_current(spark, root).count() == 0


def test_job_over_an_empty_run_honours_its_options(spark, tmp_folder):
    root = manifest_root(spark, tmp_folder, [("a", "fa", 1)])
    folder = os.path.join(tmp_folder, "run")
    os.makedirs(folder)
    open(os.path.join(folder, "part-00000"), "w").close()
    result = run_cleanup(spark, folder, root, quiet=True, check_keys=True, verify=True, keep_snapshots=1)
    assert (result.deleted, result.skipped, result.lines, result.version) == (0, 0, 0, 2)
    assert published_versions(spark, root) == [2]
    assert [tuple(r) for r in read_current(spark, root).collect()] == [("a", "fa", 1)]


def test_staged_measures(spark, tmp_folder):
    lines = [make_line(event_id="a", fingerprint="fa"), make_line(event_id="bb", etl="2017-07-20 18:47:09.000")]
    staged = stage_triples(spark, spark.createDataFrame([(x,) for x in lines], "value string"))
    assert (staged.lines, staged.etl_days) == (2, (17367,))
    assert staged.key_bytes == (8 + 8) + (8 + 32) and staged.longest_key == 40


def test_job_over_gzip_run_folder_equals_plain(spark, tmp_folder):
    events = read_table(spark, SF_SMALL, "events")
    results = []
    for compression in (None, "gzip"):
        folder = write_run_folder(spark, run_lines(events), compression=compression,
                                  gzip_suffix=compression is not None)
        root = os.path.join(tmp_folder, f"m-{compression}")
        init_manifest(spark, manifest_table(events), root)
        result = run_cleanup(spark, folder, root, quiet=True)
        results.append((result.lines, result.deleted, result.skipped))
    assert results[0] == results[1]
    assert results[0][0] == events.count() + events.where("event_id % 7 = 0").count()


def test_command_line(spark, tmp_folder, capsys):
    from keysweep.__main__ import main, parse_args

    t = 1500576426
    root = manifest_root(spark, tmp_folder, [("a", "fa", t), ("b", "fb", t)])
    folder = run_folder(tmp_folder, [make_line(event_id="a", fingerprint="fa")])
    assert parse_args(["--run-folder", "s3://x/y", "--manifest", "m", "--time", "2017-07-20-14-44-13"]).time
    assert main(["--run-folder", folder, "--manifest", root, "--dry-run"]) == 0
    assert current_version(spark, root) == 1
    assert main(["--run-folder", folder, "--manifest", root, "--keep-snapshots", "1"]) == 0
    assert published_versions(spark, root) == [2]
    out = capsys.readouterr().out
    assert "deleted 1 events. 0 events were skipped" in out and "published manifest version 2" in out


def test_store_cleanup_matches_snapshot_cleanup(spark, tmp_folder):
    """The same run against a keyed store (fake, file-backed) and against parquet snapshots."""
    from keysweep.plans.job import run_store_cleanup

    class JsonStore:
        def __init__(self, folder):
            self.folder = folder

        def delete(self, event_id, fingerprint, etl_time):
            # one marker file per key: exclusive create makes a second delete fail, as in a store
            path = os.path.join(self.folder, "rows", f"{event_id}|{fingerprint}|{etl_time}")
            try:
                os.remove(path)
                return True
            except FileNotFoundError:
                return False

    t = 1500576426
    rows = [("a", "fa", t), ("b", "fb", t - 86400), ("c", "fc", t), ("x", "fx", 0)]
    os.makedirs(os.path.join(tmp_folder, "rows"))
    for e, f, etl in rows:
        open(os.path.join(tmp_folder, "rows", f"{e}|{f}|{etl}"), "w").close()
    lines = [make_line(event_id="a", fingerprint="fa"), make_line(event_id="a", fingerprint="fa"),
             make_line(event_id="b", fingerprint="fb"), make_line(event_id="z", fingerprint="fz"),
             make_line(event_id="c", fingerprint="fc")]
    folder = run_folder(tmp_folder, lines)
    store_dir = tmp_folder
    result = run_store_cleanup(spark, folder, lambda: JsonStore(store_dir), parallelism=3, concurrency=4,
                               quiet=True)
    assert (result.deleted, result.skipped, result.lines, result.sent) == (2, 3, 5, 4)
    assert result.report().endswith("deleted 2 events. 3 events were skipped")
    assert sorted(os.listdir(os.path.join(tmp_folder, "rows"))) == [f"b|fb|{t - 86400}", "x|fx|0"]

    root = manifest_root(spark, tmp_folder, rows)
    snap = run_cleanup(spark, folder, root, quiet=True)
    assert (snap.deleted, snap.skipped) == (result.deleted, result.skipped)


def test_manifest_with_store_column_names_reads(spark, tmp_folder):
    """A manifest exported with the store's attribute names (eventId, etlTime) reads as is."""
    root = os.path.join(tmp_folder, "manifest")
    df = spark.createDataFrame([("a", "fa", 1500576426), ("b", "fb", 7)], "eventId string, fingerprint string, etlTime int")
    init_manifest(spark, df, root)
    folder = run_folder(tmp_folder, [make_line(event_id="a", fingerprint="fa")])
    result = run_cleanup(spark, folder, root, quiet=True)
    assert (result.deleted, result.skipped) == (1, 0)
    assert [tuple(r) for r in read_current(spark, root).collect()] == [("b", "fb", 7)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_job_equals_one_by_one_replay(spark, tmp_folder, seed):
    rng = random.Random(seed)
    base = 1500576426
    times = [base, base + 3600, base - 86400]
    keys = [(f"e{i}", f"f{i % 3}") for i in range(60)]
    manifest_rows = [(e, f, rng.choice(times + [None])) for e, f in rng.sample(keys, 40)]
    events = [(rng.choice(keys), rng.choice(times[:2])) for _ in range(90)]
    stamps = {t: datetime.fromtimestamp(t, timezone.utc).strftime("%Y-%m-%d %H:%M:%S.000") for t in times}
    lines = [make_line(event_id=e, fingerprint=f, etl=stamps[t]) for (e, f), t in events]

    store = {(e, f): t for e, f, t in manifest_rows}
    deleted = 0
    for (e, f), t in events:
        if store.get((e, f), "absent") == t and t is not None:
            del store[(e, f)]
            deleted += 1

    root = manifest_root(spark, tmp_folder, manifest_rows)
    folder = run_folder(tmp_folder, lines)
    result = run_cleanup(spark, folder, root, quiet=True, verify=True, check_keys=True)
    assert (result.deleted, result.skipped) == (deleted, len(lines) - deleted)
    kept = sorted((tuple(r) for r in read_current(spark, root).collect()), key=repr)
    assert kept == sorted(((e, f, t) for (e, f), t in store.items()), key=repr)


def test_job_result_does_not_depend_on_layout(spark, tmp_folder):
    """Many small scan splits, odd shuffle counts, no broadcast: same deletes, same manifest."""
    events = read_table(spark, SF_SMALL, "events")
    folder = write_run_folder(spark, run_lines(events))
    outcomes = []
    layouts = [{}, {"spark.sql.files.maxPartitionBytes": "8192", "spark.sql.shuffle.partitions": "3",
                    "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}]
    for i, conf in enumerate(layouts):
        saved = {k: spark.conf.get(k) for k in conf}
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            root = os.path.join(tmp_folder, f"m{i}")
            init_manifest(spark, manifest_table(events), root)
            result = run_cleanup(spark, folder, root, broadcast_max_bytes=None if not conf else 0, quiet=True)
            kept = sorted(tuple(r) for r in read_current(spark, root).collect())
            outcomes.append((result.deleted, result.skipped, result.lines, kept))
        finally:
            for k, v in saved.items():
                spark.conf.set(k, v)
    assert outcomes[0] == outcomes[1]


def test_publish_casts_to_manifest_types(spark, tmp_folder):
    root = os.path.join(tmp_folder, "manifest")
    rows = spark.createDataFrame([("a", "fa", 1500576426)], "eventId string, fingerprint string, etlTime bigint")
    init_manifest(spark, rows, root)
    df = read_current(spark, root)
    assert dict(df.dtypes)["etltime"] == "int"
    assert [tuple(r) for r in df.collect()] == [("a", "fa", 1500576426)]


def test_publish_refuses_etl_times_past_int(spark, tmp_folder):
    root = os.path.join(tmp_folder, "manifest")
    rows = spark.createDataFrame([("a", "fa", 2 ** 31)], "eventId string, fingerprint string, etlTime bigint")
    with pytest.raises(Exception, match="out of INT range"):
        init_manifest(spark, rows, root)
    assert current_version(spark, root) is None


def test_commit_names_days_and_row_counts(spark, tmp_folder):
    from keysweep.sources import fs
    from keysweep.sources.manifest import row_count

    root = manifest_root(spark, tmp_folder, [("a", "fa", 1), ("b", "fb", 2), ("c", "fc", None), ("d", "fd", -1)])
    days = json.loads(fs.read_small(spark, commit_path(root, 1)))["days"]
    assert {d: n for d, (_, n) in days.items()} == {"0": 2, "none": 1, "-1": 1}
    assert row_count(spark, root, 1) == 4
    assert not fs.create_marker(spark, commit_path(root, 1), "{}")


def test_job_against_an_empty_manifest(spark, tmp_folder):
    root = manifest_root(spark, tmp_folder, [])
    folder = run_folder(tmp_folder, [make_line(event_id="a", fingerprint="fa"), make_line(event_id="b")])
    result = run_cleanup(spark, folder, root, quiet=True, verify=True, check_keys=True)
    assert (result.deleted, result.skipped, result.lines, result.version) == (0, 2, 2, 2)
    assert read_current(spark, root).count() == 0


def test_expire_snapshots_keeps_the_newest(spark, tmp_folder):
    from keysweep.sinks import expire_snapshots

    root = manifest_root(spark, tmp_folder, [("a", "fa", 1)])
    rows = spark.createDataFrame([("a", "fa", 1)], MANIFEST)
    for _ in range(3):
        publish_snapshot(spark, rows, root)                                # 2, 3, 4
    assert published_versions(spark, root) == [1, 2, 3, 4]
    assert expire_snapshots(spark, root, keep=2) == [1, 2]
    assert published_versions(spark, root) == [3, 4]
    assert current_version(spark, root) == 4 and read_current(spark, root).count() == 1
    assert expire_snapshots(spark, root, keep=2) == []


def test_retried_store_tasks_are_told(spark, tmp_folder, monkeypatch):
    """A later attempt sees its predecessor's deletes as skipped; the result says that it isn't exact."""
    from keysweep.plans.job import StoreCleanupResult
    from keysweep.sinks import store

    log = os.path.join(tmp_folder, "gone")
    os.makedirs(log)

    class Store:
        def delete(self, event_id, fingerprint, etl_time):
            path = os.path.join(log, event_id)
            if os.path.exists(path):
                return False
            open(path, "w").close()
            return True

    df = spark.createDataFrame([(f"e{i}", "f", 1) for i in range(6)], "eventid string, fingerprint string, etltime int").coalesce(1)

    class Second:
        @staticmethod
        def get():
            class Context:
                @staticmethod
                def attemptNumber():
                    return 1
            return Context

    for i in range(2):   # what a failed attempt left deleted
        Store().delete(f"e{i}", "f", 1)
    factory = Second
    namespace = dict(vars(store))
    namespace["TaskContext"] = factory
    import types
    send = types.FunctionType(store.delete_from_store.__code__, namespace, "send", store.delete_from_store.__defaults__)
    deleted, skipped, retried = send(df, Store)
    assert (deleted, skipped, retried) == (4, 2, 1)
    assert not StoreCleanupResult(deleted, skipped, 6, 6, retried, "x").exact


def test_store_command_line(spark, tmp_folder, capsys):
    from keysweep.__main__ import main, parse_args

    module = os.path.join(tmp_folder, "store_client_of_test.py")
    with open(module, "w") as fh:
        fh.write("class Client:\n    def delete(self, event_id, fingerprint, etl_time):\n        return event_id == 'a'\n")
    spark.sparkContext.addPyFile(module)
    folder = run_folder(tmp_folder, [make_line(event_id=e, fingerprint="f") for e in "aab"])
    assert main(["--run-folder", folder, "--store-client", "store_client_of_test:Client", "--parallelism", "2", "--concurrency", "2"]) == 0
    assert "deleted 1 events. 2 events were skipped" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        parse_args(["--run-folder", folder])


def test_store_errors_fail_the_job(spark, tmp_folder):
    """Any store exception other than a failed condition fails the job (no catch-all)."""
    from keysweep.plans.job import run_store_cleanup

    class BrokenStore:
        def delete(self, event_id, fingerprint, etl_time):
            raise RuntimeError("store unavailable")

    folder = run_folder(tmp_folder, [make_line(event_id="a", fingerprint="fa")])
    with pytest.raises(Exception, match="store unavailable"):
        run_store_cleanup(spark, folder, BrokenStore, quiet=True)


def test_check_lines_lists_every_failing_line(spark, tmp_folder, capsys):
    from keysweep.__main__ import main
    from keysweep.plans.job import check_run_lines

    lines = [make_line(event_id="ok"), make_line(event_id="m1", fingerprint=""), "",
             make_line(event_id="t1", etl="2017-07-20"), make_line(event_id="t2", etl="x"),
             make_line(event_id="r1", etl="2040-01-01 00:00:00.000")]
    folder = run_folder(tmp_folder, lines)
    counts = check_run_lines(spark, folder, os.path.join(tmp_folder, "report"))
    assert counts == {"malformed": 2, "bad_timestamp": 2, "out_of_range": 1}
    report = spark.read.parquet(os.path.join(tmp_folder, "report"))
    assert sorted(r["eventid"] or "" for r in report.collect()) == ["", "m1", "r1", "t1", "t2"]
    assert check_run_lines(spark, folder, os.path.join(tmp_folder, "r2"), "2017-07-20-14-44-13") == {"malformed": 2}
    assert main(["--run-folder", folder, "--manifest", "unused", "--check-lines",
                 os.path.join(tmp_folder, "r3")]) == 1
    assert "bad_timestamp" in capsys.readouterr().out
