"""Large .gzip files, whole commits, key buckets, line positions, reports from commits, the store's ledger."""

from __future__ import annotations

import gzip
import json
import os
import random
import sys
from datetime import datetime, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import SF_SMALL, make_line
from keysweep.__main__ import main, parse_args
from keysweep.plans import derived
from keysweep.plans.derived import FolderStore, manifest_table, read_table, run_lines
from keysweep.plans.job import (
    located_failures,
    read_positioned,
    run_cleanup,
    run_outcome,
    run_store_cleanup,
    stage_triples,
    store_outcome,
)
from keysweep.schemas import MANIFEST
from keysweep.sinks import (
    Ledger,
    PublishError,
    StoreError,
    expire_snapshots,
    init_manifest,
    publish_snapshot,
    remove_orphans,
    run_report,
    snapshot,
)
from keysweep.sources import current_version, fs, read_current, read_enriched
from keysweep.sources.manifest import Commit, commit_numbers, commit_path, day_path, published_versions, read_commit, split_part

T = 1500576426
DAY = 86400
cloudpickle.register_pickle_by_value(sys.modules[__name__])   # workers can't import this file


def write_lines(path, lines, compress=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = ("\n".join(lines) + "\n").encode()
    with open(path, "wb") as fh:
        fh.write(gzip.compress(data, 1) if compress else data)


class conf:
    """Session settings for a block."""

    def __init__(self, spark, **values):
        self.spark, self.values = spark, {k.replace("__", "."): v for k, v in values.items()}

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k) for k in self.values}
        for k, v in self.values.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *error):
        for k, v in self.old.items():
            self.spark.conf.set(k, v)


# -- S2 -----------------------------------------------------------------------

def test_large_gzip_files_are_read_whole(spark, tmp_folder):
    rng = random.Random(1)
    lines = [f"{rng.getrandbits(800):0200x}" for _ in range(110_000)]
    write_lines(f"{tmp_folder}/gzip/part-0.gzip", lines, True)
    write_lines(f"{tmp_folder}/gzip/part-1.gzip", lines[:10], True)
    write_lines(f"{tmp_folder}/gz/part-0.gz", lines, True)
    write_lines(f"{tmp_folder}/gz/part-1.gz", lines[:10], True)
    assert os.path.getsize(f"{tmp_folder}/gzip/part-0.gzip") > 12_000_000
    with conf(spark, spark__sql__files__maxPartitionBytes="2m"):
        got = read_enriched(spark, f"{tmp_folder}/gzip")
        digest = [F.count(F.lit(1)), F.sum(F.crc32("value")), F.countDistinct("value")]
        assert got.agg(*digest).first() == read_enriched(spark, f"{tmp_folder}/gz").agg(*digest).first()
        by_task = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sorted(r["count"] for r in by_task) == [10, 110_000]      # one task a file
        assert read_enriched(spark, f"{tmp_folder}/gzip").count() == 110_010
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(1 << 60)


def test_plain_gz_gzip_and_nested_files_together(spark, tmp_folder):
    write_lines(f"{tmp_folder}/part-0", ["a"])
    write_lines(f"{tmp_folder}/part-1.gz", ["b"], True)
    write_lines(f"{tmp_folder}/part-2.gzip", ["c"], True)
    write_lines(f"{tmp_folder}/part-dir/x.gzip", ["d"], True)
    write_lines(f"{tmp_folder}/part-dir/y.gz", ["e"], True)
    write_lines(f"{tmp_folder}/part-3.zip.txt", ["f"])
    write_lines(f"{tmp_folder}/other.gzip", ["no"], True)
    got = read_enriched(spark, tmp_folder, positions=True)
    assert sorted(r["value"] for r in got.collect()) == list("abcdef")
    assert got.columns == ["value", "file", "block"]
    assert sorted(r["value"] for r in read_enriched(spark, tmp_folder).collect()) == list("abcdef")


# -- S1, J3, F1, F2: positions ---------------------------------------------------

def test_row_ids_dont_depend_on_splits(spark, tmp_folder):
    rng = random.Random(2)
    for k in range(3):
        lines = [make_line(event_id=f"e{rng.randrange(400)}", fingerprint="f") for _ in range(300 + k)]
        write_lines(f"{tmp_folder}/run/part-{k}", lines)
    write_lines(f"{tmp_folder}/run/part-3.gzip", [make_line(event_id=f"g{k % 7}") for k in range(50)], True)
    write_lines(f"{tmp_folder}/run/part-4", [make_line(event_id="one")])
    root = f"{tmp_folder}/m"
    init_manifest(spark, spark.createDataFrame([(f"e{k}", "f", T) for k in range(0, 400, 3)], MANIFEST), root)
    seen = []
    for size, cost in (("128m", "4m"), ("7000", "0"), ("1000", "100")):
        with conf(spark, spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes=cost):
            staged = stage_triples(spark, read_enriched(spark, f"{tmp_folder}/run", positions=True))
            rows = read_positioned(spark, staged.path).select("rid", "line", F.regexp_extract("file", "[^/]+$", 0).alias("file"),
                                                              "eventid").orderBy("rid").collect()
            result = run_cleanup(spark, f"{tmp_folder}/run", root, publish=False, quiet=True)
            seen.append((rows, result.deleted, run_outcome(spark, result, root).where("deleted").count()))
    assert seen[0] == seen[1] == seen[2]
    rows = seen[0][0]
    assert [(r["file"], r["line"]) for r in rows] == [
        (f"part-{k}{'.gzip' if k == 3 else ''}", n + 1) for k, size in enumerate((300, 301, 302, 50, 1)) for n in range(size)]
    assert len({r["rid"] for r in rows}) == len(rows) and seen[0][1] == seen[0][2] > 0


def test_failing_lines_have_a_place_and_a_short_message(spark, tmp_folder):
    good = [make_line(event_id=f"e{k}") for k in range(40)]
    long = "x" * 5000
    write_lines(f"{tmp_folder}/part-0", good + [make_line(event_id="m", fingerprint=""), *good, "", long])
    write_lines(f"{tmp_folder}/part-1", [make_line(event_id="t", etl="2017-07-20"), *good, make_line(event_id="r", etl="2040-01-01 00:00:00.000")])
    with conf(spark, spark__sql__files__maxPartitionBytes="3000", spark__sql__files__openCostInBytes="0"):
        got = {(r["file"][-6:], r["line"]): r for r in located_failures(spark, tmp_folder).collect()}
    assert {k: r["problem"] for k, r in got.items()} == {
        ("part-0", 41): "malformed", ("part-0", 82): "malformed", ("part-0", 83): "malformed",
        ("part-1", 1): "bad_timestamp", ("part-1", 42): "out_of_range"}
    assert got["part-0", 83]["value"] == long and len(got["part-0", 83]["message"]) < 250
    assert "2017-07-20" in got["part-1", 1]["message"] and got["part-1", 42]["eventid"] == "r"
    assert {k[1] for k in {(r["file"], r["line"]) for r in located_failures(spark, tmp_folder, override=True).collect()}} == {41, 82, 83}


def test_the_check_parses_once(spark, tmp_folder):
    from keysweep.operators import failing_lines

    write_lines(f"{tmp_folder}/part-0", [make_line()])
    plan = failing_lines(read_enriched(spark, tmp_folder))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("gettimestamp") <= 3


# -- K1, S3: whole commits ------------------------------------------------------

def new_manifest(spark, root, rows, **layout):
    init_manifest(spark, spark.createDataFrame(rows, MANIFEST), root, **layout)
    return root


def test_a_torn_commit_is_no_version_and_blocks_nothing(spark, tmp_folder):
    root = new_manifest(spark, f"{tmp_folder}/m", [("a", "fa", T), ("b", "fb", T)])
    write_lines(f"{tmp_folder}/run/part-0", [make_line(event_id="a", fingerprint="fa")])
    whole = fs.read_small(spark, commit_path(root, 1))
    for number, torn in ((2, ""), (3, whole[:40]), (4, whole.replace('"rows": 2', '"rows": 3'))):
        with open(commit_path(root, number), "w") as fh:
            fh.write(torn)
    assert current_version(spark, root) == 1 and published_versions(spark, root) == [1] and commit_numbers(spark, root) == [1, 2, 3, 4]
    assert read_current(spark, root).count() == 2
    result = run_cleanup(spark, f"{tmp_folder}/run", root, quiet=True)
    assert (result.deleted, result.version) == (1, 5)
    assert [r["eventid"] for r in read_current(spark, root).collect()] == ["b"]
    assert published_versions(spark, root) == [1, 5]
    assert set(remove_orphans(spark, root, older_than_seconds=-60)) == {"00000002", "00000003", "00000004"}
    assert run_cleanup(spark, f"{tmp_folder}/run", root, quiet=True).version == 6


def test_a_writer_that_dies_leaves_no_commit(spark, tmp_folder, monkeypatch):
    root = new_manifest(spark, f"{tmp_folder}/m", [("a", "fa", T)])
    rows = spark.createDataFrame([("b", "fb", 2)], MANIFEST)
    monkeypatch.setattr(fs, "_write", lambda stream, content: (stream.write(bytearray(content[:9].encode())), stream.close(), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        publish_snapshot(spark, rows, root)
    monkeypatch.undo()
    assert commit_numbers(spark, root) == [1] and current_version(spark, root) == 1
    # killed before it could clean up: its temporary file is nobody's version, and goes with the orphans
    with open(f"{root}/_commits/{fs.TEMPORARY}x", "w") as fh:
        fh.write("{")
    assert publish_snapshot(spark, rows, root) == (2, 1)
    assert fs.TEMPORARY + "x" in remove_orphans(spark, root, older_than_seconds=-60)
    assert read_current(spark, root).count() == 1


def test_one_name_is_given_once(spark, tmp_folder):
    from concurrent.futures import ThreadPoolExecutor

    path = f"{tmp_folder}/c/00000001"
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: fs.create_marker(spark, path, f"content {k} " * 500), range(16)))
    assert sum(made) == 1
    assert fs.read_small(spark, path) == f"content {made.index(True)} " * 500
    assert [n for n in os.listdir(f"{tmp_folder}/c") if not n.startswith(".")] == ["00000001"]


def test_commits_of_earlier_releases_are_read():
    old = json.dumps({"rows": 3, "days": {"0": ["w", 3]}})
    assert Commit.from_text(old) == Commit({"0": ("w", 3)})
    new = Commit({"0": ("w", 3), "5.1-of-4": ("x", 2)}, {"lines": 7})
    assert Commit.from_text(new.to_text()) == new and new.buckets == {"5": 4} and split_part("5.1-of-4") == ("5", 4)


# -- K1, J2: files by bytes, key buckets ------------------------------------------

def part_files(root, commit):
    return {p: sorted(n for n in os.listdir(day_path(root, w, p)) if n.startswith("part-")) for p, (w, _) in commit.days.items()}


def test_files_follow_bytes_not_tasks_times_days(spark, tmp_folder):
    rows = [(f"e{k}", "f", T - (k % 20) * DAY) for k in range(4000)]
    root = f"{tmp_folder}/m"
    publish_snapshot(spark, spark.createDataFrame(rows, MANIFEST).repartition(8), root)
    files = part_files(root, read_commit(spark, root, 1))
    assert len(files) == 20 and all(len(f) == 1 for f in files.values())
    # a day larger than the advisory size is written by several tasks
    big = spark.range(400_000).selectExpr("md5(CAST(id AS STRING)) AS eventid", "md5(CAST(-id AS STRING)) AS fingerprint",
                                          f"CAST({T} AS INT) AS etltime").repartition(8)
    with conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="4m"):
        publish_snapshot(spark, big, f"{tmp_folder}/big")
    files = part_files(f"{tmp_folder}/big", read_commit(spark, f"{tmp_folder}/big", 1))
    assert [len(f) for f in files.values()][0] >= 4 and read_current(spark, f"{tmp_folder}/big").count() == 400_000


def test_an_ordered_run_folder_is_sorted_in_pieces(spark, monkeypatch):
    """No task sorts a whole file; files and the places of lines are as if one did."""
    sizes = []
    join = derived._join_pieces

    def looked(session, pieces, folder):
        found = session.read.text(f"{pieces}/part-*").select(F.col("_metadata.file_path").alias("f"))
        sizes.extend(r["count"] for r in found.groupBy("f").count().collect())
        join(session, pieces, folder)

    monkeypatch.setattr(derived, "_join_pieces", looked)
    monkeypatch.setattr(derived, "ORDERED_LINES", 100)
    ids = [k for k in range(2000) if k % 4 != 2]   # a file number without lines
    random.Random(5).shuffle(ids)
    lines = spark.createDataFrame([(f"line {k} {c}", 2 * k + c) for k in ids for c in range(1 + (k % 7 == 0))], "value string, rid long")
    folder = derived.write_ordered_run_folder(spark, lines.repartition(5))
    assert len(sizes) > 8 and max(sizes) <= 400 and sum(sizes) == lines.count()
    want = {n: [f"line {k} {c}" for k in sorted(ids) if k % 4 == n for c in range(1 + (k % 7 == 0))] for n in (0, 1, 3)}
    path = folder.removeprefix("file:")
    got = {int(d[-1]): [os.path.join(path, d, f) for f in os.listdir(os.path.join(path, d)) if f.startswith("part-")]
           for d in os.listdir(path) if d.startswith("part-")}
    assert all(len(files) == 1 for files in got.values())
    assert {n: open(files[0]).read().splitlines() for n, files in got.items()} == want


def test_lines_are_numbered_without_a_shuffle_of_the_run(spark, tmp_folder):
    write_lines(f"{tmp_folder}/run/part-0", [make_line(event_id=f"e{k}") for k in range(50)])
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        staged = stage_triples(spark, read_enriched(spark, f"{tmp_folder}/run", positions=True))
        plan = read_positioned(spark, staged.path)._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert sorted(r["line"] for r in read_positioned(spark, staged.path).collect()) == list(range(1, 51))


def test_a_small_late_run_rewrites_only_its_buckets(spark, tmp_folder):
    rows = [(f"e{k}", f"f{k % 3}", T) for k in range(1000)] + [(f"d{k}", "f", T - DAY) for k in range(30)] + [("n", "f", None)]
    root = new_manifest(spark, f"{tmp_folder}/m", rows, bucket_rows=100)
    first = read_commit(spark, root, 1)
    assert first.buckets == {str(T // DAY): 16} and {str(T // DAY - 1), "none"} < set(first.days)
    before = part_files(root, first)
    write_lines(f"{tmp_folder}/run/part-0", [make_line(event_id="e5", fingerprint="f2"), make_line(event_id="e5", fingerprint="f2"),
                                             make_line(event_id="absent", fingerprint="f2")])
    result = run_cleanup(spark, f"{tmp_folder}/run", root, quiet=True, verify=True, check_keys=True)
    assert (result.deleted, result.skipped) == (1, 2)
    second = read_commit(spark, root, 2)
    changed = {p for p in first.days if second.days.get(p) != first.days[p]}
    assert 1 <= len(changed) <= 2 and all(split_part(p)[1] == 16 for p in changed)
    for p in set(first.days) - changed:
        assert part_files(root, second)[p] == before[p]
    assert sorted(map(repr, map(tuple, read_current(spark, root).collect()))) == sorted(map(repr, [r for r in rows if r[0] != "e5"]))
    outcome = run_outcome(spark, result, root)
    assert (outcome.where("deleted").count(), outcome.where("not deleted").count()) == (1, 2)


@pytest.mark.parametrize("bucket_rows", [1, 7, 10 ** 9])
def test_buckets_change_no_result(spark, tmp_folder, bucket_rows):
    rng = random.Random(bucket_rows)
    times = [T, T + 3600, T - DAY]
    rows = [(f"e{k}", f"f{k % 3}", rng.choice([*times, None])) for k in range(40)]
    events = [(rng.choice(rows), rng.choice(times)) for _ in range(50)]
    stamps = {t: datetime.fromtimestamp(t, timezone.utc).strftime("%Y-%m-%d %H:%M:%S.000") for t in times}
    gone = {(e, f, t) for (e, f, stored), t in events if stored == t}
    root = new_manifest(spark, f"{tmp_folder}/m", rows, bucket_rows=bucket_rows)
    for part in (0, 1):   # two runs, the second over a version whose buckets may have become empty
        write_lines(f"{tmp_folder}/run{part}/part-0", [make_line(event_id=e, fingerprint=f, etl=stamps[t])
                                                       for (e, f, _), t in events[part::2]] or [make_line()])
        run_cleanup(spark, f"{tmp_folder}/run{part}", root, quiet=True, verify=True)
    assert sorted(map(repr, map(tuple, read_current(spark, root).collect()))) == sorted(repr(r) for r in rows if r not in gone)


def test_small_buckets_share_folders(spark, tmp_folder, monkeypatch):
    """Folders and files follow the rows, not the number of buckets; versions and their removal work as before."""
    rows = [(f"e{k}", f"f{k % 3}", T) for k in range(1000)] + [(f"d{k}", "f", T - DAY) for k in range(3)] + [("n", "f", None)]
    folders = {}
    for limit in (10 ** 6, 80):
        monkeypatch.setattr(snapshot, "FOLDER_ROWS", limit)
        root = new_manifest(spark, f"{tmp_folder}/m{limit}", rows, bucket_rows=5)
        first = read_commit(spark, root, 1)
        assert first.buckets == {str(T // DAY): 256} and first.rows == 1004
        folders[limit] = len({day_path(root, w, p) for p, (w, _) in first.days.items()})
        write_lines(f"{tmp_folder}/run{limit}/part-0", [make_line(event_id=f"e{k}", fingerprint=f"f{k % 3}") for k in (5, 6, 7, 7)])
        result = run_cleanup(spark, f"{tmp_folder}/run{limit}", root, quiet=True, verify=True, check_keys=True)
        assert (result.deleted, result.skipped) == (3, 1)
        changed = {p for p, v in first.days.items() if read_commit(spark, root, 2).days.get(p) != v}
        assert 1 <= len(changed) <= 3
        left = sorted(repr(r) for r in rows if r[0] not in ("e5", "e6", "e7"))
        assert expire_snapshots(spark, root, 1) == [1]
        for p in first.days.keys() - changed:   # still named by version 2, whatever shares its folder
            assert os.path.exists(day_path(root, *(first.days[p][0], p)))
        assert sorted(map(repr, map(tuple, read_current(spark, root).collect()))) == left
        assert run_outcome(spark, run_cleanup(spark, f"{tmp_folder}/run{limit}", root, quiet=True), root).where("deleted").count() == 0
        monkeypatch.setattr(snapshot, "FOLDER_ROWS", 1)   # from now on buckets have folders of their own
        write_lines(f"{tmp_folder}/more{limit}/part-0", [make_line(event_id="e9", fingerprint="f0")])
        assert run_cleanup(spark, f"{tmp_folder}/more{limit}", root, quiet=True, verify=True).deleted == 1
        assert sorted(map(repr, map(tuple, read_current(spark, root).collect()))) == [r for r in left if not r.startswith("('e9',")]
    assert folders == {10 ** 6: 3, 80: 256 // 16 + 2}


# -- A1-A3: reports from commits ---------------------------------------------------

def test_a_report_can_be_read_from_its_commit(spark, tmp_folder, capsys):
    root = new_manifest(spark, f"{tmp_folder}/m", [("a", "fa", T), ("b", "fb", 1)])
    write_lines(f"{tmp_folder}/run/part-0", [make_line(event_id=e, fingerprint=f"f{e}") for e in "aabz"])
    result = run_cleanup(spark, f"{tmp_folder}/run", root)
    printed = capsys.readouterr().out.strip()
    assert run_report(spark, root, result.version) == result.report() == printed
    assert read_commit(spark, root, 2).run == {"folder": f"{tmp_folder}/run", "time": None, "lines": 4, "deleted": 1, "skipped": 3, "base": 1}
    with pytest.raises(ValueError, match="wasn't published by a cleanup"):
        run_report(spark, root, 1)


def test_upkeep_commands(spark, tmp_folder, capsys):
    root, export = f"{tmp_folder}/m", f"{tmp_folder}/export"
    spark.createDataFrame([("a", "fa", T), ("b", "fb", 1)], "eventId string, fingerprint string, etlTime int").write.parquet(export)
    assert main(["--manifest", root, "--init", export]) == 0
    write_lines(f"{tmp_folder}/run/part-0", [make_line(event_id="a", fingerprint="fa")])
    assert main(["--run-folder", f"{tmp_folder}/run", "--manifest", root]) == 0
    with open(commit_path(root, 3), "w") as fh:
        fh.write('{"rows"')
    capsys.readouterr()
    assert main(["--manifest", root, "--versions"]) == main(["--manifest", root, "--report", "2"]) == 0
    out = capsys.readouterr().out
    assert "1: 2 rows in 2 folders" in out and "2: 1 rows" in out and "3: torn" in out and "deleted 1 events. 0 events were skipped" in out
    assert main(["--manifest", root, "--expire", "1"]) == main(["--manifest", root, "--remove-orphans", "604800"]) == 0
    assert published_versions(spark, root) == [2] and read_current(spark, root).count() == 1
    for wrong in (["--manifest", root, "--versions", "--expire", "1"], ["--versions"], ["--manifest", root],
                  ["--run-folder", "r", "--manifest", root, "--report", "1"]):
        with pytest.raises(SystemExit):
            parse_args(wrong)


# -- K2: the ledger -------------------------------------------------------------------

class Store(FolderStore):
    """A folder store that logs its calls, and fails or dies where told to: ``trouble`` is a file a call."""

    def delete(self, event_id, fingerprint, etl_time):
        trouble = os.path.join(self.folder, "trouble", event_id)
        kind = open(trouble).read() if os.path.exists(trouble) else ""
        if kind.startswith("before"):
            self._over(trouble, kind)
            raise RuntimeError(f"throttled {event_id}")
        done = super().delete(event_id, fingerprint, etl_time)
        with open(os.path.join(self.folder, f"log-{os.getpid()}"), "a") as fh:
            fh.write(f"{event_id} {done}\n")
        if kind.startswith("after"):
            self._over(trouble, kind)
            raise RuntimeError(f"timeout {event_id}")
        if kind == "die":
            os.remove(trouble)
            os._exit(1)
        return done

    @staticmethod
    def _over(trouble, kind):
        if not kind.endswith("always"):
            os.remove(trouble)


def store_run(tmp_folder, trouble):
    folder = os.path.join(tmp_folder, "store")
    os.makedirs(os.path.join(folder, "trouble"))
    store = Store(folder)
    for k in range(20):
        if k % 4 != 3:
            store.put(f"e{k}", "f", T if k % 4 else T - DAY)
    for name, kind in trouble.items():
        with open(os.path.join(folder, "trouble", name), "w") as fh:
            fh.write(kind)
    write_lines(f"{tmp_folder}/run/part-0", [make_line(event_id=f"e{k}", fingerprint="f") for k in [*range(20), 1, 1, 3]])
    return folder, f"{tmp_folder}/run", f"{tmp_folder}/ledger"


DELETED = {f"e{k}" for k in range(20) if k % 4 in (1, 2)}


def outcomes(spark, result):
    got = {r["eventid"]: r["outcome"] for r in store_outcome(spark, result).collect()}
    assert len(got) == store_outcome(spark, result).count() == 20
    return got


@pytest.mark.parametrize("look", [False, True])
@pytest.mark.parametrize("concurrency", [1, 3])
def test_store_errors_are_sent_again_and_totals_hold(spark, tmp_folder, look, concurrency):
    folder, run, ledger = store_run(tmp_folder, {"e1": "before", "e2": "before", "e3": "before", "e9": "before"})
    result = run_store_cleanup(spark, run, lambda: Store(folder), parallelism=3, concurrency=concurrency, quiet=True, ledger=ledger, look=look)
    assert {e for e, o in outcomes(spark, result).items() if o == "deleted"} == DELETED
    if look:
        assert (result.deleted, result.skipped, result.lines, result.exact) == (10, 13, 23, True)
    else:   # e3 isn't there; as its first call raised, nobody can know that it never was
        assert (result.deleted, result.lines, result.unknown) == (10, 23, 1)
    logs = [x for n in os.listdir(folder) if n.startswith("log-") for x in open(os.path.join(folder, n)).read().splitlines()]
    assert sorted(x.split()[0] for x in logs if x.endswith("True")) == sorted(DELETED)


@pytest.mark.parametrize("look", [False, True])
def test_a_call_that_deletes_and_raises(spark, tmp_folder, look):
    folder, run, ledger = store_run(tmp_folder, {"e1": "after", "e6": "after"})
    result = run_store_cleanup(spark, run, lambda: Store(folder), parallelism=2, quiet=True, ledger=ledger, look=look)
    got = outcomes(spark, result)
    assert (got["e1"], got["e6"]) == (("deleted",) * 2 if look else ("unknown",) * 2)
    assert (result.deleted, result.unknown, result.exact) == ((10, 0, True) if look else (8, 2, False))


@pytest.mark.parametrize("look", [False, True])
def test_a_job_that_dies_is_resumed(spark, tmp_folder, look):
    folder, run, ledger = store_run(tmp_folder, {"e5": "die"})
    with pytest.raises(Exception, match="exited|crashed|EOF"):
        run_store_cleanup(spark, run, lambda: Store(folder), parallelism=1, quiet=True, ledger=ledger, look=look)
    book = Ledger(spark, ledger)
    assert book.committed() == [] and book.lost_rounds() and book.begun()["lines"] == 23
    result = run_store_cleanup(spark, run, lambda: Store(folder), parallelism=1, quiet=True, ledger=ledger, look=look)
    got = outcomes(spark, result)
    assert (got["e5"]) == ("deleted" if look else "unknown")
    assert {e for e, o in got.items() if o != "skipped"} >= DELETED
    if look:
        assert (result.deleted, result.skipped, result.exact) == (10, 13, True)
    else:
        assert not result.exact and result.deleted <= 10 <= result.deleted + result.unknown
    # a third call finds everything on record and sends nothing
    again = run_store_cleanup(spark, run, lambda: Store(folder), parallelism=1, quiet=True, ledger=ledger, look=look)
    assert (again.deleted, again.unknown) == (result.deleted, result.unknown)
    with pytest.raises(ValueError, match="belongs to the run"):
        run_store_cleanup(spark, run, lambda: Store(folder), override_time="2017-07-20-14-44-13", quiet=True, ledger=ledger)


def test_a_store_that_keeps_failing_fails_the_job_and_can_be_resumed(spark, tmp_folder):
    folder, run, ledger = store_run(tmp_folder, {"e7": "before always"})
    with pytest.raises(StoreError, match="throttled e7"):
        run_store_cleanup(spark, run, lambda: Store(folder), quiet=True, ledger=ledger)
    totals = Ledger(spark, ledger).totals()
    assert sum(totals.values()) == 19 and totals["deleted"] == 10
    os.remove(os.path.join(folder, "trouble", "e7"))
    result = run_store_cleanup(spark, run, lambda: Store(folder), quiet=True, ledger=ledger)
    assert (result.deleted, result.unknown, result.sent) == (10, 1, 20)


def test_a_later_attempt_knows_that_it_is_one(spark, tmp_folder, monkeypatch):
    import pyarrow as pa

    from keysweep.sinks import store

    class Second:
        @staticmethod
        def get():
            return Second

        @staticmethod
        def attemptNumber():
            return 1

    monkeypatch.setattr(store, "TaskContext", Second)

    class Client:
        def delete(self, event_id, fingerprint, etl_time):
            return event_id == "a"

    batch = pa.RecordBatch.from_pydict({"eventid": ["a", "b", "c", "d"], "fingerprint": ["f"] * 4, "etltime": [1] * 4,
                                        "unsure": [False] * 4, "present": [None, None, True, False]})
    out = list(store._calls(Client, 1, "delete")([batch]))[0].to_pydict()
    assert out["outcome"] == ["deleted", "unknown", "deleted", "skipped"]


def test_dry_run_against_a_store_sends_nothing(spark, tmp_folder, capsys):
    folder, run, _ = store_run(tmp_folder, {})
    with open(f"{tmp_folder}/dry_store_of_test.py", "w") as fh:
        fh.write("from keysweep.plans.derived import FolderStore\n\n\nclass Looking(FolderStore):\n    def __init__(self):\n"
                 f"        super().__init__({folder!r})\n\n    def delete(self, *key):\n        raise AssertionError('sent')\n\n\n"
                 "class Blind:\n    def delete(self, *key):\n        raise AssertionError('sent')\n")
    spark.sparkContext.addPyFile(f"{tmp_folder}/dry_store_of_test.py")
    args = ["--run-folder", run, "--store-client", "dry_store_of_test:Looking", "--dry-run"]
    assert main(args) == 0
    assert "deleted 10 events. 13 events were skipped" in capsys.readouterr().out
    with pytest.raises(Exception, match="present"):
        main([*args[:3], "dry_store_of_test:Blind", "--dry-run"])
    for more in (["--verify"], ["--check-keys"], ["--keep-snapshots", "1"], ["--manifest", "m"], ["--ledger", "x"]):
        with pytest.raises(SystemExit):
            parse_args([*args, *more])
    with pytest.raises(SystemExit):
        parse_args(["--run-folder", run, "--manifest", "m", "--look"])
    assert sys.modules.get("dry_store_of_test") is not None


def test_store_and_snapshot_paths_agree(spark, tmp_folder):
    from keysweep.plans.derived import write_folder_store, write_run_folder

    events = read_table(spark, SF_SMALL, "events")
    run = write_run_folder(spark, run_lines(events))
    folder = write_folder_store(spark, manifest_table(events))
    sent = run_store_cleanup(spark, run, lambda: FolderStore(folder), quiet=True)
    init_manifest(spark, manifest_table(events), f"{tmp_folder}/m")
    snap = run_cleanup(spark, run, f"{tmp_folder}/m", quiet=True)
    assert (sent.deleted, sent.skipped, sent.lines, sent.unknown) == (snap.deleted, snap.skipped, snap.lines, 0)
    with pytest.raises(PublishError):
        init_manifest(spark, manifest_table(events), f"{tmp_folder}/m")
