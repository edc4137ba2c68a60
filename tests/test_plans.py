"""Plan shapes that carry the scale properties (checked on the executed plan)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import make_line
from keysweep.operators import deleted_rows, event_outcome, event_triples, key_violations, kept_rows
from keysweep.schemas import MANIFEST, TRIPLES
from keysweep.sources import read_enriched


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def parquet(spark, folder, name, rows, schema):
    path = os.path.join(folder, name)
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


def test_parse_is_one_codegen_stage_reading_only_the_line(spark, tmp_folder):
    with open(os.path.join(tmp_folder, "part-0"), "w") as fh:
        fh.write(make_line() + "\n")
    df = event_triples(read_enriched(spark, tmp_folder).withColumn("rid", F.monotonically_increasing_id()))
    plan = plan_of(df)
    assert "Exchange" not in plan
    assert "ReadSchema: struct<value:string>" in plan
    assert plan.count("*(1) Project") >= 1 and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_untouched_days_take_no_exchange_and_filters_are_pushed(spark, tmp_folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        day = 86400
        manifest = parquet(spark, tmp_folder, "m", [(f"e{i}", "f", i % 4 * day) for i in range(200)], MANIFEST)
        triples = parquet(spark, tmp_folder, "t", [(f"e{i}", "f", day) for i in range(1, 200, 4)], TRIPLES)
        df = kept_rows(manifest, triples, False, [1])
        plan = plan_of(df)
        untouched, touched = plan.split("Union")[1].split("SortMergeJoin", 1)
        assert "Exchange" not in untouched
        assert f"GreaterThanOrEqual(etltime,{day}), LessThanOrEqual(etltime,{2 * day - 1})" in plan
        # the run side is pre-aggregated; its exchange serves the join too
        assert touched.count("HashAggregate") == 2
        assert df.count() == 150
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_run_side_leaves_the_manifest_unshuffled(spark, tmp_folder):
    manifest = parquet(spark, tmp_folder, "m", [(f"e{i}", "f", 1) for i in range(100)], MANIFEST)
    triples = parquet(spark, tmp_folder, "t", [("e1", "f", 1)] * 10, TRIPLES)
    plan = plan_of(deleted_rows(manifest, triples, broadcast=True))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "Exchange hashpartitioning" not in plan
    assert "HashAggregate" not in plan


def test_outcome_uses_no_window(spark, tmp_folder):
    manifest = parquet(spark, tmp_folder, "m", [("e1", "f", 1)], MANIFEST)
    triples = parquet(spark, tmp_folder, "t", [("e1", "f", 1)] * 5, TRIPLES).withColumn("rid", F.monotonically_increasing_id())
    plan = final_plan(event_outcome(triples, manifest))
    assert "Window" not in plan


def test_key_check_aggregates_before_the_shuffle(spark, tmp_folder):
    manifest = parquet(spark, tmp_folder, "m", [("e1", "f", 1)] * 50, MANIFEST)
    plan = plan_of(key_violations(manifest))
    exchange = plan.index("Exchange")
    assert "partial_count" in plan[exchange:]


def test_joins_on_raw_lines_infer_no_null_filters(spark):
    lines = spark.createDataFrame([(make_line(),)], "value string")
    manifest = spark.createDataFrame([("x", "y", 1)], MANIFEST)
    plan = plan_of(deleted_rows(manifest, event_triples(lines)))
    run_side = plan.split("LeftSemi")[1]
    assert "isnotnull(CASE" not in run_side and "isnotnull(coalesce" not in run_side


def test_outcome_never_shuffles_raw_triples_by_key(spark, tmp_folder):
    """Only aggregated (one row per triple) data is exchanged by key; raw lines move by rid only."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        manifest = parquet(spark, tmp_folder, "m", [(f"e{i}", "f", 1) for i in range(50)], MANIFEST)
        triples = parquet(spark, tmp_folder, "t", [("hot", "f", 1)] * 30 + [("e1", "f", 1)], TRIPLES) \
            .withColumn("rid", F.monotonically_increasing_id())
        df = event_outcome(triples, manifest)
        plan = plan_of(df)
        for line in plan.splitlines():
            if "Exchange hashpartitioning(eventid" in line:
                below = plan[plan.index(line):].splitlines()[1]
                assert "HashAggregate" in below or "Filter" in below or "Project" in below, line
        assert "SortMergeJoin [eventid" not in plan.split("HashAggregate")[-1]
        assert sorted(tuple(r) for r in df.groupBy("eventid", "deleted").count().collect()) == \
            [("e1", True, 1), ("hot", False, 30)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_broadcast_anti_join_reads_the_manifest_once(spark, tmp_folder):
    manifest = parquet(spark, tmp_folder, "m", [(f"e{i}", "f", i % 4) for i in range(100)], MANIFEST)
    triples = parquet(spark, tmp_folder, "t", [("e1", "f", 1)], TRIPLES)
    df = kept_rows(manifest, triples, True, [0])
    plan = plan_of(df)
    assert "Union" not in plan and "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert plan.count("FileScan parquet") == 2      # the manifest once, the run keys once
    assert df.count() == 99


def test_broadcast_bound_covers_the_relation(spark, tmp_folder):
    """The bound is at least the data size that Spark reports for the broadcast."""
    from keysweep.plans.job import read_staged, stage_triples

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    for name, make in {"short": lambda i: (f"e{i}", "f"), "uuid": lambda i: (f"{i:036d}", f"{i:032d}"),
                       "long": lambda i: ("k" * 300 + str(i), "f" * 90), "wide": lambda i: ("\u6f22\U0001f642" * 20 + str(i), "\u00e9")}.items():
        n = 120_000 if name == "uuid" else 20_000
        ids = spark.range(n).select(F.col("id"))
        key, print_ = make(0)
        head = key[:-1] if key[-1] == "0" else key
        eid = F.concat(F.lit(head), F.col("id").cast("string")) if name != "uuid" else F.lpad(F.col("id").cast("string"), 36, "0")
        line = F.concat_ws("\t", F.lit("a"), F.lit("b"), F.lit("2017-07-20 18:47:06.000"), F.lit(""), F.lit(""), F.lit(""),
                           eid, F.lit("\t" * 121), F.lit(print_), F.lit("x"))
        staged = stage_triples(spark, ids.select(line.alias("value")))
        assert staged.lines == n
        manifest = parquet(spark, tmp_folder, f"m-{name}", [("x", "y", 1)], MANIFEST)
        joined = deleted_rows(manifest, read_staged(spark, staged.path), broadcast=True)
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan()
        sizes = []

        def walk(node):
            if node.nodeName().startswith("BroadcastExchange"):
                sizes.append(node.metrics().apply("dataSize").value())
            children = node.children()
            for k in range(children.size()):
                walk(children.apply(k))

        walk(plan)
        assert sizes and max(sizes) > 0 and staged.broadcast_bytes() >= max(sizes), (name, staged.broadcast_bytes(), sizes)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
