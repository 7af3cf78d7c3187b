"""Plan shapes that decide how the jobs behave on large and skewed data."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from repopulse.checks.tables import event_discussions, main_discussions, main_repos, sparse_repos
from repopulse.operators import metrics, quality, ranking, upsert, windows

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the supplied tables are not here")

# These write files while they are built, and have plans of the files alone.
WRITERS = {"a01_table_scan", "a13_load_summary"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    text = plan(df)
    return text[: text.index("Initial Plan")] if "Initial Plan" in text else text


@pytest.mark.parametrize("name", sorted(set(entry.all_queries.RUNS) - WRITERS))
def test_no_cross_product_in_any_query(spark, name):
    text = plan(entry.all_queries.RUNS[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_spikes_aggregate_before_any_join_and_read_four_columns(spark):
    text = plan(windows.spikes(main_repos(spark, FOLDER), main_discussions(spark, FOLDER, closed_at=False)))
    lines = text[: text.index("Initial Plan")].splitlines() if "Initial Plan" in text else text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "lineitem" in line)
    indent = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    above = [line for line in lines[:scan] if len(line) - len(line.lstrip(" :+-")) < indent]
    order = [name for line in above[::-1] for name in re.findall(r"HashAggregate|Join|Window|Exchange", line)]
    assert order.index("HashAggregate") < order.index("Exchange") < order.index("Window") < order.index("Join")
    assert re.search(r"ReadSchema: struct<l_suppkey:bigint,l_linenumber:int,l_returnflag:string,l_shipdate", lines[scan])
    assert "PushedFilters: [IsNotNull(l_suppkey)" in lines[scan]


def test_limits_per_key_apply_before_the_shuffle(spark):
    listed = sparse_repos(spark, FOLDER)
    for frame in (ranking.top_listings(listed, n=5), ranking.latest_per_key(listed, ["tag"], ["id"])):
        text = plan(frame)
        assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("row_number(), %d, Partial" % (5 if ", 5, " in text else 1))


def test_engagement_shuffles_the_discussions_once(spark):
    frame = metrics.engagement(sparse_repos(spark, FOLDER), event_discussions(spark, FOLDER))
    frame.collect()
    assert "ReusedExchange [repo_id" in plan(frame)


def test_a_small_batch_never_shuffles_the_stored_table(spark):
    current = spark.read.parquet(f"{FOLDER}/lineitem.parquet").selectExpr(
        "l_orderkey * 8 + l_linenumber AS id",
        "CAST(l_orderkey AS STRING) AS model_id",
        "l_returnflag AS tag",
        "CAST(NULL AS STRING) AS author",
        "l_partkey AS likes",
        "l_suppkey AS downloads",
        "CAST(NULL AS STRING) AS pipeline_tag",
        "l_shipdate AS created_at",
        "l_shipdate AS last_modified",
    )
    batch = current.limit(5).selectExpr("*", "id AS seq")
    text = final_plan(upsert.upsert_models(current, batch, ["seq"]))
    kept = text[: text.index("_group")] if "_group" in text else text
    stored_scan = kept.index("lineitem.parquet")
    assert "Exchange hashpartitioning" not in kept[: kept.index("BroadcastQueryStage")]
    assert stored_scan > 0 and "SortMergeJoin" not in text


def test_a_large_batch_falls_back_to_shuffled_joins(spark, rows):
    table, batch = sparse_repos(spark, FOLDER), sparse_repos(spark, FOLDER)
    full = {c: "CAST(NULL AS TIMESTAMP_NTZ)" for c in ("created_at", "last_modified")}
    extra = [f"{v} AS {k}" for k, v in full.items()] + ["CAST(NULL AS STRING) AS pipeline_tag"]
    table = table.selectExpr("*", *extra)
    batch = batch.selectExpr("concat(model_id, if(id < 50, '', '-new')) AS model_id", "tag", "author", "likes", "downloads", *extra, "id AS seq")
    small = rows(upsert.upsert_models(table, batch, ["seq"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        frame = upsert.upsert_models(table, batch, ["seq"])
        large = rows(frame)
        assert "SortMergeJoin" in final_plan(frame)
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert large == small and len(large) == 250


def test_engagement_has_one_subquery(spark):
    frame = metrics.engagement(sparse_repos(spark, FOLDER), event_discussions(spark, FOLDER))
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("scalar-subquery") == 1


def test_upsert_reads_the_batch_once_and_the_table_twice(spark, tmp_path):
    stored, batch = tmp_path / "stored", tmp_path / "batch"
    frame = main_repos(spark, FOLDER)
    frame.write.parquet(str(stored))
    frame.selectExpr("model_id", "tag", "author", "likes + 1 AS likes", "downloads", "pipeline_tag", "created_at", "last_modified", "id AS seq").write.parquet(str(batch))
    table = spark.read.schema(frame.schema).parquet(str(stored))
    text = plan(upsert.upsert_models(table, spark.read.parquet(str(batch)), ["seq"], top_id=10**6))
    text = text[text.index("Initial Plan") :] if "Initial Plan" in text else text
    assert text.count(f"Location: InMemoryFileIndex(1 paths)[file:{stored}") <= 2 and str(batch) not in text


def test_weekday_trend_folds_history_and_fit_in_one_aggregate(spark):
    text = plan(entry.all_queries.RUNS["j02_weekday_trend_created"](spark, FOLDER))
    assert "Window" not in text and "Union" not in text
    assert text.count("lineitem.parquet") == 1


def test_checks_shuffle_nothing_but_the_keys_of_the_duplicates(spark):
    frame = quality.table_checks(main_repos(spark, FOLDER), main_discussions(spark, FOLDER))
    text = final_plan(frame)
    shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning(repo_id" in line]
    partial = [line for line in text.splitlines() if "HashAggregate(keys=[repo_id" in line and "partial_" in line]
    assert len(shuffled) == 1 and len(partial) == 1
    assert re.search(r"functions=\[partial_count\(1\)\], output=\[repo_id#\d+L, hf_discussion_num#\d+L, count#\d+L\]", partial[0])
