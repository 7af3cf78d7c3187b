"""Keyed upserts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from repopulse.operators import joins, upsert

MODEL = (
    "model_id string, tag string, author string, likes long, downloads long, pipeline_tag string,"
    " created_at timestamp_ntz, last_modified timestamp_ntz"
)
THREAD = (
    "hf_discussion_num long, title string, author string, is_pull_request boolean, status string,"
    " created_at timestamp_ntz, closed_at timestamp_ntz"
)
DAY = dt.datetime(2025, 1, 6)


def model(key, tag="t", author="me", likes=1):
    return (key, tag, author, likes, 2, None, DAY, None)


def stored(spark, *keys):
    return spark.createDataFrame([(i + 1, *model(k)) for i, k in enumerate(keys)], f"id long, {MODEL}")


def batch(spark, *models):
    return spark.createDataFrame([(*m, i) for i, m in enumerate(models)], f"{MODEL}, seq long")


def test_update_insert_and_keep(spark, rows):
    after = upsert.upsert_models(stored(spark, "a", "b"), batch(spark, model("b", "u", None, 9), model("c")), ["seq"])
    assert rows(after, "id", "model_id", "tag", "author", "likes") == [
        (1, "a", "t", "me", 1),
        (2, "b", "u", None, 9),
        (3, "c", "t", "me", 1),
    ]


def test_into_an_empty_table_and_from_an_empty_batch(spark, rows):
    nothing = stored(spark, "x").limit(0)
    first = upsert.upsert_models(nothing, batch(spark, model("a"), model("b")), ["seq"])
    assert sorted(r.id for r in first.collect()) == [1, 2]
    table = stored(spark, "a", "b")
    assert rows(upsert.upsert_models(table, batch(spark, model("z")).limit(0), ["seq"])) == rows(table)


def test_later_record_of_a_key_wins(spark, rows):
    twice = batch(spark, model("n", "first"), model("n", "second"), model("a", "x"), model("a", "y"))
    after = upsert.upsert_models(stored(spark, "a"), twice, ["seq"])
    assert rows(after, "id", "model_id", "tag") == [(1, "a", "y"), (2, "n", "second")]


def test_strict_mode_fails_on_a_repeated_new_key_only(spark, rows):
    table = stored(spark, "a")
    known = batch(spark, model("a", "x"), model("a", "y"), model("n"))
    after = upsert.upsert_models(table, known, ["seq"], on_duplicate="error")
    assert rows(after, "model_id", "tag") == [("a", "y"), ("n", "t")]
    with pytest.raises(Exception, match="new key repeated in batch: n"):
        upsert.upsert_models(table, batch(spark, model("n"), model("n")), ["seq"], on_duplicate="error").collect()


def test_new_ids_are_dense_unique_and_repeatable(spark):
    many = batch(spark, *(model(f"k{i}") for i in range(5000)))
    table = stored(spark, "a", "k17")
    ids = {r.model_id: r.id for r in upsert.upsert_models(table, many, ["seq"]).select("model_id", "id").collect()}
    assert sorted(ids.values()) == list(range(1, 5002))
    assert ids["a"] == 1 and ids["k17"] == 2
    again = upsert.upsert_models(table, many.orderBy(F.rand(5)).repartition(7), ["seq"]).select("model_id", "id").collect()
    assert {r.model_id: r.id for r in again} == ids


def test_discussions_against_a_plain_python_upsert(spark, rows):
    rng = random.Random(4)
    repos = spark.createDataFrame([(i, f"m{i}") for i in range(1, 6)], "id long, model_id string")
    table = {(r, n): (1000 + 10 * r + n, r, n, f"old {r} {n}") for r in range(1, 6) for n in range(5)}
    current = spark.createDataFrame(
        [(i, r, n, t, None, False, "open", DAY, None) for i, r, n, t in table.values()], f"id long, repo_id long, {THREAD}"
    )
    incoming = [
        # m1 holds a third of the batch; m8 and m9 are unknown
        (rng.choice(["m1", "m1", "m1", "m2", "m3", "m8", "m9"]), rng.randint(0, 12), f"new {i}", None, True, "closed", None, DAY, i)
        for i in range(400)
    ]
    rows_in = spark.createDataFrame(incoming, f"model_id string, {THREAD}, seq long")
    after = upsert.upsert_discussions(current, repos, rows_in, ["seq"])

    want = {key: value[3] for key, value in table.items()}
    for m, n, title, *_ in incoming:
        if m in {"m1", "m2", "m3"}:
            want[(int(m[1]), n)] = title
    got = after.collect()
    assert {(r.repo_id, r.hf_discussion_num): r.title for r in got} == want and len(got) == len(want)
    assert len({r.id for r in got}) == len(got)
    assert all(r.id == table[k][0] for r in got if (k := (r.repo_id, r.hf_discussion_num)) in table)

    written = after.cache()
    assert rows(upsert.upsert_discussions(written, repos, rows_in, ["seq"])) == rows(written)

    known = sum(m in {"m1", "m2", "m3"} for m, *_ in incoming)
    assert upsert.touched_rows(rows_in, repos).collect()[0].touched_rows == known
    lost = joins.orphans(rows_in, repos).collect()
    assert {r.model_id for r in lost} == {"m8", "m9"} and sum(r.skipped_rows for r in lost) == 400 - known
    actions = upsert.upsert_actions(current, joins.resolve_repo(rows_in, repos), ["repo_id", "hf_discussion_num"]).collect()
    assert {(r.repo_id, r.hf_discussion_num) for r in actions if r.action == "update"} == {
        k for k in want if k in table and want[k].startswith("new")
    }
    assert sum(r.batch_rows for r in actions) == known


def test_new_ids_follow_the_digest_and_move_sixteen_bytes_of_it(spark, monkeypatch):
    import hashlib

    seen, real = {}, upsert.numbered
    monkeypatch.setattr(upsert, "numbered", lambda df, *order: seen.update(df.dtypes) or real(df, *order))
    keys = spark.createDataFrame([(r, n) for r in range(20) for n in (None, 1, 2)], "repo_id long, hf_discussion_num long")
    found = {(r.repo_id, r.hf_discussion_num): r.id for r in upsert.with_new_ids(keys, ["repo_id", "hf_discussion_num"], None, 7).collect()}
    text = lambda key: "/".join(str(k) for k in key if k is not None)
    assert found == {k: 8 + i for i, k in enumerate(sorted(found, key=lambda k: hashlib.md5(text(k).encode()).hexdigest()))}
    assert seen["_hash"] == "binary"
