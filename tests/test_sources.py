"""Landing files, stored tables, CSV exchange, run logs and the load job."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from repopulse.plans.ingest import load
from repopulse.schemas import DISCUSSIONS, MODEL_REPOS, empty_table
from repopulse.session import shared_folder
from repopulse.sources import csv_files, landing, run_log, tables
from repopulse.sources.buckets import open_table

DAY = dt.datetime(2025, 1, 6, 10, 30)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / f"{name}-{uuid.uuid4().hex}")


def write_lines(path, records):
    with open(path, "w", encoding="utf-8") as out:
        out.writelines(json.dumps(r) + "\n" for r in records)
    return str(path)


LISTED = [
    {"id": "a/one", "tag": "t1", "likes": 4, "downloads": 90, "created_at": "2025-01-06T10:30:00Z", "seq": 0},
    {"id": "a/two", "tag": "t1", "author": " me ", "downloads": 80, "created_at": "unknown", "seq": 1},
    {"id": "a/three", "tag": "t1", "downloads": -5, "seq": 2},
    {"id": "a/one", "tag": "t2", "likes": 5, "downloads": 91, "seq": 3},
    {"id": "", "tag": "t2", "downloads": 1, "seq": 4},
    {"tag": "t2", "downloads": 2, "seq": 5},
]
THREADS = [
    {"model_id": "a/one", "num": 1, "title": " Q ", "status": "CLOSED", "closed_at": "2025-01-07", "seq": 0},
    {"model_id": "a/one", "title": None, "status": " closed ", "is_pull_request": True, "seq": 1},
    {"model_id": "a/two", "num": 1, "status": None, "created_at": "2025-01-06T10:30:00+02:00", "seq": 2},
    {"model_id": "a/gone", "num": 7, "status": "open", "seq": 3},
    {"model_id": None, "num": 8, "status": "open", "seq": 4},
    {"model_id": "a/three", "fetch_error": "403 disabled"},
]


def test_listings_become_flat_rows(spark, tmp_path, rows):
    path = write_lines(tmp_path / "models.json", LISTED)
    flat = landing.model_rows(landing.read_model_listings(spark, path))
    assert rows(flat, "model_id", "likes", "created_at")[:3] == [
        ("", 0, None),
        ("a/one", 4, DAY),
        ("a/one", 5, None),
    ]
    top = landing.top_model_rows(landing.read_model_listings(spark, path), ["t1"], 2)
    assert rows(top, "model_id") == [("a/one",), ("a/two",)]


def test_errors_are_split_off_and_delivered_rows_kept(spark, tmp_path, rows):
    listings = landing.read_discussion_listings(spark, write_lines(tmp_path / "threads.json", THREADS))
    delivered, errors = landing.split_errors(listings)
    assert rows(errors) == [("a/three", "a/three: 403 disabled")]
    assert rows(landing.discussion_rows(delivered), "model_id", "hf_discussion_num", "title", "status")[1:3] == [
        ("a/one", 0, "", " closed "),
        ("a/one", 1, " Q ", "CLOSED"),
    ]
    folded = landing.discussion_rows(delivered, fold_status=True)
    assert {(r.hf_discussion_num, r.status) for r in folded.filter("model_id = 'a/one'").collect()} == {(1, "closed"), (0, "open")}


def test_numbers_in_any_spelling_count_and_others_are_reported(spark, tmp_path, folder, rows):
    path = tmp_path / "models.json"
    good = [{"id": f"m{i}", "tag": "t", "likes": v, "seq": i} for i, v in enumerate(["12", 1.9, 3, None, "-1.5"])]
    bad = [{"id": "m7", "tag": "t", "likes": "abc"}, {"id": "m8", "tag": "t", "likes": 10**20}, {"id": "m9", "tag": "t", "seq": "x"}]
    path.write_text("".join(json.dumps(r) + "\n" for r in good + bad) + '{"id": "m10", "ta\n')
    listings = landing.read_model_listings(spark, str(path))
    usable, messages = landing.split_unreadable(listings, landing.MODEL_COUNTS)
    assert rows(landing.model_rows(usable), "model_id", "likes") == [("m0", 12), ("m1", 1), ("m2", 3), ("m3", 0), ("m4", -1)]
    found = [m for _, m in rows(messages, "model_id", "message")]
    assert sum(m.startswith("unusable likes") for m in found) == 2 and sum(m.startswith("unusable seq: x") for m in found) == 1
    assert sum(m.startswith("unreadable record") for m in found) == 1
    threads = landing.read_discussion_listings(spark, write_lines(tmp_path / "threads.json", [{"model_id": "m0", "num": "x"}]))
    loaded = load(listings, threads, folder("run"), fold_status=True)
    counts = {r.item: int(r.value) for r in loaded.summary.filter("section = 'count'").collect()}
    assert (counts["models_loaded"], counts["models_unreadable"], counts["discussions_unreadable"]) == (5, 4, 1)
    assert loaded.summary.filter("section = 'unreadable_record'").count() == 5


def test_concatenation_keeps_repeats(spark, tmp_path):
    listings = landing.read_model_listings(spark, write_lines(tmp_path / "models.json", LISTED))
    assert landing.concatenate(listings, listings, listings).count() == 18


def test_load_twice_equals_load_once(spark, tmp_path, folder, rows):
    models = landing.read_model_listings(spark, write_lines(tmp_path / "models.json", LISTED))
    threads = landing.read_discussion_listings(spark, write_lines(tmp_path / "threads.json", THREADS))
    first, second = folder("run"), folder("run")
    loaded = load(models, threads, first, notes=["one", "two"])
    counts = {r.item: int(r.value) for r in loaded.summary.filter("section = 'count'").collect()}
    assert counts == {
        "models_seen": 6,
        "models_cleaned": 4,
        "models_loaded": 4,
        "discussions_seen": 5,
        "discussions_cleaned": 4,
        "discussions_loaded": 3,
        "models_unreadable": 0,
        "discussions_unreadable": 0,
    }
    assert rows(loaded.summary.filter("section = 'fetch_error'"), "item", "value") == [("a/three", "a/three: 403 disabled")]
    assert loaded.summary.filter("section = 'limitation'").count() == 2
    assert rows(loaded.repos, "model_id", "tag", "likes", "downloads", "author") == [
        ("a/one", "t2", 5, 91, None),
        ("a/three", "t1", 0, 0, None),
        ("a/two", "t1", 0, 80, "me"),
    ]
    names = {r.id: r.model_id for r in loaded.repos.collect()}
    assert sorted((names[r.repo_id], r.hf_discussion_num, r.title, r.status) for r in loaded.discussions.collect()) == [
        ("a/one", 0, "", "closed"),
        ("a/one", 1, "Q", "closed"),
        ("a/two", 1, "", "open"),
    ]
    again = load(models, threads, second, current=first)
    assert rows(again.repos) == rows(loaded.repos) and rows(again.discussions) == rows(loaded.discussions)


def test_load_of_the_top_repositories_only(spark, tmp_path, folder, rows):
    models = landing.read_model_listings(spark, write_lines(tmp_path / "models.json", LISTED))
    threads = landing.read_discussion_listings(spark, write_lines(tmp_path / "threads.json", THREADS))
    loaded = load(models, threads, folder("run"), tags=["t1"], top_n=1)
    assert rows(loaded.repos, "model_id") == [("a/one",)] and loaded.discussions.count() == 2


def test_stored_tables(spark, folder):
    path = folder("table")
    assert tables.read_or_empty(spark, path, DISCUSSIONS).count() == 0
    frame = empty_table(spark, DISCUSSIONS)
    assert tables.write_table(frame, path, DISCUSSIONS).count() == 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_table(frame, path, DISCUSSIONS)


def test_csv_round_trip(spark, folder, rows):
    odd = ['say "hi", you', "two\nlines", "", "  padded ", "back\\slash", 'end"', "é,ü"]
    frame = spark.createDataFrame(
        [(i, 1, i, t, None if i % 2 else "me", i % 3 == 0, "open", DAY if i % 2 else None, None) for i, t in enumerate(odd)],
        DISCUSSIONS,
    )
    path = folder("csv")
    csv_files.export_csv(frame, path)
    back = csv_files.import_csv(spark, path, DISCUSSIONS)
    assert [f.dataType for f in back.schema] == [f.dataType for f in DISCUSSIONS]
    assert rows(back) == rows(frame)


def test_csv_import_parses_both_times_and_rejects_bad_values(spark, tmp_path):
    header = ",".join(f.name for f in MODEL_REPOS)
    good = tmp_path / "good.csv"
    good.write_text(f"{header}\n1,m,t,,2,3,,2025-01-06T10:30:00.000000,2025-01-06T10:30:00.000000\n")
    row = csv_files.import_csv(spark, str(good), MODEL_REPOS).collect()[0]
    assert (row.created_at, row.last_modified, row.author) == (DAY, DAY, None)
    bad = tmp_path / "bad.csv"
    bad.write_text(f"{header}\n1,m,t,,many,3,,,\n")
    with pytest.raises(Exception, match="MALFORMED"):
        csv_files.import_csv(spark, str(bad), MODEL_REPOS).collect()


def test_run_log_with_one_report_per_file(spark, tmp_path, rows):
    def run(backend, ok, seconds):
        return {"backend": backend, "label": backend.upper(), "ok": ok, "elapsed_seconds": seconds, "stdout_len": 1}

    report = {
        "prompts": [
            {"prompt": "p1", "code_chars": 10, "runs": [run("local", True, 0.5), run("cloud", False, 9.0)]},
            {"prompt": "p2", "code_chars": 20, "runs": [run("local", True, 0.25), run("cloud", True, 5.0)]},
            {"prompt": "p3", "code_chars": 5, "runs": []},
        ]
    }
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text(json.dumps(report, indent=2))
    runs = run_log.flatten_runs(run_log.read_run_log(spark, str(tmp_path / "log")))
    assert rows(runs, "prompt", "backend", "ok") == [
        ("p1", "cloud", False),
        ("p1", "local", True),
        ("p2", "cloud", True),
        ("p2", "local", True),
    ]
    assert rows(run_log.backend_summary(runs)) == [("cloud", 2, 1, 0.5, 7.0), ("local", 2, 2, 1.0, 0.375)]


def test_long_reports_are_cut_by_record(spark, tmp_path, rows):
    def prompt(i):
        runs = [{"backend": b, "label": '}\n    {\n"', "ok": i % 3 > 0, "elapsed_seconds": i / 8, "notes": "é{}]"} for b in ("x", "y")]
        return {"prompt": f"p{i}\n    }}", "code_generation_seconds": 0.5, "code_chars": i, "runs": runs[: i % 3]}

    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "long.json").write_text(json.dumps({"prompts": [prompt(i) for i in range(2000)]}, indent=2))
    (folder / "none.json").write_text(json.dumps({"prompts": []}, indent=2))
    (folder / "empty.json").write_text("")
    several = [{"prompts": [prompt(5000), prompt(5001)]}, {"prompts": []}, {"prompts": [prompt(5002)]}]
    (folder / "several.json").write_text("\n".join(json.dumps(r, indent=2) for r in several))
    expected = [prompt(i) for i in [*range(2000), 5000, 5001, 5002]]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20011b")
    try:
        found = run_log.read_prompts(spark, str(folder))
        assert found.rdd.getNumPartitions() > 10
        assert rows(found, "prompt", "code_chars") == sorted(((p["prompt"], p["code_chars"]) for p in expected), key=repr)
        runs = rows(run_log.runs_of(found), "prompt", "backend", "label", "ok", "elapsed_seconds", "notes")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert runs == sorted(
        ((p["prompt"], r["backend"], r["label"], r["ok"], r["elapsed_seconds"], r["notes"]) for p in expected for r in p["runs"]), key=repr
    )


@pytest.mark.parametrize("text", [json.dumps({"prompts": [{"prompt": "p"}]}), '{\n  "prompts": [\n    {\n      "prompt": "p"', '{\n  "prompts": [\n    {\n      "prompt": p\n    }\n  ]\n}'])
def test_reports_of_another_layout_are_refused(spark, tmp_path, text):
    path = tmp_path / "other.json"
    path.write_text(text)
    with pytest.raises(Exception, match="not a record|MALFORMED"):
        run_log.read_prompts(spark, str(path)).collect()


def test_shared_folder_is_below_the_configured_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base) and shared_folder(spark) != shared_folder(spark)


def test_landing_reads_only_needed_columns(spark, tmp_path):
    listings = landing.read_discussion_listings(spark, write_lines(tmp_path / "threads.json", THREADS))
    assert listings.select("model_id").agg(F.count("model_id").alias("n")).collect()[0].n == 5


def test_a_load_rewrites_only_the_buckets_it_touches(spark, tmp_path, folder, rows):
    models = [{"id": f"m{i}", "tag": "t", "likes": i, "seq": i} for i in range(200)]
    none = landing.read_discussion_listings(spark, write_lines(tmp_path / "threads.json", []))
    first, second = folder("run"), folder("run")
    listings = landing.read_model_listings(spark, write_lines(tmp_path / "all.json", models))
    load(listings, none, first, buckets=16)
    changed = [{"id": "m7", "tag": "t", "likes": 1000, "seq": 1}, {"id": "new", "tag": "t", "seq": 2}]
    loaded = load(landing.read_model_listings(spark, write_lines(tmp_path / "few.json", changed)), none, second, current=first)
    before, after = (open_table(spark, f"{f}/model_repos", MODEL_REPOS, ("model_id",), 1) for f in (first, second))
    assert len(before.buckets) == len(after.buckets) == 16
    assert sum(before.buckets[b] != after.buckets[b] for b in after.buckets) in (1, 2)
    found = {r.model_id: (r.id, r.likes) for r in loaded.repos.collect()}
    old = {r.model_id: (r.id, r.likes) for r in before.read().collect()}
    assert found == old | {"m7": (old["m7"][0], 1000), "new": (201, 0)}


def test_buckets_split_as_the_table_grows_and_others_keep_their_files(spark, tmp_path, folder):
    none = landing.read_discussion_listings(spark, write_lines(tmp_path / "threads.json", []))
    current, versions, want = None, [], {}
    for load_number, keys in enumerate((range(40), range(40, 160), range(160, 400), [3, 500])):
        lines = [{"id": f"m{i}", "tag": "t", "likes": load_number, "seq": i} for i in keys]
        target = folder("run")
        listings = landing.read_model_listings(spark, write_lines(tmp_path / f"{load_number}.json", lines))
        load(listings, none, target, current=current, buckets=4, bucket_rows=30)
        current = target
        versions.append(open_table(spark, f"{target}/model_repos", MODEL_REPOS, ("model_id",), 1))
        want |= {f"m{i}": load_number for i in keys}
    assert len(versions[0].buckets) >= 4 and len(versions[2].buckets) >= 16
    for version in versions:
        # Labels cover every hash once: the buckets' shares of all hashes add up to one.
        assert sum(2.0 ** (1 - label.bit_length()) for label in version.buckets) == 1
        # Splits go by the average of the halves, so a bucket may hold somewhat more.
        assert all(b.n_rows <= 60 for b in version.buckets.values())
        assert sum(b.n_rows for b in version.buckets.values()) == version.read().count()
    changed = {label for label, b in versions[3].buckets.items() if versions[2].buckets.get(label) != b}
    assert len(versions[3].buckets.keys() & versions[2].buckets.keys()) >= len(versions[2].buckets) - 2 and len(changed) <= 4
    found = versions[3].read().collect()
    assert {r.model_id: r.likes for r in found} == want and sorted(r.id for r in found) == list(range(1, 402))


def test_a_table_starts_with_a_power_of_two_of_buckets(spark):
    with pytest.raises(ValueError, match="power of two"):
        open_table(spark, None, MODEL_REPOS, ("model_id",), 12)
