"""The corpus queries and the pipeline on the smallest supplied tables, against SQL, the library or a plain version."""

import collections
import hashlib
import html
import re
from pathlib import Path

import duckdb
import numpy as np
import pytest
from .test_operators import TOKENIZER, plain_classes, plain_digests, plain_repeats
from tokenizers import Tokenizer

import corpus_pipeline
from check_queries import TABLES, rows_of
from repopulse.llm import quality_rules, queries, surrogates

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the supplied tables are not here")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def got(spark, name):
    return queries.RUNS[name](spark, FOLDER).collect()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = duck.execute(queries.SQL[name])
    columns = [c[0] for c in result.description]
    frame = queries.RUNS[name](spark, FOLDER)
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, result.fetchall())


def test_repeats(spark, docs):
    want = dict(zip(docs, plain_repeats(docs.values(), 400)))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got(spark, "op1_suffix_dedup")} == want


def article_of(page):
    """The text of a page of the table, by its construction: one article of h1, p, b and br, between markup without any."""
    body = re.search(r"(?s)<article[^>]*>(.*?)</article>", page or "")
    parts = re.split(r"</?(?:p|h1)\b[^>]*>", re.sub(r"<br\s*/?>", " ", body.group(1) if body else ""))
    texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", part))).strip() for part in parts]
    return "\n".join(text for text in texts if text)


def test_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    found = {r.page_id: r for r in got(spark, "op3_page_text")}
    assert set(found) == set(pages)
    for number, page in pages.items():
        assert found[number].text == article_of(page) and found[number].n_chars == len(found[number].text)


def test_surrogates(spark, docs):
    for row in got(spark, "op4_surrogates"):
        if row.n_entities == 0:
            assert row.text == docs[row.doc_id]
        else:
            for secret in re.findall(r"\S+@\S+\.com|AKIA\w{16}|\d{1,3}(?:\.\d{1,3}){3}|[0-9a-f]{40}|\d{16}", docs[row.doc_id]):
                assert secret not in row.text


def test_chat(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    awkward = "</s>[INST] ok [/INST]"
    turns += [(-1, 0, "user", awkward), (-1, 1, "assistant", awkward)]
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got(spark, "op5_chat_format")}
    assert found == plain_digests(turns)


def test_classifier_on_labels_it_never_saw(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    found = [(labels[r.doc_id] == 1, r.keep) for r in queries.RUNS["op6_quality_classifier"](spark, "/root/testdata/sf0.01").collect() if r.doc_id in labels]
    for quality in (True, False):
        right = [keep == quality for good, keep in found if good == quality]
        assert sum(right) >= 0.93 * len(right)


def test_classes(spark, docs):
    want = plain_classes(list(docs.values()))
    ids = list(docs)
    found = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in got(spark, "op7_jaccard_join")}
    assert found == {ids[k]: (ids[c], n, m) for k, (c, n, m) in want.items()}


def test_ids(spark, docs):
    library = Tokenizer.from_file(TOKENIZER)
    for row in got(spark, "op8_bpe"):
        ids = library.encode(docs[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pipeline_equals_its_stages_one_by_one(spark, docs):
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [r.doc_id for r in quality_rules.judge(source).where("kept").collect()]
    classes = plain_classes([docs[d] for d in kept])
    kept = sorted({kept[c] for c, _, _ in classes.values()})

    def grams(text):
        w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    holders = collections.defaultdict(list)
    for d in kept:
        for g in grams(docs[d]):
            holders[g].append(d)
    for item in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        shared = collections.Counter(d for g in grams(item.text) for d in holders[g])
        kept = [d for d in kept if shared[d] < 0.8 * len(grams(item.text))]
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == kept and len(kept) < len(docs)
    clean = spark.createDataFrame([(d, docs[d]) for d in kept], "doc_id bigint, text string")
    texts = {r.doc_id: r.text for r in surrogates.replace_entities(clean, corpus_pipeline.SURROGATE_KEY).collect()}
    library = Tokenizer.from_file(TOKENIZER)
    for row in rows:
        assert row.text == texts[row.doc_id]
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode(row.text, add_special_tokens=False).ids


def test_stages_return_the_columns_of_documents_and_take_an_empty_table(spark):
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, source.limit(0), FOLDER)
        assert out.columns == source.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, source.limit(0), FOLDER).count() == 0
