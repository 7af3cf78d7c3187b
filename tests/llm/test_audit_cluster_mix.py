"""Filter audit, centroid clustering and source mixing against plain versions, on small tables of odd rows."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from repopulse.llm import centroids, filter_audit, source_mix

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


# --- filter audit --------------------------------------------------------------------------------


def plain_audit(docs, labels):
    """(part, order, step) -> counts, by walking every order over every document."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    first = {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    rows = []
    for d, text, lang in docs:
        text = text or ""
        w = BLANK.findall(text)
        fails = set()
        fails |= {"A"} if len(w) < 200 else set()
        fails |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        fails |= {"E"} if d is not None and d > first[text] else set()
        rows.append((lang or "", fails, d in good, d in toxic))
    found, removals = {}, Counter()
    parts = {p for p, *_ in rows}
    for part in parts:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                out = [r for r in left if f in r[1]]
                found[part, order, step] = [
                    len(left) - len(out),
                    len(out),
                    sum(f in r[1] for r in gone),
                    sum(r[0] == part and r[1] == {f} for r in rows),
                    sum(r[2] for r in out),
                    sum(r[3] for r in out),
                ]
                removals[part, f] += len(out)
                gone += out
                left = [r for r in left if f not in r[1]]
    return {k: (*v, removals[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def audited(spark, docs, labels, **options):
    table = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id bigint, text string, lang string, part string, n_words string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = filter_audit.audit(table, marks, **options)
    assert found.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    return {tuple(r[:3]): tuple(r[3:]) for r in found.collect()}


def test_audit_equals_a_walk_over_all_orders(spark):
    long = " ".join(f"w{k}" for k in range(250))
    docs = [
        (1, long, "de"),
        (2, long, "de"),
        (3, long, "fr"),
        (3, long, "fr"),
        (None, long, "de"),
        (None, long, None),
        (0, "A B\tC\x0bd\x0cé\x1cf", ""),
        (4, None, None),
        (5, "", "de"),
        (6, "same " * 300, "de"),
        (7, long + " $", "de"),
        (8, long.upper(), "xx"),
        (9, long.upper() + " |", "xx"),
        (10, "a b c " * 120, "xx"),
        (11, "word " * 200_000, "xx"),
    ]
    docs += [(k, long + " copy", "de" if k % 3 else "fr") for k in range(100, 160)]
    labels = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, 0), (6, None, 1), (101, 1, None), (102, 1, 0), (None, 1, 1), (999, 1, 1)]
    want = plain_audit(docs, labels)
    assert audited(spark, docs, labels) == want
    assert audited(spark, docs, labels, shard_bytes=3000) == want


def test_audit_of_an_empty_table(spark):
    assert audited(spark, [], []) == {}


def test_matrix_holds_every_count_under_one_number_for_each_word(spark):
    texts = ["b a b", "", None, "c a \n", "zz " * 5 + "b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    dictionary, shards = filter_audit.document_terms(docs, "text", ["doc_id"], shard_bytes=4)
    words = {r.word_id: r.word.decode() for r in dictionary.collect()}
    assert sorted(words) == [0, 1, 2, 3] and sorted(words.values()) == ["a", "b", "c", "zz"]
    found = {}
    for row in shards.collect():
        starts, ids, data = np.frombuffer(row.indptr, "<i8"), np.frombuffer(row.indices, "<i8"), np.frombuffer(row.data, "<u4")
        for k, doc in enumerate(row.doc_id):
            found[doc] = {words[i]: n for i, n in zip(ids[starts[k] : starts[k + 1]].tolist(), data[starts[k] : starts[k + 1]].tolist())}
    assert found == {k: dict(Counter((t or "").split())) for k, t in enumerate(texts)}


# --- centroids -----------------------------------------------------------------------------------


def plain_clusters(vectors, k, rounds, dimensions):
    kept = []
    for vec_id, x in vectors:
        if x is not None and len(x) == dimensions and all(e is not None and math.isfinite(e) for e in x):
            kept.append((vec_id, [math.floor(64 * e) for e in x]))
    digest = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest())
    centers = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]) if r[0] is not None else (True, ""), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centers = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if groups[n] else c for n, c in enumerate(centers)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, n, d in found:
        inertia[n] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), digests[n]) for i, n, d in found), key=repr)


@pytest.mark.parametrize("k", [1, 4, 40])
def test_clusters_equal_a_plain_version(spark, rows, k):
    random = np.random.default_rng(5)
    vectors = [(i, [float(np.float32(e)) for e in random.normal(0, 0.3, 6)]) for i in range(60)]
    vectors += [(100, [0.5] * 6), (101, [0.5] * 6), (101, [0.5] * 6), (102, [-0.001] * 6), (None, [0.25] * 6), (103, [-0.0] * 6)]
    vectors += [(200, None), (201, []), (202, [1.0] * 5), (203, [1.0] * 7), (204, [1.0] * 5 + [None]), (205, [math.nan] + [0.0] * 5), (206, [math.inf] * 6)]
    frame = spark.createDataFrame([(*v, "x", 3) for v in vectors], "vec_id bigint, embedding array<float>, cluster string, norm int")
    found = centroids.cluster(frame, k=k, dimensions=6)
    assert rows(centroids.report(found)) == plain_clusters(vectors, k, 3, 6)
    for row in found.rows.collect():
        assert row.dots == [sum(a * b for a, b in zip(row.v, c, strict=True)) for c in found.centroids]


def test_clusters_of_an_empty_table_and_of_huge_components(spark):
    kind = "vec_id bigint, embedding array<float>"
    empty = centroids.report(centroids.cluster(spark.createDataFrame([], kind)))
    assert empty.collect() == [] and empty.columns == "vec_id cluster distance cluster_inertia inertia centroid_sha256".split()
    with pytest.raises(Exception, match="too large for exact distances"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], kind))


# --- mixing --------------------------------------------------------------------------------------


def plain_targets(sizes, weights, most=3):
    """Targets by repeated sharing of the excess, in fractions."""
    from fractions import Fraction

    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    stopped = {}
    while True:
        free = [s for s in order if s not in stopped]
        left = sum(sizes.values()) - sum(stopped.values())
        target = stopped | {s: Fraction(left * weight[s], sum(weight[x] for x in free)) for s in free}
        above = [s for s in free if target[s] > most * sizes[s]]
        if not above:
            return target
        stopped |= {s: most * sizes[s] for s in above}


DOCS = [
    *((k, " ".join(["w"] * (k % 37)), "hot") for k in range(300)),
    *((k, "a b c", "tiny") for k in range(300, 302)),
    (310, "x " * 5000, "long"),
    (311, "one", "one"),
    (312, " \n\t", "none"),
    (313, None, "none"),
    (314, "no source", None),
    (315, "", None),
    (None, "no id at all", "hot"),
    (None, "no id at all", "hot"),
    (316, "empty name \x0b here\x1cstill", ""),
    (317, "\U0001f600 astral source", "\U0001f600"),
    (318, "late in code points", "￮"),
]


@pytest.mark.parametrize("block_words", [1, 7, 64, 100_000])
def test_mix_gives_targets_and_no_document_too_often(spark, block_words):
    frame = spark.createDataFrame([(*d, 9, "x") for d in DOCS], "doc_id bigint, text string, source string, size int, slot string")
    found = source_mix.mix(frame, block_words=block_words)
    docs = source_mix.taken(found).collect()
    size = lambda text: len(BLANK.findall(text or ""))
    assert Counter((r.doc_id, r.size) for r in docs) == Counter((d, size(t)) for d, t, _ in DOCS)
    sizes = Counter()
    for _, text, source in DOCS:
        sizes[source] += size(text)
    want = plain_targets(sizes, source_mix.WEIGHTS)
    source_of = {r.source_no: r.source for r in found.sources.collect()}
    target_of = {r.source: r.target for r in found.sources.collect()}
    assert target_of == {s: float(t) for s, t in want.items()}
    taken = Counter()
    for row in docs:
        assert row.taken <= 3 * row.size
    for row in found.schedule.collect():
        taken[source_of[row.source_no]] += row.n
    pieces = Counter()
    for row in found.pieces.collect():
        pieces[source_of[row.source_no]] += row.n
    assert pieces == taken and sum(r.taken for r in docs) == sum(taken.values()) == sum(sizes.values())
    assert all(abs(taken[s] - want[s]) < 1 for s in want)


def test_slots_hold_equal_blocks_and_every_stretch_holds_its_share(spark):
    frame = spark.createDataFrame([(k, "w " * 64, "ab"[k % 2]) for k in range(512)], "doc_id bigint, text string, source string")
    found = source_mix.mix(frame, weights=(3, 1), block_words=64)
    served = defaultdict(Counter)
    for row in found.schedule.collect():
        served[row.slot][row.source_no] += row.n
    assert sorted(served) == list(range(512)) and all(sum(s.values()) == 64 for s in served.values())
    for start in range(0, 512, 16):
        share = sum(served[k][0] for k in range(start, start + 16)) / (16 * 64)
        assert abs(share - 0.75) <= 1 / 16
    again = source_mix.mix(frame.repartition(7), weights=(3, 1), block_words=64)
    assert sorted(map(tuple, again.pieces.collect())) == sorted(map(tuple, found.pieces.collect()))


def test_mix_of_an_empty_table_and_of_empty_texts(spark):
    kind = "doc_id bigint, text string, source string"
    assert source_mix.taken(source_mix.mix(spark.createDataFrame([], kind))).collect() == []
    blank = source_mix.taken(source_mix.mix(spark.createDataFrame([(1, None, None), (1, None, None), (2, " ", "s")], kind)))
    assert sorted(map(tuple, blank.collect())) == [(1, 0, 0, 0.0, 0), (1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
