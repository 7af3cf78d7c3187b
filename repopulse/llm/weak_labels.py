"""Quality classifier from weak labels.

Several heuristic labellers vote good, bad or nothing on every text. All votes are built-in
expressions, so one scan turns the corpus into counts of vote patterns: at most 3 to the number of
labellers, however many texts there are. Expectation-maximisation over these counts estimates how
often each labeller is right on good and on bad texts, without any given label, and the posterior of
each pattern is a soft label of its texts.

A linear scorer over hashed word features is then fitted to the soft labels of a sample of bounded
size (see fit) and scores every text. All counts and scores cover all texts.

Null and blank texts have no words: no labeller votes and the scorer sees the
size alone. Copies are scored alike. Columns other than the id and
the text are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.arrow_rows import pieces
from repopulse.llm.columns import split_words
from repopulse.llm.quality_rules import measure
from repopulse.session import settle

GOOD, BAD, NONE = 1, -1, 0


@dataclass(frozen=True)
class Labeller:
    """Votes by two bounds on a measure; ``needs`` words or it does not vote."""

    name: str
    measure: str
    bad_from: float | None = None
    good_to: float | None = None
    good_from: float | None = None
    bad_to: float | None = None
    needs: int = 1

    def vote(self) -> Column:
        value, vote = F.col(self.measure), F.lit(NONE)
        if self.good_to is not None:
            vote = F.when(value <= self.good_to, GOOD).otherwise(vote)
        if self.good_from is not None:
            vote = F.when(value >= self.good_from, GOOD).otherwise(vote)
        if self.bad_from is not None:
            vote = F.when(value >= self.bad_from, BAD).otherwise(vote)
        if self.bad_to is not None:
            vote = F.when(value <= self.bad_to, BAD).otherwise(vote)
        return F.when(F.col("n_words") >= self.needs, vote).otherwise(NONE).cast("int").alias(self.name)


LABELLERS = (
    Labeller("word_length", "mean_word_chars", good_from=4.4, bad_to=3.4, needs=20),
    Labeller("long_words", "mean_word_chars", good_to=6.2, bad_from=7.0, needs=20),
    Labeller("symbols", "symbol_ratio", good_to=0.01, bad_from=0.1, needs=5),
    Labeller("stop_words", "stop_word_ratio", good_from=0.1, bad_to=0.05, needs=30),
    Labeller("repeated_words", "repeat_ratio", good_to=0.02, bad_from=0.2, needs=5),
    Labeller("variety", "distinct_ratio", good_from=0.3, bad_to=0.25, needs=12),
    Labeller("repeated_lines", "dup_line_ratio", good_to=0.34, bad_from=0.5, needs=5),
    Labeller("shouting", "upper_ratio", good_to=0.05, bad_from=0.4, needs=5),
)


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and for each labeller the probability that its vote is good, on bad and on good texts.

    Not to vote says nothing about a text.
    """

    good: float
    votes: np.ndarray

    def log_joint(self, patterns: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of being bad, and good, together with the votes; one row per pattern."""
        out = []
        for c, share in ((0, 1 - self.good), (1, self.good)):
            right = np.where(patterns == GOOD, np.log(self.votes[:, c]), np.log1p(-self.votes[:, c]))
            out.append(np.log(share) + np.where(patterns == NONE, 0.0, right).sum(axis=1))
        return np.stack(out, axis=1)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes."""
        bad, good = self.log_joint(patterns).T
        return 1 / (1 + np.exp(np.clip(bad - good, -500, 500)))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, most_rounds: int = 500, tolerance: float = 1e-9) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns and how often each occurs.

    It starts from the majority of votes, so "good" keeps its meaning, and adds one imagined text per
    vote, so no probability is 0. It ends when the likelihood no longer rises.
    """
    weights = counts / counts.sum()
    belief = np.clip(0.5 + patterns.sum(axis=1) / (2 * np.maximum(1, np.abs(patterns).sum(axis=1))), 0.05, 0.95)
    before = -np.inf
    for _ in range(most_rounds):
        good = float(np.clip(weights @ belief, 1e-6, 1 - 1e-6))
        votes = np.empty((patterns.shape[1], 2))
        for c, share in ((0, 1 - belief), (1, belief)):
            held = (counts * share)[:, None]
            for_good = (held * (patterns == GOOD)).sum(axis=0) + 1.0
            votes[:, c] = for_good / (for_good + (held * (patterns == BAD)).sum(axis=0) + 1.0)
        model = LabelModel(good, votes)
        belief = model.posterior(patterns)
        likelihood = float(weights @ np.logaddexp(*model.log_joint(patterns).T))
        if likelihood - before < tolerance:
            break
        before = likelihood
    return model


def cast_votes(docs: DataFrame, labellers: tuple[Labeller, ...] = LABELLERS) -> DataFrame:
    """(doc_id, text, votes): the labellers' votes in order."""
    plain = docs.select("doc_id", "text")
    letters = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\p{L}]", ""))
    upper = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\p{Lu}]", ""))
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)
    measured = measure(plain).withColumns(
        {
            "repeat_ratio": share(F.col("n_repeat_words"), F.col("n_words")),
            "distinct_ratio": share(F.size(F.array_distinct(split_words(F.col("text")))), F.col("n_words")),
            "upper_ratio": share(upper, letters),
        }
    )
    return measured.select("doc_id", "text", F.array(*(x.vote() for x in labellers)).alias("votes"))


#: Hashed features of the scorer.
BITS = 18


def features(text: str | None) -> np.ndarray:
    """Distinct hashed features: words, their shapes and ends, neighbours that are equal, and the text's size."""
    words = (text or "").split()
    found = set(words)
    shapes = {
        ("U" if w.isupper() else "l" if w.islower() else "T" if w.istitle() else "x") + ("" if w.isalpha() else w.lstrip("".join(set(w) & _LETTERS))[-3:])
        for w in found
    }
    named = [f"w {w}" for w in found] + [f"s {s}" for s in shapes]
    if words:
        equal = sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words)
        named.append(f"equal {min(9, int(equal * 20))}")
        named.append(f"kinds {int(10 * len(found) / len(words))}")
    named.append(f"size {len(words).bit_length()}")
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, named), np.uint64, len(named))
    return np.unique(hashed >> np.uint64(64 - BITS)).astype(np.int64)


_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        at = features(text)
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[at].sum() / np.sqrt(len(at)), -30, 30))))


def fit_scorer(texts: list[str | None], soft: np.ndarray, rounds: int = 8, rate: float = 0.5, decay: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels by adaptive gradient steps, in a fixed order."""
    rows = [features(t) for t in texts]
    weights, seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-8)
    bias, bias_seen = 0.0, 1e-8
    order = np.arange(len(rows))
    random = np.random.default_rng(7)
    for _ in range(rounds):
        random.shuffle(order)
        for i in order:
            at = rows[i]
            scale = 1 / np.sqrt(len(at))
            error = 1 / (1 + np.exp(-np.clip(bias + weights[at].sum() * scale, -30, 30))) - soft[i]
            step = error * scale + decay * weights[at]
            seen[at] += step * step
            weights[at] -= rate * step / np.sqrt(seen[at])
            bias_seen += error * error
            bias -= rate * error / np.sqrt(bias_seen)
    return Scorer(weights.astype(np.float32), bias)


def fit(
    docs: DataFrame, train_rows: int = 4000, train_chars: int = 20_000, labellers: tuple[Labeller, ...] = LABELLERS
) -> tuple[LabelModel | None, Scorer | None]:
    """The label model of all texts of (doc_id, text), and the scorer fitted to a sample; None for an empty table.

    ``train_rows`` texts of up to ``train_chars`` characters bound the sample; half of it are texts that
    the label model believes good, half bad, as far as there are so many different ones.
    """
    spark = docs.sparkSession
    voted = settle(cast_votes(docs, labellers).select(F.xxhash64("text").alias("key"), F.length("text").alias("size"), "votes"))
    rows = voted.groupBy("votes").agg(F.count("*").alias("n")).collect()  # at most 3 ** len(labellers)
    if not rows:
        return None, None
    patterns = np.array([r["votes"] for r in rows])
    model = fit_labels(patterns, np.array([float(r["n"]) for r in rows]))
    belief = zip(patterns.tolist(), model.posterior(patterns).tolist(), strict=True)
    table = spark.createDataFrame(list(belief), "votes array<int>, posterior double")

    drawn = (
        voted.where(F.coalesce("size", F.lit(0)) <= train_chars)
        .groupBy("key")
        .agg(F.min("votes").alias("votes"))
        .join(F.broadcast(table), "votes")  # a row per pattern
        .withColumn("place", F.xxhash64(F.lit("sample"), "key"))
    )
    halves = [
        drawn.where(side).orderBy("place", "key").limit(train_rows // 2).select("key", "posterior")
        for side in ("posterior >= 0.5", "posterior < 0.5")
    ]
    picked = settle(halves[0].unionByName(halves[1]))
    sample = (
        docs.select("text", F.xxhash64("text").alias("key"))
        .join(F.broadcast(picked), "key")  # at most train_rows rows
        .groupBy("key")
        .agg(F.min("text").alias("text"), F.min("posterior").alias("posterior"))
        .orderBy("key")
        .collect()
    )
    return model, fit_scorer([r["text"] for r in sample], np.array([r["posterior"] for r in sample]))


def classify(docs: DataFrame, keep_from: float = 0.5, **fitting) -> DataFrame:
    """(doc_id, score, keep) of every text: the scorer's probability of good, and whether it reaches ``keep_from``."""
    plain = docs.select("doc_id", "text")
    _, scorer = fit(plain, **fitting)
    shared = plain.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            scores = [shared.value.score(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array([s >= keep_from for s in scores], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "keep"])

    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, score double, keep boolean")
