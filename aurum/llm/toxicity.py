"""Toxicity by weak supervision.

1. A bounded sample of labelled documents (``fit_rows``, by hash of the id) gives a lexicon: words
   that are far more frequent in documents marked toxic, and beginnings of words (an inflected insult shares
   its stem, not its ending), marked by a star.
2. Voters: one for each of the strongest lexicon words, and patterns (second-person insults, runs of
   exclamation marks, capitals, masked words, density of lexicon words, and some that vote clean).
3. A generative label model over the votes: a latent class for each document, an accuracy for each
   voter, and correlations as a tree of voter pairs (the maximum spanning tree of their mutual
   information given the class), fitted by expectation-maximisation.  The given label is one more,
   fallible voter.
4. A linear classifier over lexicon words and patterns is trained on the posterior labels and scores
   every whole text of all documents in one pass, without a shuffle.

Labels, language, source and doc_id are never inputs of a score; labels are read only from rows whose
``crc32(doc_id) mod 4`` is not 2.

Defined cases: a null text is scored as the empty text; repeated rows get equal scores; a null doc_id
has no label and ``held_out`` false; several labels of a document count as their rounded mean, a null
label as none; without any usable label of both classes every score is 0; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import chunked, texts

FIT_ROWS = 20_000
LEXICON = 400
MIN_SUPPORT = 4
MIN_RATIO = 30
STEMS = (4, 5, 6, 7, 8)
WORD_VOTERS = 32
THRESHOLD = 0.3
EM_ROUNDS = 15

_WORD = re.compile(r"\w+")
_SECOND_PERSON = re.compile(r"\b(?:you|you're|your|ur|u)\s+(?:are\s+)?(?:such\s+)?(?:an?\s+)?\w+", re.I)
_SHOUT = re.compile(r"!{3,}")
_MASKED = re.compile(r"\w[*@#$]{2,}\w?")
_CAPITALS = re.compile(r"\b[A-Z]{4,}\b")
_ELONGATED = re.compile(r"(\w)\1{3,}")
PATTERNS = ("any", "several", "dense", "very_dense", "second_person", "shout", "masked", "capitals", "elongated",
            "no_lexicon", "long_without", "short_without")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows whose labels are never read."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Text and label of at most ``fit_rows`` labelled rows; of equal texts one."""
    chosen = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.round(F.avg("toxic")).cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # fit_rows bounds its size
            .groupBy(F.xxhash64("text").alias("h")).agg(F.min_by(F.struct("text", "toxic"), "doc_id").alias("x"))
            .select("x.text", "x.toxic"))


def terms(words: list[str]) -> set[str]:
    """The words and their beginnings; a beginning is shorter than its word."""
    own = set(words)
    return own.union(*({w[:n] + "*" for w in own if len(w) > n} for n in STEMS))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    n = [0, 0]
    for batch in chunked(batches, "text"):
        for text, toxic in zip(texts(batch["text"]), batch["toxic"].to_pylist(), strict=True):
            n[toxic > 0] += 1
            seen[toxic > 0].update(terms(_WORD.findall(text.lower())))
    words = list(seen[0] | seen[1])
    yield pa.RecordBatch.from_pydict({"word": ["", *words], "clean": pa.array([n[0], *(seen[0][w] for w in words)], pa.int64()),
                                      "toxic": pa.array([n[1], *(seen[1][w] for w in words)], pa.int64())})


def mine_lexicon(sample: DataFrame, size: int = LEXICON, min_support: int = MIN_SUPPORT) -> list[str]:
    """The words with the highest log-odds of a toxic document, strongest evidence first."""
    counts = sample.mapInArrow(_counted, "word string, clean long, toxic long").groupBy("word").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    total = counts.where("word = ''").first()
    if not total or not total["clean"] or not total["toxic"]:
        return []
    rate_toxic, rate_clean = F.col("toxic") / F.lit(total["toxic"]), (F.col("clean") + 0.5) / F.lit(total["clean"])
    gain = F.col("toxic") * F.log(rate_toxic / rate_clean)
    rows = (counts.where((F.col("word") != "") & (F.col("toxic") >= F.lit(max(min_support, total["toxic"] / 200)))
                    & (rate_toxic > MIN_RATIO * rate_clean))
            .orderBy(gain.desc(), "word").limit(4 * size).collect())
    longest: dict[tuple, str] = {}  # of beginnings with the same documents, the longest says it all
    for r in rows:
        key = (r["toxic"], r["clean"], r["word"][:STEMS[0]])
        if key not in longest or len(r["word"].rstrip("*")) > len(longest[key].rstrip("*")) or r["word"] + "*" == longest[key]:
            longest[key] = r["word"]
    return list(longest.values())[:size]


def describe(text: str, place: dict[str, int], strong: int) -> tuple[list[int], list[bool]]:
    """Lexicon words present, and which patterns fire.  Only the ``strong`` first words make an insult."""
    words = _WORD.findall(text.lower())
    present = terms(words).intersection(place)
    found = sorted(map(place.__getitem__, present))
    insults = {w for w in present if place[w] < strong}
    hits = sum(not insults.isdisjoint(terms([w])) for w in words) if insults else 0
    density = hits / max(1, len(words))
    second = bool(hits) and any(not insults.isdisjoint(terms([m.group().split()[-1].lower()])) for m in _SECOND_PERSON.finditer(text))
    return found, [hits > 0, hits > 1, density > 0.005, density > 0.02, second, bool(_SHOUT.search(text)),
                   bool(_MASKED.search(text)), len(_CAPITALS.findall(text)) > 0.2 * len(words) > 0,
                   bool(_ELONGATED.search(text)), not found, not found and len(words) >= 100, not found and len(words) < 100]


@dataclass
class LabelModel:
    """Latent class and a tree of votes.  ``table[j][y, parent's vote]`` is the chance that voter j fires."""

    prior: float
    parent: list[int]
    table: np.ndarray
    label_accuracy: tuple[float, float]
    correlations: dict[tuple[int, int], float]

    @classmethod
    def fit(cls, votes: np.ndarray, labels: np.ndarray, rounds: int = EM_ROUNDS) -> LabelModel:
        """``votes``: rows by voters, 0/1; ``labels``: 0/1 as given."""
        rows, back, counts = np.unique(np.column_stack((votes, labels)), axis=0, return_inverse=True, return_counts=True)
        v, given, c = rows[:, :-1].astype(float), rows[:, -1], counts.astype(float)
        n = v.shape[1]
        post = np.where(given == 1, 0.95, 0.05)
        parent, pairs = cls._tree(v, post, c)
        model = None
        for _ in range(rounds):
            table = np.empty((n, 2, 2))
            for j in range(n):
                before = v[:, parent[j]] if parent[j] >= 0 else np.zeros(len(v))
                for y, w in ((0, c * (1 - post)), (1, c * post)):
                    for u in (0, 1):
                        own = w * (before == u)
                        table[j, y, u] = (own @ v[:, j] + 0.5) / (own.sum() + 1)
            hit = [np.clip((c * q * (given == y)).sum() / max(1e-9, (c * q).sum()), 0.85, 0.99) for y, q in ((0, 1 - post), (1, post))]
            model = cls(float((c @ post + 1) / (c.sum() + 2)), parent, table, (hit[0], hit[1]), pairs)
            post = model.posterior(v, given)
        return model

    @staticmethod
    def _tree(v: np.ndarray, post: np.ndarray, c: np.ndarray) -> tuple[list[int], dict[tuple[int, int], float]]:
        n, info, phi = v.shape[1], np.zeros((v.shape[1],) * 2), np.zeros((v.shape[1],) * 2)
        for w in (c * post, c * (1 - post)):
            w = w / max(1e-9, c.sum())
            both, one, total = (v * w[:, None]).T @ v, w @ v, w.sum() + 1e-12
            for a, sa in ((one, 1), (total - one, 0)):
                for b, sb in ((one, 1), (total - one, 0)):
                    joint = both if sa and sb else (one[:, None] - both if sa else (one[None, :] - both if sb else total - one[:, None] - one[None, :] + both))
                    joint = np.maximum(joint, 1e-12)
                    info += joint * np.log(joint * total / np.maximum(a[:, None] * b[None, :], 1e-24))
            spread = np.sqrt(np.maximum(one * (total - one), 1e-12))
            phi += (both * total - one[:, None] * one[None, :]) / (spread[:, None] * spread[None, :]) * total
        parent, left, best = [-1] * n, set(range(1, n)), {j: (info[0, j], 0) for j in range(1, n)}
        pairs = {}
        while left:
            j = max(left, key=lambda k: (best[k][0], -k))
            left.remove(j)
            if best[j][0] > 1e-4:  # weaker pairs count as independent
                parent[j] = best[j][1]
                pairs[best[j][1], j] = float(phi[best[j][1], j])
            for k in left:
                if info[j, k] > best[k][0]:
                    best[k] = (info[j, k], j)
        return parent, pairs

    def posterior(self, votes: np.ndarray, given: np.ndarray | None = None) -> np.ndarray:
        logs = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for j, p in enumerate(self.parent):
            u = votes[:, p].astype(int) if p >= 0 else np.zeros(len(votes), int)
            for y in (0, 1):
                q = self.table[j, y, u]
                logs[:, y] += np.log(np.where(votes[:, j] > 0, q, 1 - q))
        if given is not None:
            for y in (0, 1):
                a = self.label_accuracy[y]
                logs[:, y] += np.log(np.where(given == y, a, 1 - a))
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))

    def accuracies(self, votes: np.ndarray) -> np.ndarray:
        """For each voter, the mean posterior of the documents in which it fires."""
        post = self.posterior(votes)
        return (votes * post[:, None]).sum(0) / np.maximum(1, votes.sum(0))


def train_linear(x: np.ndarray, target: np.ndarray, penalty: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the intercept."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, x.T @ (target - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class ToxicityModel:
    """What the scoring pass needs: at most ``LEXICON`` words and as many weights."""

    lexicon: list[str]
    weights: np.ndarray
    label_model: LabelModel | None = None

    def score(self, found: list[int], fired: list[bool]) -> float:
        if not self.lexicon:
            return 0.0
        n = len(self.lexicon)
        z = self.weights[found].sum() + self.weights[n:-1][fired].sum() + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def fit(docs: DataFrame, labels: DataFrame, *, fit_rows: int = FIT_ROWS, lexicon: int = LEXICON) -> ToxicityModel:
    sample = labelled_sample(docs, labels, fit_rows)
    words = mine_lexicon(sample, lexicon)
    if not words:
        return ToxicityModel([], np.zeros(1))
    place, strong = {w: k for k, w in enumerate(words)}, min(WORD_VOTERS, len(words))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, "text"):
            found, fired = zip(*(describe(x, place, strong) for x in texts(batch["text"])), strict=True)
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(found, pa.list_(pa.int32())), pa.array(fired, pa.list_(pa.bool_()))],
                                             names=["toxic", "found", "fired"])

    rows = sample.mapInArrow(described, "toxic int, found array<int>, fired array<boolean>").toArrow()  # at most fit_rows rows
    given = np.array(rows["toxic"].to_pylist())
    present = np.zeros((len(given), len(words)))
    for k, found in enumerate(rows["found"].to_pylist()):
        present[k, found] = 1
    fired = np.array(rows["fired"].to_pylist(), float)
    votes = np.column_stack((present[:, :strong], fired))
    model = LabelModel.fit(votes, given)
    target = model.posterior(votes, given)
    return ToxicityModel(words, train_linear(np.column_stack((present, fired)), target), model)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    place, strong = {w: k for k, w in enumerate(model.lexicon)}, min(WORD_VOTERS, len(model.lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, "text"):
            scores = [model.score(*describe(x, place, strong)) for x in texts(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")))


def reject_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, that the classifier doesn't reject."""
    names, place, strong = docs.columns, {w: k for k, w in enumerate(model.lexicon)}, min(WORD_VOTERS, len(model.lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, "text"):
            kept = [model.score(*describe(x, place, strong)) < threshold for x in texts(batch.column(names.index("text")))]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
