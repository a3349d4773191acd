"""Toxicity by the nearest labelled examples under TF-IDF cosine.

Terms are words and word beginnings that tell toxic from clean examples. The
examples' vectors over these terms are kept in an inverted index whose posting
lists are cut into blocks with the largest weight of each, so that a search skips
every block that cannot reach the best K found so far; the result is exact. The
K nearest vote with weights that fall with distance, and the vote is calibrated on
the examples themselves, each left out of its own neighbours.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import crc_fold, keep_rows, slices_by_bytes, staged
from tillroll.llm.near_duplicates import near_duplicates
from tillroll.llm.quality import labelled_sample

SAMPLE_ROWS = 16_384  # labelled rows that examples are taken from, in expectation at most
MOST_TERMS = 8_192
BEGINNINGS = (4, 5, 6)  # characters
LEAST_EXAMPLES = 4  # that hold a term
LEAST_SHARE = 0.5  # of toxic examples among them: lower end of Wilson's interval
WILSON_Z = 1.9
REST = 25.0  # squared weight that stands for a text's other words, which no two texts share
NEIGHBOURS = 15
SHOWN = 5  # neighbours given as evidence
PRIOR_WEIGHT = 0.25  # of the share of toxic texts without any term, in each vote
BLOCK = 64
THRESHOLD = 0.3
_CACHED_WORDS = 150_000

_letters = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in BEGINNINGS if len(word) > n)]


def _words(text: str | None) -> Counter[str]:
    return Counter(_letters.findall((text or "").lower()))


@dataclass
class Index:
    """Vectors of examples by term, of length one together with REST, cut into blocks of BLOCK examples."""

    doc_ids: list[int]
    toxic: np.ndarray
    idf: dict[str, float]
    term_no: dict[str, int]
    blocks: list[np.ndarray]  # per term: the blocks it stands in,
    tops: list[np.ndarray]  # the largest weight in each,
    starts: list[np.ndarray]  # where each block's postings start (and the last one ends),
    places: list[np.ndarray]  # the postings' examples
    weights: list[np.ndarray]  # and weights
    prior: float  # share of toxic examples among those without any term
    slope: float = 1.0
    shift: float = 0.0
    cache: dict = field(default_factory=dict, repr=False)

    def vector(self, words: Counter[str]) -> dict[int, float]:
        counts: Counter[int] = Counter()
        for word, n in words.items():
            found = self.cache.get(word)
            if found is None:
                if len(self.cache) >= _CACHED_WORDS:
                    self.cache.clear()
                found = tuple(self.term_no[t] for t in terms_of(word) if t in self.term_no)
                self.cache[word] = found
            for t in found:
                counts[t] += n
        names = self.names
        raw = {t: (1 + math.log(n)) * self.idf[names[t]] for t, n in sorted(counts.items())}
        norm = math.sqrt(sum(v * v for v in raw.values()) + REST)
        return {t: v / norm for t, v in raw.items()}

    @property
    def names(self) -> list[str]:
        if "\n" not in self.cache:  # no word holds a line break
            self.cache["\n"] = list(self.term_no)
        return self.cache["\n"]

    def nearest(self, vector: dict[int, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples with a term in common; ties by place."""
        n_blocks = -(-len(self.doc_ids) // BLOCK)
        bound = np.zeros(n_blocks)
        for t, v in vector.items():
            bound[self.blocks[t]] += v * self.tops[t]
        places, cosines, least = np.empty(0, np.int64), np.empty(0), 0.0
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(places) == k and bound[b] < least - 1e-12):
                break
            scores = np.zeros(BLOCK)
            for t, v in vector.items():
                j = np.searchsorted(self.blocks[t], b)
                if j < len(self.blocks[t]) and self.blocks[t][j] == b:
                    rows = slice(self.starts[t][j], self.starts[t][j + 1])
                    scores[self.places[t][rows] - b * BLOCK] += v * self.weights[t][rows]
            hit = np.flatnonzero(scores > 0)
            places = np.concatenate([places, hit + b * BLOCK])
            cosines = np.concatenate([cosines, scores[hit]])
            best = np.lexsort((places, -np.round(cosines, 12)))[:k]
            places, cosines = places[best], cosines[best]
            least = cosines[-1] if len(places) == k else 0.0
        return places, cosines

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        """Share of toxic neighbours, each weighted by its squared cosine, drawn to the prior."""
        weight = cosines**2
        return float((weight @ self.toxic[places] + PRIOR_WEIGHT * self.prior) / (weight.sum() + PRIOR_WEIGHT))

    def calibrated(self, vote: float) -> float:
        return 1 / (1 + math.exp(-(self.slope * _logit(vote) + self.shift)))


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def _platt(votes: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and shift of a logistic curve over the votes' log-odds, by damped Newton steps."""
    if not 0 < y.sum() < len(y):
        return 1.0, 0.0
    x = np.array([_logit(v) for v in votes])
    positive = y.sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (len(y) - positive + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = p * (1 - p)
        gradient = np.array([((p - target) * x).sum() + 0.1 * (a - 1), (p - target).sum() + 0.1 * b])
        hessian = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        a, b = np.array([a, b]) - 0.5 * np.linalg.solve(hessian, gradient)
    return float(max(a, 0.05)), float(b)


def _examples(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """`doc_id, y, text` of the sample, of each group of near copies one with each label.

    Copies would otherwise pass for independent evidence of every word in them. Near
    copies are the components of `near_duplicates`, so texts that only share their
    language's common words stay apart; texts without any word are copies of each other.
    """
    sample = labelled_sample(docs, labels.withColumn("clean", 1 - F.col("toxic")), "clean", rows)
    # One identifier may stand on several texts, so rows are numbered.
    sample = staged(sample.withColumn("row", F.monotonically_increasing_id()), "toxicity-sample")
    found = near_duplicates(sample, "row").select(
        F.col("doc_id").alias("row"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("copies")
    )
    one = F.min(F.struct("doc_id", "text")).alias("one")
    groups = sample.join(found, "row").groupBy("copies", (1 - F.col("y")).alias("y")).agg(one)
    return groups.select("one.doc_id", "y", "one.text")


def _term_counts(examples: DataFrame) -> DataFrame:
    """`term, n, toxic`: in how many examples, and toxic ones, a term stands."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        toxic: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            terms = list(n)
            return pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([n[t] for t in terms], pa.int64()), pa.array([toxic[t] for t in terms], pa.int64())],
                names=["term", "n", "toxic"],
            )

        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {t for w in _words(text) for t in terms_of(w)}
                n.update(found)
                if y:
                    toxic.update(found)
            if len(n) > 200_000:
                yield rows()
                n.clear()
                toxic.clear()
        yield rows()

    parts = examples.select("y", "text").mapInArrow(counted, "term string, n long, toxic long")
    return parts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Index:
    """The index over a bounded sample of labelled rows outside the held-out fold.

    What reaches the driver is at most MOST_TERMS terms and a short vector for each
    example. Without labels, or with one class only, the index is empty and every
    text gets the same score.
    """
    examples = staged(_examples(docs, labels, rows), "toxicity-examples")
    share = F.col("toxic") / F.col("n")
    z2 = WILSON_Z**2
    low = (share + z2 / (2 * F.col("n")) - WILSON_Z * F.sqrt((share * (1 - share) + z2 / (4 * F.col("n"))) / F.col("n"))) / (1 + z2 / F.col("n"))
    terms = (
        _term_counts(examples)
        .filter(F.col("n") >= LEAST_EXAMPLES)
        .withColumn("low", low)
        .filter(F.col("low") >= LEAST_SHARE)
        .orderBy(F.desc("low"), "term")
        .limit(MOST_TERMS)
        .toPandas()
        .sort_values("term")
    )
    total = max(examples.count(), 1)
    idf = {t: math.log(1 + total / n) for t, n in zip(terms["term"], terms["n"].tolist())}
    term_no = {t: i for i, t in enumerate(idf)}
    empty = Index([], np.empty(0), idf, term_no, [], [], [], [], [], 0.0)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [empty.vector(_words(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([list(v) for v in found], pa.list_(pa.int64())), pa.array([list(v.values()) for v in found], pa.list_(pa.float64()))],
                names=["doc_id", "y", "terms", "weights"],
            )

    got = examples.mapInArrow(vectors, "doc_id long, y double, terms array<long>, weights array<double>").toPandas()
    bare = got["terms"].map(len) == 0
    prior = float((got.loc[bare, "y"].sum() + 0.5) / (bare.sum() + 50))
    # Examples with the same strongest term lie side by side, which keeps the blocks' bounds tight.
    kept = got[~bare].assign(first=lambda g: [t[int(np.argmax(w))] for t, w in zip(g["terms"], g["weights"])])
    order = kept.assign(key=[(f, i, tuple(t), tuple(w)) for f, i, t, w in zip(kept["first"], kept["doc_id"], kept["terms"], kept["weights"])])
    kept = order.sort_values("key").drop(columns="key")
    index = _indexed(kept, idf, term_no, prior)
    votes = []
    for i, (t, w) in enumerate(zip(kept["terms"], kept["weights"])):
        places, cosines = index.nearest(dict(zip(t, w)), NEIGHBOURS + 1)
        others = places != i
        votes.append(index.vote(places[others][:NEIGHBOURS], cosines[others][:NEIGHBOURS]))
    y = np.concatenate([kept["y"].to_numpy(float), got.loc[bare, "y"].to_numpy(float)])
    index.slope, index.shift = _platt(np.concatenate([votes, np.full(int(bare.sum()), prior)]), y)
    index.cache.clear()
    return index


def _indexed(kept, idf: dict[str, float], term_no: dict[str, int], prior: float) -> Index:
    sizes = kept["terms"].map(len).to_numpy(dtype=np.int64)
    place = np.repeat(np.arange(len(kept)), sizes)
    term = np.concatenate([np.empty(0, np.int64), *kept["terms"]]).astype(np.int64)
    weight = np.concatenate([np.empty(0), *kept["weights"]])
    order = np.lexsort((place, term))
    cuts = np.searchsorted(term[order], np.arange(len(term_no) + 1))
    blocks, tops, starts, places, weights = [], [], [], [], []
    for a, b in zip(cuts, cuts[1:]):
        p, w = place[order[a:b]], weight[order[a:b]]
        own, first = np.unique(p // BLOCK, return_index=True)
        blocks.append(own)
        starts.append(np.append(first, len(p)))
        tops.append(np.maximum.reduceat(w, first) if len(p) else w)
        places.append(p)
        weights.append(w)
    ids = kept["doc_id"].astype("int64").tolist()
    return Index(ids, kept["y"].to_numpy(float), idf, term_no, blocks, tops, starts, places, weights, prior)


class Judge:
    """Score and evidence of one text after another; equal vectors are looked up once."""

    def __init__(self, index: Index) -> None:
        self.index = index
        self.bare = index.calibrated(index.prior), []
        self.known: dict[tuple, tuple[float, list]] = {}

    def __call__(self, text: str | None) -> tuple[float, list[tuple[int, float, int]]]:
        index = self.index
        vector = index.vector(_words(text)) if text else {}
        if not vector or not index.doc_ids:
            return self.bare
        key = tuple(vector.items())
        if key not in self.known:
            if len(self.known) > 10_000:
                self.known.clear()
            places, cosines = index.nearest(vector, NEIGHBOURS)
            shown = [(index.doc_ids[p], float(c), int(index.toxic[p])) for p, c in zip(places[:SHOWN], cosines)]
            self.known[key] = index.calibrated(index.vote(places, cosines)), shown
        return self.known[key]


def score_toxicity(docs: DataFrame, index: Index, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per input row: `doc_id, held_out, score, predicted, neighbours`.

    `neighbours` holds up to SHOWN `(doc_id, cosine, toxic)` of the nearest
    examples. A text without any term, also a null or empty one, gets the
    calibrated prior and no neighbours. Repeated rows stay repeated; the score
    depends on the text alone; a null identifier has a null `held_out`.
    """
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    near = pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(index)
        for batch in slices_by_bytes(batches, "text"):
            judged = [judge(t) for t in batch.column(1).to_pylist()]
            rows = [[dict(zip(("doc_id", "cosine", "toxic"), x)) for x in shown] for _, shown in judged]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s for s, _ in judged], pa.float64()), pa.array(rows, pa.list_(near))],
                names=["doc_id", "score", "neighbours"],
            )

    kind = frame.schema["doc_id"].dataType.simpleString()
    out = frame.mapInArrow(
        scored, f"doc_id {kind}, score double, neighbours array<struct<doc_id:bigint,cosine:double,toxic:int>>"
    )
    return out.select(
        "doc_id",
        (crc_fold(F.col("doc_id")) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "neighbours",
    )


def keep_clean(docs: DataFrame, index: Index, text: str = "text") -> DataFrame:
    """The rows that score under THRESHOLD, with all their columns."""
    judges: list[Judge] = []  # one per worker, made there

    def clean(texts: list[str | None]) -> list[bool]:
        if not judges:
            judges.append(Judge(index))
        return [judges[0](t)[0] < THRESHOLD for t in texts]

    return keep_rows(docs, clean, text)
