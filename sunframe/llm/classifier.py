"""Quality classifier: a linear-chain conditional random field over a document's lines.

Every line is good or bad; its features are its own and those of its two neighbours. Training lines
carry their document's label. A document's score is the mean forward-backward marginal of "good",
weighted by line length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunframe.llm.common import map_texts, prepare, table, text_filter, written

#: Labelled documents that the model is fitted on, at most; chosen by a hash of their id.
SAMPLE = 6000
#: Lines of one document that is learnt from, and of all together, at most: a longer document does not teach.
LONGEST, MOST_LINES = 20_000, 1_000_000
#: Score from which a document counts as good.
CUTOFF = 0.7
STEPS, RATE, RIDGE = 150, 0.1, 1e-3

_CLASSES = ("upper", "lower", "digit", "space", "symbol", "bang", "punct", "high", "other")
_CLASS = np.full(256, 8, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 7
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[list(b"#*$%&|<>")] = 4
_CLASS[list(b"!?")] = 5
_CLASS[list(b".,;:'\"()-")] = 6
#: (class, thresholds of its share of the line's bytes).
_SHARES = ((0, (0.12, 0.4, 0.7)), (2, (0.0, 0.05, 0.2)), (3, (0.08, 0.2, 0.3)), (4, (0.0, 0.01, 0.04, 0.1, 0.2)), (5, (0.0, 0.02, 0.08)), (6, (0.03, 0.06, 0.12)), (7, (0.05, 0.2)), (8, (0.0, 0.05)))
WIDTH = sum(len(t) for _, t in _SHARES) + 3 + 4 + 1 + 2


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indicator features of all lines, byte lengths of the lines, and lines a text. Null and empty texts are one empty line."""
    split = [(t or "").encode().split(b"\n") for t in texts]
    per_text = np.array([len(s) for s in split], np.int64)
    lines = [line for s in split for line in s]
    n = len(lines)
    length = np.fromiter(map(len, lines), np.int64, n)
    raw = np.frombuffer(b"".join(lines), np.uint8)
    counts = np.bincount(np.repeat(np.arange(n), length) * 9 + _CLASS[raw], minlength=9 * n).reshape(n, 9)
    words = [line.split() for line in lines]
    n_words = np.fromiter(map(len, words), np.int64, n)
    distinct = np.fromiter((len(set(w)) for w in words), np.int64, n)
    size = np.maximum(length, 1)
    mean = (length - counts[:, 3]) / np.maximum(n_words, 1)
    fresh = np.array([first for s in split for first in _first_seen(s)], bool)
    columns = [counts[:, c] > t * size for c, ts in _SHARES for t in ts]
    columns += [n_words == 0, n_words < 4, n_words > 40]
    columns += [mean < 3, mean > 6, mean > 8, mean > 12]
    columns += [~fresh]
    columns += [distinct < 0.5 * n_words, distinct < 0.8 * n_words]
    return np.stack(columns, axis=1).astype(np.uint8), length, per_text


def _first_seen(lines: list[bytes]) -> list[bool]:
    seen: set[bytes] = set()
    out = []
    for line in lines:
        out.append(line not in seen or not line)
        seen.add(line)
    return out


def design(own: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Own features, those of the lines before and after in the same text, and whether there are such lines."""
    n = len(own)
    ends = np.cumsum(per_text)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[ends - per_text], last[ends - 1] = True, True
    before, after = np.roll(own, 1, axis=0) * ~first[:, None], np.roll(own, -1, axis=0) * ~last[:, None]
    return np.concatenate([np.ones((n, 1)), own, before, after, first[:, None], last[:, None]], axis=1, dtype=np.float32)


class Chains:
    """Lines of many texts, stepped through side by side."""

    def __init__(self, per_text: np.ndarray) -> None:
        self.per_text = per_text
        self.order = np.argsort(-per_text, kind="stable")
        self.starts = (np.cumsum(per_text) - per_text)[self.order]
        sizes = per_text[self.order]
        longest = int(sizes[0]) if len(sizes) else 0
        #: Texts with more than t lines.
        self.active = [int(a) for a in np.searchsorted(-sizes, -np.arange(longest), "left")]

    def forward_backward(self, unary: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of good by the lines up to each, and by the lines after it. ``t[i, j]``: weight of i followed by j, 1 is good."""
        a, b = np.array(unary, np.float64), np.zeros(len(unary))
        for k in range(1, len(self.active)):
            at = self.starts[: self.active[k]] + k
            x = a[at - 1]
            a[at] += np.logaddexp(x + t[1, 1], t[0, 1]) - np.logaddexp(x + t[1, 0], t[0, 0])
        for k in range(len(self.active) - 1, 0, -1):
            at = self.starts[: self.active[k]] + k
            x = unary[at] + b[at]
            b[at - 1] = np.logaddexp(x + t[1, 1], t[1, 0]) - np.logaddexp(x + t[0, 1], t[0, 0])
        return a, b


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class LineCRF:
    """Weights of a line's features and of the four transitions."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray) -> None:
        self.weights, self.transitions = weights, transitions

    @classmethod
    def fit(cls, own: np.ndarray, per_text: np.ndarray, label: np.ndarray, steps: int = STEPS) -> LineCRF:
        """Maximum likelihood with a ridge by Adam; the same rows give the same model."""
        x, chains = design(own, per_text), Chains(per_text)
        y = np.repeat(label, per_text).astype(np.float64)
        follows = np.ones(len(y), bool)
        follows[np.cumsum(per_text) - per_text] = False
        to = np.flatnonzero(follows)
        observed = np.zeros((2, 2))
        np.add.at(observed, (y[to - 1].astype(int), y[to].astype(int)), 1)
        theta = np.zeros(x.shape[1] + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            w, t = theta[:-4], theta[-4:].reshape(2, 2)
            unary = x @ w
            a, b = chains.forward_backward(unary, t)
            pair = np.zeros((2, 2, len(to)))
            for i in (0, 1):
                for j in (0, 1):
                    pair[i, j] = i * a[to - 1] + t[i, j] + j * (unary[to] + b[to])
            pair = np.exp(pair - pair.max(axis=(0, 1)))
            expected = (pair / pair.sum(axis=(0, 1))).sum(axis=2)
            grad = np.concatenate([x.T @ (y - _sigmoid(a + b)), (observed - expected).ravel()]) / len(y) - RIDGE * theta
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return cls(theta[:-4], theta[-4:].reshape(2, 2))

    def marginals(self, own: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """Chance that each line is good."""
        unary = (design(own, per_text) @ self.weights).astype(np.float64)
        return _sigmoid(sum(Chains(per_text).forward_backward(unary, self.transitions)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Quality of each text, 0 to 1."""
        if not texts:
            return np.zeros(0)
        own, length, per_text = line_features(texts)
        weight = np.maximum(length, 1).astype(np.float64)
        starts = np.cumsum(per_text) - per_text
        return np.add.reduceat(self.marginals(own, per_text) * weight, starts) / np.add.reduceat(weight, starts)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; a null id has no label."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LineCRF:
    """Fit on at most ``sample`` labelled documents that are not held out, chosen by a hash of their id.

    Conflicting labels of a document count as the lowest; rows that repeat a document teach once, and those
    over ``LONGEST`` lines do not. Documents beyond ``MOST_LINES`` together are left out, in the order of
    the hash. Only the sample's line features, a few bytes
    a line, reach the driver. Without labels every score is one half.
    """
    spark = prepare(docs.sparkSession)
    marks = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min("quality").alias("quality"))
    chosen = marks.filter(~held_out(F.col("label_id"))).orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    rows = [(r["label_id"], int(r["quality"])) for r in chosen.collect()]
    quality = dict(rows)
    ids = spark.createDataFrame(rows, "label_id long, quality int")
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    texts = texts.join(F.broadcast(ids), texts["doc_id"] == ids["label_id"], "left_semi")

    def make():
        def work(batch):
            own, _, per_text = line_features(batch)
            cuts = np.cumsum(per_text)
            return [pa.array([own[e - n : e].tobytes() if n <= LONGEST else None for e, n in zip(cuts, per_text, strict=True)], pa.binary()), pa.array(per_text, pa.int64())]

        return work

    made = map_texts(texts, make, "features binary, n long").filter("features is not null").withColumn("h", F.xxhash64("doc_id", "features"))
    made = written(made.dropDuplicates(["doc_id", "h"]), "classifier-lines")
    # A window over at most ``sample`` rows.
    few = made.select("doc_id", "h", "n").orderBy("h", "doc_id").limit(sample)
    few = few.withColumn("lines", F.sum("n").over(Window.orderBy("h", "doc_id"))).filter(F.col("lines") <= MOST_LINES)
    few = F.broadcast(few.select(F.col("doc_id").alias("i"), F.col("h").alias("g")))
    found = made.join(few, (made["doc_id"] == few["i"]) & (made["h"] == few["g"]), "left_semi").orderBy("h", "doc_id").select("doc_id", "features").collect()
    if not found:
        return LineCRF(np.zeros(3 * WIDTH + 3), np.zeros((2, 2)))
    own = [np.frombuffer(r["features"], np.uint8).reshape(-1, WIDTH) for r in found]
    label = np.array([quality[r["doc_id"]] for r in found])
    return LineCRF.fit(np.concatenate(own), np.array([len(o) for o in own]), label)


def quality_scores(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text.

    Only a text's lines enter its score, all of them, however long the text. Null and empty texts are one
    empty line. Each row stands for itself, also with null or repeated ids; repeated rows each stay. Other
    columns do not matter. An empty table gives no rows; without labels every score is one half.
    """
    model = train(docs, labels)

    def make():
        return lambda texts: [pa.array(model.score(texts), pa.float64())]

    scored = map_texts(docs, make, "score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Stage: the rows of ``docs`` that score at least ``cutoff``, all columns.

    Null and empty texts are scored as one empty line, long ones whole. Rows with null or repeated ids are
    judged by their text alone; repeated rows go or stay together. Columns of any name pass through. An
    empty table gives no rows; without labels every score is one half, and the default cutoff keeps none.
    """
    model = train(docs, labels)
    return text_filter(docs, lambda: lambda texts: (model.score(texts) >= cutoff).tolist())


def op10_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
