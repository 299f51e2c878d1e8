"""Quality rules with risk-controlled thresholds.

Half of the labelled documents propose nested cutoffs (quantiles of each feature among good
documents of a stratum); the other half is a holdout. For every stratum and every proposal an exact
binomial test on the holdout bounds the share of good documents that the rule would reject;
Bonferroni's correction covers all strata and proposals. Of the proposals that pass, the one that
gains most on the first half is used; a stratum in which none passes has no method rule.

Labels are used through bounded histograms only, counted over all labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunframe.llm.common import begin, fresh, prepare, small, table, text_column, written

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Good documents that the method may reject, as a share of a stratum's, and the chance to be wrong on any.
ALPHA, DELTA = 0.05, 0.05
#: Quantiles of good documents that propose cutoffs; over 1 stands for cutoffs above every good document.
QUANTILES = (0.95, 0.98, 0.99, 0.995, 0.999, 1.0)
LEVELS = 256
FEATURES = ("symbols", "capitals", "bangs", "digits", "dup_lines", "repeats")
_SPACES, _SYMBOLS = SPACES.encode(), SYMBOLS.encode()
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more in the text."""
    n = len(words)
    if n <= window:
        return 0
    mixed = np.fromiter(map(hash, words), np.int64, n).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(n - window + 1, np.uint64)
    for k in range(window):
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + mixed[k : n - window + 1 + k]
    rolled.sort()
    if not (rolled[1:] == rolled[:-1]).any():  # equal windows always have equal hashes
        return 0
    known: dict[bytes, int] = {}
    code = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    step = 1
    while step < window:  # exact codes of windows of 2, 4, 8 words
        code = np.unique(code[:-step] * (int(code.max()) + 1) + code[step:], return_inverse=True)[1]
        step *= 2
    twice = np.flatnonzero(np.bincount(code)[code] >= 2)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def measure(text: str | None) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """The base statistics and the level (0 to 255, higher is worse) of each feature; null counts as empty."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n, word_chars = len(words), len(text) - len(raw) + len(raw.translate(None, _SPACES))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeats = repeated_words(words)
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    upper = len(raw) - len(raw.translate(None, _UPPER))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    shares = (symbols / (4 * n) if n else 0, upper / letters if letters else 0, raw.count(b"!") / (4 * n) if n else 0, digits / len(raw) if raw else 0, dup / lines if lines else 0, repeats / n if n else 0)
    return (n, word_chars, symbols, dup, repeats), tuple(min(LEVELS - 1, math.ceil(s * (LEVELS - 1))) for s in shares)


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words


def stratum(lang: Column) -> Column:
    """A language code of two or three letters, else ``other``: so there are under 20,000 strata."""
    code = F.lower(F.trim(lang.cast("string")))
    return F.when(code.rlike("^[a-z]{2,3}$"), code).otherwise("other")


def _lang(docs: DataFrame) -> Column:
    return docs["lang"] if "lang" in docs.columns else F.lit(None).cast("string")


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, stratum``, the base statistics and ``levels`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        for batch in batches:
            got = [measure(t) for t in batch.column(2).to_pylist()]
            stats = [pa.array([g[0][i] for g in got], pa.int64()) for i in range(len(_STATS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *stats, pa.array([g[1] for g in got], pa.list_(pa.int32()))], ["doc_id", "stratum", *_STATS, "levels"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), stratum(_lang(docs)).alias("stratum"), text_column(docs).alias("text"))
    return rows.mapInArrow(run, "doc_id long, stratum string, " + ", ".join(f"{s} long" for s in _STATS) + ", levels array<int>")


def _base_failed(n_words: str = "n_words", repeats: str = "n_repeat_words") -> Column:
    return (F.col(n_words) < LEAST_WORDS) | (F.col(repeats) * 100 > F.col(n_words) * MOST_REPEATED_PERCENT)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of n draws with chance p, exact: the regularised incomplete beta function at 1 - p."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1, 1 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Lentz's continued fraction of the incomplete beta function."""
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d or 1e-300)
    h = d
    for m in range(1, 100_000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + top * d) or 1e-300)
            c = (1 + top / c) or 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return h


def _marks(labels: DataFrame) -> DataFrame:
    """Label of each document, the lowest if there are several."""
    known = labels.filter("doc_id is not null and quality is not null")
    return known.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min("quality").alias("quality"))


def proposals(good: DataFrame) -> DataFrame:
    """``s, cuts``: for each stratum and quantile the level from which each feature rejects; ``good`` has ``stratum, levels``."""
    counts = good.select("stratum", F.posexplode("levels").alias("feature", "level")).groupBy("stratum", "feature", "level").count()
    feature = Window.partitionBy("stratum", "feature")
    reach = counts.select("stratum", "feature", "level", F.sum("count").over(feature.orderBy("level")).alias("up_to"), F.sum("count").over(feature).alias("all"))
    cuts = [(F.min(F.when(F.col("up_to") >= F.col("all") * q - 1e-9, F.col("level"))) + 1).cast("int") for q in QUANTILES]
    by_feature = reach.groupBy("stratum", "feature").agg(F.array(*cuts).alias("cuts"))
    rows = by_feature.groupBy(F.col("stratum").alias("s")).agg(F.sort_array(F.collect_list(F.struct("feature", "cuts"))).alias("f"))
    # ``f.cuts`` is by feature, then quantile.
    cut = [F.array(*[F.col("f")[f]["cuts"][q] for f in range(len(FEATURES))]) for q in range(len(QUANTILES))]
    return rows.select("s", F.array(*cut).alias("cuts"))


def calibrate(stats: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> dict[str, list[int]]:
    """Cutoffs by stratum: a document is rejected if a feature's level is at least its cutoff.

    Repeated labels of a document count once (the lowest); null labels and documents that fail the base
    rules do not count. One row a stratum reaches the driver. Without labelled rows there are no cutoffs.
    """
    marks = _marks(labels)
    known = stats.filter(~_base_failed()).join(marks, stats["doc_id"] == marks["label_id"])
    known = known.select("stratum", "levels", "quality", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"))
    known = written(known, "rules-labelled")
    frame = written(proposals(known.filter("half = 0 and quality = 1")), "rules-proposals")  # a row a stratum
    # Proposals are nested: a document is rejected by the first so many of them.
    rejects = F.size(F.filter("cuts", lambda c: F.exists(F.zip_with("levels", c, lambda x, y: x >= y), lambda b: b)))
    tried = known.join(F.broadcast(frame), known["stratum"] == frame["s"]).select("stratum", "cuts", "half", "quality", rejects.alias("rejects"))

    def rejected(half: int, quality: int) -> Column:
        """Documents that each proposal rejects."""
        chosen = (F.col("half") == half) & (F.col("quality") == quality)
        return F.array(*[F.count(F.when(chosen & (F.col("rejects") > i), 1)) for i in range(len(QUANTILES))])

    held = F.count(F.when((F.col("half") == 1) & (F.col("quality") == 1), 1))
    rows = tried.groupBy("stratum").agg(F.first("cuts").alias("cuts"), held.alias("held"), rejected(1, 1).alias("wrong"), rejected(0, 0).alias("bad"), rejected(0, 1).alias("good")).collect()
    tests = max(1, len(rows) * len(QUANTILES))
    chosen: dict[str, list[int]] = {}
    for r in rows:
        best = 0
        for cuts, wrong, bad, good in zip(r["cuts"], r["wrong"], r["bad"], r["good"], strict=True):
            if r["held"] and bad - good > best and binomial_tail(wrong, r["held"], alpha) <= delta / tests:
                best, chosen[r["stratum"]] = bad - good, list(cuts)
    return chosen


def judged(stats: DataFrame, cutoffs: dict[str, list[int]]) -> DataFrame:
    """``stats`` with ``base_failed`` and ``kept``."""
    frame = stats.sparkSession.createDataFrame([(s, c) for s, c in cutoffs.items()], "s string, cutoff array<int>")
    bad = F.exists(F.zip_with("levels", "cutoff", lambda x, y: x >= y), lambda b: b)
    joined = stats.join(F.broadcast(frame), stats["stratum"] == frame["s"], "left").withColumn("base_failed", _base_failed())
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(bad, F.lit(False)))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a document: base statistics, ``base_failed``, ``kept``.

    Null and empty texts have no words and fail; long texts are measured whole. Each row stands for
    itself, also with null or repeated ids; repeated rows each stay. Columns but ``doc_id``, ``text`` and
    ``lang`` (which may be missing) do not matter. An empty table gives no rows. Without labels, and in
    strata with too few, only the base rules decide.
    """
    stats = written(statistics(docs), "rules-statistics")
    return judged(stats, calibrate(stats, labels)).select("doc_id", *_STATS, "base_failed", "kept")


def keep_by_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Stage: the rows of ``docs`` that the rules keep, all columns; thresholds come from the labels of these rows.

    Null and empty texts go; long texts are measured whole. Rows with null or repeated ids are judged by
    their text and language; repeated rows go or stay together. Columns of any name pass through. An
    empty table gives no rows; without labels only the base rules decide. While the labelled ids are few
    enough to broadcast, only their documents are measured for the thresholds.
    """
    prepare(docs.sparkSession)
    ids = small(written(_marks(labels).select("label_id"), "rules-labels"))
    labelled = docs if ids is None else docs.join(ids, docs["doc_id"].cast("long") == ids["label_id"], "left_semi")
    cutoffs = calibrate(written(statistics(labelled), "rules-statistics"), labels)

    @F.pandas_udf("boolean")
    def kept(texts: pd.Series, strata: pd.Series) -> pd.Series:
        begin(__name__)
        out = []
        for text, s in zip(texts, strata, strict=True):
            stats, levels = measure(text if isinstance(text, str) else None)
            bad = any(x >= c for x, c in zip(levels, cutoffs.get(s, ()), strict=False))
            out.append(not bad and not base_failed(stats[0], stats[4]))
        return pd.Series(out, dtype=bool)

    mark = fresh("kept", docs.columns)
    return docs.withColumn(mark, kept(text_column(docs), stratum(_lang(docs)))).filter(F.col(mark)).drop(mark)


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
