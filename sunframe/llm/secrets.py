"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

Labelled samples and all words of the corpus train character chains: one of random strings for each alphabet that secrets are
made of, one of ordinary identifiers, and one of every other ordinary kind (UUIDs). A run of
identifier characters is searched for the stretches whose summed log-likelihood ratios are largest;
where a stretch stands, and what surrounds it, does not matter. The ratios alone decide.
"""

from __future__ import annotations

import hashlib
import random
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunframe.llm.common import begin, fresh, id_and_text, map_texts, prepare, table, text_column, written

#: The base patterns by kind, in the order that ties are listed.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
#: Runs of at least so many identifier characters are looked at by the Markov models.
CANDIDATE, CHARACTERS = re.compile(r"[A-Za-z0-9+/_=-]{20,}"), re.compile(r"[A-Za-z0-9+/_=-]+")
#: Least score and characters of a stretch; an inner fall by that score cuts one in two.
LEAST_SCORE, LEAST_STRETCH = 10.0, 10
#: Share of held-out ordinary strings that may pass the threshold.
FALSE_SHARE = 0.003
#: Strings of one alphabet that make a chain of random strings.
LEAST_ALIKE = 50
#: Strings by label in the generated sample, and its seed.
SAMPLE, SEED = 4000, 7
#: Weight of a string that teaches, and of the same in capitals, as constants are written.
WHOLE, CAPITALS = 4, 1
#: Words that the corpus teaches; patterns that keep a document from teaching any.
WORD, _BASE = "[A-Za-z0-9+/_=-]{5,}", r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""
#: Words that the sample's ordinary identifiers are made of.
WORDS = (
    "account action active address admin agent alert amount analysis answer application archive argument array article attribute author "
    "average balance bank batch begin binary block board body border branch buffer build business button cache calendar callback camera "
    "cancel category center change channel character check child class client clock close cluster code color column command comment common "
    "company component config connect contact container content context control convert copy count country course create current customer "
    "data database date debug default define delete delivery department depth describe design detail device dialog dictionary digital "
    "direction directory display distance document domain double download driver dynamic edge element email empty enable encode engine "
    "entry environment error event example exception execute expand export expression extension factory feature field figure file filter "
    "final find first flag folder format forward frame function gateway general generate global graph group handler header health height "
    "history home image import index info initial input insert instance integer interface internal invoice item iterator journal key label "
    "language layer layout length level library license limit line link list listener loader local location logger login machine manager "
    "mapping market master matrix measure media member memory menu message method metric minute mobile model module monitor month mouse "
    "name native network node normal note notice number object offset online operation option order output owner package page panel "
    "parameter parent parse partition password path pattern payment people period person picture player plugin point policy pool position "
    "post prefix price print private process product profile program project property protocol provider public query queue random range "
    "record reference region register release remote render report repository request reset resource response result return review role "
    "root route row sample scale schedule schema screen script search second section security select sender sequence server service "
    "session setting shape share signal simple single size socket source space span start state static status step storage store stream "
    "string style subject submit summary support switch symbol system table target task team template test text thread ticket time title "
    "token tool topic total trace track train transaction transfer transform tree trigger type unit update upload user utility valid value "
    "variable vector vendor version video view visible visit volume warning watch web weight widget width window word work worker writer "
    "the and that with from this for are was have not tion ing ent her eau ment elle que ation ich der die ein ung keit heit sch los las "
    "ado mente cion para como por est ver zur auf mit von den des"
).split()
_ALPHABETS = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
)
#: The state before the first character, then the characters of a run.
_STATES = "^ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.zeros(256, np.int64)
_CODE[[ord(c) for c in _STATES]] = range(len(_STATES))
#: Weight of the shorter context's estimate, in observations.
_PRIOR = 20.0


def labelled_samples(n: int = SAMPLE, seed: int = SEED) -> list[tuple[str, str]]:
    """(label, string): random strings ("secret"), ordinary identifiers ("identifier") and UUIDs ("uuid"), the same everywhere."""
    r = random.Random(seed)
    out = [("secret", "".join(r.choices(_ALPHABETS[i % len(_ALPHABETS)], k=r.randint(20, 48)))) for i in range(n)]
    out += [("uuid", str(uuid.UUID(int=r.getrandbits(128), version=4))) for _ in range(n)]
    styles = (
        lambda w: "_".join(w),
        lambda w: "-".join(w),
        lambda w: "/".join(w),
        lambda w: "".join(x.capitalize() for x in w),
        lambda w: w[0] + "".join(x.capitalize() for x in w[1:]),
        lambda w: "_".join(w).upper(),
        lambda w: "".join(w),
        lambda w: "".join(w).upper(),
        lambda w: "_".join(w) + "_" + str(r.randint(0, 9999)),
        lambda w: "-".join([*w, f"{r.randint(1990, 2030)}", f"{r.randint(1, 12):02}"]),
        lambda w: r.choice("=-_") * r.randint(4, 40) + w[0] + r.choice("=-_") * r.randint(2, 40),
        lambda w: "=".join(["_".join(w), str(r.randint(0, 99))]),
    )
    made = 0
    while made < n:
        text = r.choice(styles)([r.choice(WORDS) for _ in range(r.randint(3, 7))])
        if len(text) >= 20:
            out.append(("identifier", text))
            made += 1
    return out


def _states(run: str) -> np.ndarray:
    """States of a run's characters, after two that stand for its start."""
    return np.concatenate([np.zeros(2, np.int64), _CODE[np.frombuffer(run.encode(), np.uint8)]])


def triples(strings: list[str], weights: Iterable[int] | None = None) -> np.ndarray:
    """How often, by weight, each character follows each two others; ``strings`` hold characters of a run alone."""
    size = len(_STATES)
    if not strings:
        return np.zeros(size**3)
    c = _CODE[np.frombuffer("".join("^^" + s for s in strings).encode(), np.uint8)]
    at = np.flatnonzero(c)
    each = None if weights is None else np.repeat(np.fromiter(weights, np.float64, len(strings)), [len(s) for s in strings])
    return np.bincount((c[at - 2] * size + c[at - 1]) * size + c[at], each, size**3).astype(np.float64)


def smoothed(counts: np.ndarray) -> np.ndarray:
    """``log p[i, j, k]`` of character k after i and j: a second-order chain, each context smoothed by the shorter one."""
    size = len(_STATES)
    counts = counts.reshape(size, size, size)
    pairs, single = counts.sum(axis=0), counts.sum(axis=(0, 1))
    p1 = (single + 1.0) / (single.sum() + size)
    p2 = (pairs + _PRIOR * p1) / (pairs.sum(axis=1, keepdims=True) + _PRIOR)
    return np.log((counts + _PRIOR * p2) / (counts.sum(axis=2, keepdims=True) + _PRIOR))


def chain(strings: Iterable[str]) -> np.ndarray:
    """The chain of some strings."""
    strings = list(strings)
    return smoothed(sum((triples(strings[at : at + 10_000]) for at in range(0, len(strings), 10_000)), np.zeros(len(_STATES) ** 3)))


def _alphabet(text: str) -> str:
    """The kinds of characters of a secret: secrets of one kind train one chain."""
    if re.fullmatch("[0-9a-f]*", text):
        return "hex"
    if re.fullmatch("[0-9A-F]*", text):
        return "HEX"
    return "".join(k for k, pattern in (("A", "[A-Z]"), ("a", "[a-z]"), ("0", "[0-9]"), ("+", "[^A-Za-z0-9]")) if re.search(pattern, text))


def best_segment(steps: np.ndarray) -> tuple[float, int, int]:
    """(sum, start, end) of the contiguous part with the largest sum; of equal ones the first to end, and of these the shortest."""
    total = np.concatenate([[0.0], np.cumsum(steps)])
    gain = total[1:] - np.minimum.accumulate(total)[:-1]
    end = int(gain.argmax()) + 1
    start = end - 1 - int(total[:end][::-1].argmin())
    return float(total[end] - total[start]), start, end


def stretches(steps: np.ndarray, least: float) -> list[tuple[float, int, int]]:
    """(sum, start, end) of disjoint parts that sum to over ``least``: the largest, then those before and after it, and so on.

    A part that holds an inner part of ``-LEAST_SCORE`` or less is cut there: the worst inner part goes.
    """
    found, todo = [], [(0, len(steps))]
    while todo:
        low, high = todo.pop()
        if low >= high:
            continue
        total, a, b = best_segment(steps[low:high])
        if total <= least:
            continue
        todo += [(low, low + a), (low + b, high)]
        parts = [(low + a, low + b)]
        while parts:
            x, y = parts.pop()
            fall, p, q = best_segment(-steps[x:y])
            if fall >= LEAST_SCORE:
                parts += [(x, x + p), (x + q, y)]
            elif y - x >= LEAST_STRETCH and (s := float(steps[x:y].sum())) > least:
                found.append((s, x, y))
    return sorted(found, key=lambda s: s[1])


class SecretScanner:
    """``secrets(run)``: where a run is random rather than ordinary, by summed log-likelihood ratios.

    Trained from labelled strings: "secret", "identifier", and any other label for a further ordinary
    kind. Every other string of a label trains; the rest is held out. ``threshold`` is the score that a
    share ``FALSE_SHARE`` of the held-out identifiers exceeds, at least ``LEAST_SCORE``.
    """

    def __init__(self, samples: Iterable[tuple[str, str]] | None = None) -> None:
        by: dict[str, list[str]] = {}
        for label, text in samples if samples is not None else labelled_samples():
            text = "".join(CHARACTERS.findall(text))
            if text:
                by.setdefault(label, []).append(text)
        secret, plain = by.pop("secret", []), by.pop("identifier", [])
        alike: dict[str, list[str]] = {}
        for s in secret[::2]:
            alike.setdefault(_alphabet(s), []).append(s)
        few = [s for group in alike.values() if len(group) < LEAST_ALIKE for s in group]
        groups = [g for g in alike.values() if len(g) >= LEAST_ALIKE] or [few]
        self._fit([chain(g) for g in groups], chain(plain[::2]), [chain(x[::2]) for _, x in sorted(by.items())])
        held = [s for s in plain[1::2] if len(s) >= 20]
        self.threshold = LEAST_SCORE
        scores = sorted(self.score(s) for s in held)
        if scores:
            self.threshold = max(LEAST_SCORE, scores[min(len(scores) - 1, int((1 - FALSE_SHARE) * len(scores)))])
        self.recall = sum(bool(self.scan(s)) for s in secret[1::2]) / max(1, len(secret[1::2]))

    def _fit(self, groups: list[np.ndarray], ordinary: np.ndarray, others: list[np.ndarray]) -> None:
        self._ratio = np.stack([g - ordinary for g in groups]).astype(np.float32)
        self._others = np.stack([x - ordinary for x in others]).astype(np.float32) if others else np.zeros((0, *ordinary.shape), np.float32)

    @classmethod
    def of_counts(cls, counts: dict[tuple[str, str], tuple[float, np.ndarray]]) -> SecretScanner:
        """A scanner of (strings, triples) by label and, for secrets, alphabet; its threshold is ``LEAST_SCORE``."""
        none = (0.0, np.zeros(len(_STATES) ** 3))
        alike = [counts[k] for k in sorted(counts) if k[0] == "secret"] or [none]
        groups = [t for n, t in alike if n >= LEAST_ALIKE] or [sum(t for _, t in alike)]
        self = cls.__new__(cls)
        others = [smoothed(counts[k][1]) for k in sorted(counts) if k[0] not in ("secret", "identifier")]
        self._fit([smoothed(t) for t in groups], smoothed(counts.get(("identifier", ""), none)[1]), others)
        self.threshold = LEAST_SCORE
        return self

    def steps(self, run: str) -> np.ndarray:
        """Log-likelihood ratio of each character, one row a chain of random strings."""
        c = _states(run)
        return self._ratio[:, c[:-2], c[1:-1], c[2:]].astype(np.float64)

    def score(self, run: str) -> float:
        """The best sum of a stretch of the run under any chain."""
        total = np.cumsum(self.steps(run), axis=1)
        total = np.concatenate([np.zeros((len(total), 1)), total], axis=1)
        return float((total[:, 1:] - np.minimum.accumulate(total, axis=1)[:, :-1]).max(initial=0.0))

    def secrets(self, run: str) -> list[tuple[int, int]]:
        """(start, end) of the stretches over the threshold; of overlapping ones of several chains the best.

        A stretch that another ordinary kind explains as well, within ``LEAST_SCORE``, is none.
        """
        if self.score(run) <= self.threshold:
            return []
        found = [(-s, a, b, k) for k, row in enumerate(self.steps(run)) for s, a, b in stretches(row, self.threshold)]
        c, taken = _states(run), np.zeros(len(run), bool)
        out = []
        for s, a, b, _ in sorted(found):
            if taken[a:b].any():
                continue
            taken[a:b] = True
            others = self._others[:, c[a:b], c[a + 1 : b + 1], c[a + 2 : b + 2]].sum(axis=1, dtype=np.float64)
            if not len(others) or -s - others.max() > LEAST_SCORE:
                out.append((a, b))
        return sorted(out)

    def scan(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) of every secret, by start, then kind; code points, end exclusive."""
        text = text or ""
        spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGNED]
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
        spans += [("hex", *m.span()) for m in HEX.finditer(text)]
        taken = _merged([span[1:] for span in spans])
        ends = [b for _, b in taken]
        for m in CANDIDATE.finditer(text):
            start, end = m.span()
            for at in range(bisect_right(ends, start), len(taken) + 1):  # the gaps between base spans
                stop = min(end, taken[at][0]) if at < len(taken) else end
                if start < stop:
                    spans += [("markov", start + a, start + b) for a, b in self.secrets(text[start:stop])]
                if stop == end:
                    break
                start = max(start, taken[at][1])
        return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_SCANNERS: dict[int, SecretScanner] = {}


def scanner() -> SecretScanner:
    """The scanner of the generated samples alone, one a process."""
    if 0 not in _SCANNERS:
        _SCANNERS[0] = SecretScanner()
    return _SCANNERS[0]


def corpus_words(docs: DataFrame) -> DataFrame:
    """Column ``word``: ordinary strings of a whole corpus, those that stand in two different texts without a base secret.

    Every row is read. A secret that no pattern knows seldom stands in two different texts, so it does not
    teach that it is ordinary.
    """
    texts = id_and_text(docs).filter(F.col("text").isNotNull() & ~F.col("text").rlike(_BASE))
    found = texts.select(F.xxhash64("text").alias("whole"), F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("word"))
    return found.groupBy("word").agg(F.min("whole").alias("a"), F.max("whole").alias("b")).filter("a < b").select("word")


_COUNTS = pa.schema([("label", pa.string()), ("alphabet", pa.string()), ("triple", pa.int32()), ("n", pa.float64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted triples of (label, text, weight) by label and alphabet; triple -1 counts strings."""
    begin(__name__)
    sums: dict[tuple[str, str], list] = {}

    def rows():
        for (label, alphabet), (n, t) in sums.items():
            at = np.flatnonzero(t)
            arrays = [pa.array(np.r_[-1, at], pa.int32()), pa.array(np.r_[n, t[at]])]
            yield pa.RecordBatch.from_arrays([pa.repeat(label, len(at) + 1), pa.repeat(alphabet, len(at) + 1), *arrays], schema=_COUNTS)
        sums.clear()

    for batch in batches:
        by: dict[tuple[str, str], list[tuple[str, int]]] = {}
        for label, text, weight in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = "".join(CHARACTERS.findall(text))
            if text:
                by.setdefault((label, _alphabet(text) if label == "secret" else ""), []).append((text, weight))
        for kind, strings in by.items():
            held = sums.setdefault(kind, [0.0, 0.0])
            held[0] += sum(w for _, w in strings)
            held[1] = held[1] + triples([x for x, _ in strings], [w for _, w in strings])
            if len(sums) >= 64:
                yield from rows()
    yield from rows()


def ranked(rows: DataFrame, share: float) -> float | None:
    """The least ``score`` that, with those below it, has over ``share`` of the ``weight`` (whole numbers), else the largest; none without rows.

    Exact, whatever the number of rows: a thousand bins a round, each round within one bin of the last.
    """
    low, high, total = rows.agg(F.min("score"), F.max("score"), F.sum("weight")).first()
    if low is None:
        return None
    below = 0
    while low < high:
        place = F.least(F.floor((F.col("score") - F.lit(low)) / F.lit(high - low) * 1000), F.lit(999)).alias("bin")
        inside = rows.filter(F.col("score").between(low, high)).groupBy(place).agg(F.min("score").alias("low"), F.max("score").alias("high"), F.sum("weight").alias("weight"))
        for r in sorted(inside.collect()):
            low, high = r["low"], r["high"]
            if below + r["weight"] > share * total:
                break
            below += r["weight"]
        else:
            return high
    return low


def trained(docs: DataFrame, samples: DataFrame | None = None) -> SecretScanner:
    """A scanner for a corpus: generated samples, all of the corpus's own ordinary words, and all labelled ``samples``.

    ``samples`` has ``label`` ("secret", "identifier" or the name of another ordinary kind) and ``text``.
    Null labels and texts teach nothing, repeated rows teach once. Half of the strings train, by a hash; the
    identifiers of the other half set the threshold. Words of the corpus also count, by a quarter, in
    capitals. The driver gets counts of character triples, at most 66 ** 3 a label and alphabet.
    """
    spark = prepare(docs.sparkSession)
    seen: dict[str, int] = {}
    made = []
    for label, text in labelled_samples():
        seen[label] = seen.get(label, 0) + 1
        made.append((label, text, WHOLE, (seen[label] - 1) % 2))
    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half")
    rows = spark.createDataFrame(made, "label string, text string, weight int, half int").coalesce(1)
    words = written(corpus_words(docs).select(F.col("word").alias("text"), half), "secret-words")
    for text, weight in ((F.col("text"), WHOLE), (F.upper("text"), CAPITALS)):
        rows = rows.unionByName(words.select(F.lit("identifier").alias("label"), text.alias("text"), F.lit(weight).alias("weight"), "half"))
    if samples is not None:
        given = samples.select(F.col("label").cast("string").alias("label"), F.col("text").cast("string").alias("text")).na.drop().distinct()
        rows = rows.unionByName(given.select("label", "text", F.lit(WHOLE).alias("weight"), half))
    taught = rows.filter("half = 0").select("label", "text", "weight").mapInArrow(_counted, "label string, alphabet string, triple int, n double")
    found = taught.groupBy("label", "alphabet", "triple").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[tuple[str, str], tuple[float, np.ndarray]] = {}
    kinds = found.group_by(["label", "alphabet"]).aggregate([]).to_pylist()
    for k in kinds:
        own = found.filter((pc.field("label") == k["label"]) & (pc.field("alphabet") == k["alphabet"]))
        at, n = own["triple"].to_numpy(), own["n"].to_numpy() / WHOLE
        counts[k["label"], k["alphabet"]] = float(n[at < 0].sum()), np.bincount(at[at >= 0], n[at >= 0], len(_STATES) ** 3)
    model = SecretScanner.of_counts(counts)
    shared = spark.sparkContext.broadcast(model)  # tables of fixed size

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = ["".join(CHARACTERS.findall(x)) for x in batch.column(0).to_pylist()]
            long = [(shared.value.score(x), w) for x, w in zip(runs, batch.column(1).to_pylist(), strict=True) if len(x) >= 20]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in long], pa.float64()), pa.array([w for _, w in long], pa.int64())], ["score", "weight"])

    held = rows.filter("half = 1 and label = 'identifier' and length(text) >= 20").select("text", "weight")
    least = ranked(written(held.mapInArrow(scored, "score double, weight long"), "secret-scores"), 1 - FALSE_SHARE)
    shared.unpersist()
    model.threshold = max(LEAST_SCORE, least or 0.0)
    return model


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def secret_scans(docs: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """One row a document: counts of the base kinds, a digest of the base spans, and all spans.

    Null and empty texts have no spans (the digest is that of the empty string). Long texts are read
    whole. Base spans of different kinds may overlap; a Markov span overlaps no other. Each row stands
    for itself, also with null or repeated ids; repeated rows each stay. Columns but ``doc_id`` and
    ``text`` do not matter. An empty table gives no rows; the models then learn from generated samples
    alone. ``samples``: see :func:`trained`.
    """
    model = prepare(docs.sparkSession).sparkContext.broadcast(trained(docs, samples))  # tables of fixed size

    def make():
        def work(texts):
            got = [model.value.scan(t) for t in texts]
            base = [[s for s in g if s[0] != "markov"] for g in got]
            counts = [pa.array([sum(s[0] == kind for s in b) for b in base], pa.int64()) for kind in KINDS[:3]]
            return [*counts, pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()), pa.array([joined(g) for g in got], pa.string())]

        return work

    return map_texts(docs, make, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str, mark: str = "[SECRET]", model: SecretScanner | None = None) -> str:
    """The text with each span, overlapping ones as one, replaced by ``mark``."""
    out, at = [], 0
    for start, end in _merged([s[1:] for s in (model or scanner()).scan(text)]):
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Stage: secrets in ``text`` give way to a mark and ``n_chars`` follows; every row and column stays.

    A text without secrets is unchanged, null stays null and empty stays empty; long texts are read whole.
    ``n_chars`` changes only where a text does. Repeated rows and those with null ids are treated like any
    other; columns of any name pass through. An empty table gives no rows.
    """
    model = prepare(docs.sparkSession).sparkContext.broadcast(trained(docs, samples))  # tables of fixed size

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        begin(__name__)
        return pd.Series([redacted(t, model=model.value) if isinstance(t, str) else None for t in texts], dtype=object)

    new = fresh("redacted", docs.columns)
    got = docs.withColumn(new, clean(text_column(docs)))
    changes = {"text": F.col(new)}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changes["n_chars"] = F.when(F.col(new) == docs["text"], docs["n_chars"]).when(F.col(new).isNull(), docs["n_chars"]).otherwise(F.length(new).cast(kind))
    return got.withColumns(changes).select(*docs.columns)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans(table(spark, sf_dir, "documents"))
