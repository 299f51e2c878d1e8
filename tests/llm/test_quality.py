"""Quality rules and classifier."""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from sunframe.llm import classifier, rules
from tests.conftest import SF_LARGER
from tests.llm.edges import EXTRA, ROWS, edge_docs, edge_labels, no_docs


def brute_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@pytest.mark.parametrize("text", [t for _, t, _ in ROWS] + ["a b c d e f g h " * 2, "a " * 9, "a " * 8, "é#*\x1c$%&|<> x\x85y", "\n\n \n \nx\nx\n x", "a b c d e f g h i " * 3 + "z"])
def test_statistics_are_the_definition(text):
    assert rules.measure(text)[0] == brute_stats(text)


def test_repeats_in_random_texts():
    r = random.Random(0)
    for _ in range(200):
        text = " ".join(r.choice("abc") for _ in range(r.randint(0, 60)))
        assert rules.measure(text)[0] == brute_stats(text)


def test_op5_equals_brute_force(spark):
    docs = dict(zip(*pq.read_table(f"{SF_LARGER}/documents.parquet").select(["doc_id", "text"]).to_pydict().values(), strict=True))
    rows = rules.op5_rules(spark, SF_LARGER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        stats = brute_stats(docs[r["doc_id"]])
        failed = stats[0] < 20 or 100 * stats[4] > 30 * stats[0]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (*stats, failed)
        assert not (failed and r["kept"])


@pytest.mark.parametrize(("k", "n", "p"), [(0, 10, 0.3), (3, 20, 0.05), (5, 100, 0.05), (0, 1, 0.5), (40, 1000, 0.05), (7, 7, 0.2), (999, 20000, 0.05)])
def test_binomial_tail_is_exact(k, n, p):
    terms = [math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1)]
    assert math.isclose(rules.binomial_tail(k, n, p), min(1.0, math.fsum(terms)), rel_tol=1e-9)


def labelled(spark, n=3000, lang="en"):
    """Good documents are plain; bad ones carry symbols; one good one in 200 has a few."""
    r, rows, marks = random.Random(8), [], []
    for i in range(n):
        words = [r.choice(["sea", "wind", "stone", "light", "river", "cloud", "mountain"]) + str(r.randrange(50)) for _ in range(40)]
        bad = i % 5 == 0
        if bad or i % 200 == 1:
            words = [w + "***" for w in words]
        rows.append((i, " ".join(words), lang))
        marks.append((i, 0 if bad else 1))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(marks, "doc_id long, quality int")


def test_cutoffs_reject_junk_and_keep_their_promise(spark):
    docs, labels = labelled(spark)
    rows = rules.quality_rules(docs, labels).collect()
    good = [r for r in rows if r["doc_id"] % 5]
    bad = [r for r in rows if r["doc_id"] % 5 == 0]
    assert sum(not r["kept"] for r in bad) == len(bad)
    assert sum(not r["kept"] for r in good) <= rules.ALPHA * len(good)


def test_too_few_labels_give_no_method_rule(spark):
    docs, labels = labelled(spark, 60)
    assert all(r["kept"] != r["base_failed"] for r in rules.quality_rules(docs, labels).collect())


def test_cutoffs_equal_brute_force(spark):
    docs, labels = labelled(spark, 2000)
    got = rules.calibrate(rules.statistics(docs), labels)
    stats = {r["doc_id"]: r["levels"] for r in rules.statistics(docs).collect()}
    half = {r["i"]: r["h"] for r in spark.sql("select id as i, pmod(xxhash64(id), 2) as h from range(2000)").collect()}
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    options = []
    for q in rules.QUANTILES:
        cuts = []
        for f in range(len(rules.FEATURES)):
            values = sorted(stats[i][f] for i in stats if half[i] == 0 and quality[i] == 1)
            cuts.append(values[math.ceil(q * len(values) - 1e-9) - 1] + 1)
        options.append(cuts)

    def rejected(h, good, cuts):
        return sum(any(x >= c for x, c in zip(stats[i], cuts, strict=True)) for i in stats if half[i] == h and quality[i] == good)

    n = sum(half[i] == 1 and quality[i] == 1 for i in stats)
    passing = [(rejected(0, 0, c) - rejected(0, 1, c), -k) for k, c in enumerate(options) if rules.binomial_tail(rejected(1, 1, c), n, rules.ALPHA) <= rules.DELTA / len(options)]
    assert got == {"en": options[-max(passing)[1]]}


def test_rules_on_edges(spark):
    docs, labels = edge_docs(spark), edge_labels(spark)
    rows = rules.quality_rules(docs, labels).collect()
    assert len(rows) == len(ROWS)
    out = rules.keep_by_rules(docs, labels)
    assert out.columns == docs.columns
    kept = out.collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(r["doc_id"]) for r in rows if r["kept"])
    assert all(r[c] == f"own {c}" for r in kept for c in EXTRA)
    assert rules.quality_rules(no_docs(spark), labels).count() == 0 == rules.keep_by_rules(no_docs(spark), labels.limit(0)).count()
    assert rules.quality_rules(docs.drop("lang"), labels).count() == len(ROWS)


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(1)
    per_text = np.array([1, 4, 3, 6])
    unary, t = r.normal(size=per_text.sum()), r.normal(size=(2, 2))
    model = classifier.Chains(per_text)
    got = classifier._sigmoid(sum(model.forward_backward(unary, t)))
    at = 0
    for n in per_text:
        u, weights = unary[at : at + n], np.zeros((2, n))
        for labels in np.ndindex(*[2] * n):
            w = math.exp(sum(u[i] for i in range(n) if labels[i]) + sum(t[a, b] for a, b in zip(labels, labels[1:], strict=False)))
            for i, y in enumerate(labels):
                weights[y, i] += w
        assert np.allclose(got[at : at + n], weights[1] / weights.sum(0))
        at += n


def test_training_follows_the_likelihood():
    """The gradient that training climbs is that of the log-likelihood of the chain."""
    r = np.random.default_rng(2)
    own, per_text = r.integers(0, 2, (40, classifier.WIDTH)).astype(np.uint8), np.array([3, 5, 2, 10, 20])
    label = np.array([1, 0, 1, 1, 0])
    few, many = classifier.LineCRF.fit(own, per_text, label, 5), classifier.LineCRF.fit(own, per_text, label, 120)

    def likelihood(m):
        x = classifier.design(own, per_text) @ m.weights
        total, at = 0.0, 0
        for n, y in zip(per_text, label, strict=True):
            u = x[at : at + n]
            alpha = np.array([0.0, u[0]])
            for i in range(1, n):
                alpha = np.logaddexp(alpha[0] + m.transitions[0], alpha[1] + m.transitions[1]) + np.array([0.0, u[i]])
            total += y * u.sum() + (n - 1) * m.transitions[y, y] - np.logaddexp(*alpha)
            at += n
        return total

    assert likelihood(many) > likelihood(few) > likelihood(classifier.LineCRF(np.zeros_like(few.weights), np.zeros((2, 2))))


def test_op10_held_out_accuracy_and_contract(spark):
    sf = "/root/testdata/sf0.1"
    quality = dict(zip(*pq.read_table(f"{sf}/labels.parquet").select(["doc_id", "quality"]).to_pydict().values(), strict=True))
    rows = classifier.op10_classifier(spark, sf).collect()
    assert len(rows) == pq.read_table(f"{sf}/documents.parquet", columns=["doc_id"]).num_rows > 5000
    held = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["held_out"] and r["doc_id"] in quality:
            held.append((quality[r["doc_id"]], r["predicted"], r["score"]))
    assert len(held) > 500
    assert sum(a == b for a, b, _ in held) > 0.97 * len(held)
    good, bad = [s for a, _, s in held if a], [s for a, _, s in held if not a]
    assert np.mean([g > b for g in good for b in bad]) > 0.99


def test_lines_of_a_mixed_document_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = classifier.train(docs, labels)
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    scored = [(r["text"], quality[r["doc_id"]]) for r in docs.join(labels, "doc_id").select("doc_id", "text").limit(400).collect()]
    good = [line for t, q in scored if q == 1 for line in t.split("\n") if len(line) > 60][:6]
    bad = [line for t, q in scored if q == 0 for line in t.split("\n") if len(line) > 60][:6]
    own, _, per_text = classifier.line_features(["\n".join(good + bad)])
    chance = model.marginals(own, per_text)
    assert len(good) == len(bad) == 6
    assert chance[:6].mean() > chance[6:].mean() + 0.3


def brute_features(text):
    """A line's indicators in plain Python, from the definition."""
    seen, rows = set(), []
    for line in (text or "").split("\n"):
        raw = line.encode()
        n, words = max(1, len(raw)), raw.split()

        def share(test, raw=raw, n=n):
            return sum(map(test, raw)) / n

        kinds = [
            (lambda b: 65 <= b <= 90, (0.12, 0.4, 0.7)), (lambda b: 48 <= b <= 57, (0.0, 0.05, 0.2)), (lambda b: b in b" \t\n\x0b\x0c\r", (0.08, 0.2, 0.3)),
            (lambda b: b in b"#*$%&|<>", (0.0, 0.01, 0.04, 0.1, 0.2)), (lambda b: b in b"!?", (0.0, 0.02, 0.08)), (lambda b: b in b".,;:'\"()-", (0.03, 0.06, 0.12)),
            (lambda b: b >= 128, (0.05, 0.2)),
            (lambda b: b < 128 and not (65 <= b <= 90 or 97 <= b <= 122 or 48 <= b <= 57 or b in b" \t\n\x0b\x0c\r#*$%&|<>!?.,;:'\"()-"), (0.0, 0.05)),
        ]
        row = [share(test) * n > t * n for test, ts in kinds for t in ts]
        size = (len(raw) - sum(b in b" \t\n\x0b\x0c\r" for b in raw)) / max(1, len(words))
        row += [not words, len(words) < 4, len(words) > 40, size < 3, size > 6, size > 8, size > 12, line in seen and line != "", len(set(words)) < 0.5 * len(words), len(set(words)) < 0.8 * len(words)]
        seen.add(line)
        rows.append([int(x) for x in row])
    return rows


def test_scores_equal_a_plain_version():
    """Features, marginals by enumeration of all labellings, and the length-weighted mean."""
    r = np.random.default_rng(5)
    model = classifier.LineCRF(r.normal(size=3 * classifier.WIDTH + 3), r.normal(size=(2, 2)))
    texts = ["One line.", None, "", "A LOUD LINE!!!\n\nA LOUD LINE!!!\nplain words go on here, 12 of them | #tag", "x\ny z\n" + "word " * 50 + "\nÜñï ünï", "<a>&amp;</a>\n{}[]~\n3.14 15 92"]
    got = model.score(texts)
    for text, score in zip(texts, got, strict=True):
        own, lines = np.array(brute_features(text), float), (text or "").split("\n")
        n, zero = len(lines), np.zeros(own.shape[1])
        unary = [np.concatenate([[1.0], own[i], own[i - 1] if i else zero, own[i + 1] if i + 1 < n else zero, [float(i == 0), float(i + 1 == n)]]) @ model.weights for i in range(n)]
        weights = np.zeros((2, n))
        for labels in np.ndindex(*[2] * n):
            w = math.exp(sum(u for u, y in zip(unary, labels, strict=True) if y) + sum(model.transitions[a, b] for a, b in zip(labels, labels[1:], strict=False)))
            for i, y in enumerate(labels):
                weights[y, i] += w
        length = np.array([max(1, len(x.encode())) for x in lines])
        want = float((weights[1] / weights.sum(0) * length).sum() / length.sum())
        assert score == pytest.approx(want, abs=1e-5)


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{SF_LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{SF_LARGER}/labels.parquet")
    flipped = labels.withColumn("quality", (1 - labels["quality"]) * classifier.held_out(labels["doc_id"]).cast("int") + labels["quality"] * (~classifier.held_out(labels["doc_id"])).cast("int"))
    a, b = classifier.train(docs, labels), classifier.train(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.transitions, b.transitions)


def test_the_sample_is_bounded_in_lines(spark, monkeypatch):
    rows = [(i, ("a good line of plain words here\n" if i % 2 else "$$$ ### !!!\n") * (3 if i else 400)) for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(classifier.LineCRF, "fit", classmethod(lambda cls, own, per_text, label: seen.append(per_text) or cls(np.zeros(3 * classifier.WIDTH + 3), np.zeros((2, 2)))))
    classifier.train(docs.union(docs), labels)
    assert len(seen[-1]) == len(rows) and max(seen[-1]) == 401
    monkeypatch.setattr(classifier, "MOST_LINES", 50)
    classifier.train(docs.filter("doc_id > 0"), labels)
    assert sum(seen[-1]) == 48


def test_classifier_on_edges(spark):
    docs, labels = edge_docs(spark), edge_labels(spark)
    rows = classifier.quality_scores(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False, False]
    kept = classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in rows)
    assert classifier.quality_scores(no_docs(spark), labels).count() == 0
    assert {r["score"] for r in classifier.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert len(classifier.LineCRF(np.zeros(3 * classifier.WIDTH + 3), np.zeros((2, 2))).score([])) == 0
