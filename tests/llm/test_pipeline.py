"""The pipeline against a plain version, stage by stage."""

from __future__ import annotations

import pyarrow as pa

import corpus_pipeline
from sunframe.llm import classifier, common, encoding, packing, rules, secrets
from tests.conftest import SF_LARGER
from tests.llm.edges import EXTRA, edge_docs
from tests.llm.test_quality import brute_stats
from tests.llm.test_scans import brute_secrets
from tests.llm.test_similar import kept_by_brute_force
from tests.llm.test_tokens import check_packing


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{SF_LARGER}/labels.parquet")
    plain = {r["doc_id"]: r for r in docs.collect()}
    stages = [f for _, f in corpus_pipeline.STAGES]

    model = classifier.train(docs, labels)
    scores = dict(zip(plain, model.score([r["text"] for r in plain.values()]), strict=True))
    one = stages[0](spark, docs, SF_LARGER)
    kept = {r["doc_id"]: r for r in one.collect()}
    assert kept == {i: r for i, r in plain.items() if scores[i] >= 0.7}

    cutoffs = rules.calibrate(rules.statistics(one), labels)
    two = stages[1](spark, one, SF_LARGER)

    def passes(r):
        words, _, _, _, repeated = brute_stats(r["text"])
        levels = rules.measure(r["text"])[1]
        return not (words < 20 or 100 * repeated > 30 * words) and not any(x >= c for x, c in zip(levels, cutoffs.get(r["lang"], ()), strict=False))

    want = {i: r for i, r in kept.items() if passes(r)}
    assert {r["doc_id"]: r for r in two.collect()} == want

    three = stages[2](spark, two, SF_LARGER)
    ids = sorted(want)
    least, pairs, _ = kept_by_brute_force(ids, [want[i]["text"] for i in ids])
    alone = {i: want[i] for i in least}
    assert pairs
    assert {r["doc_id"]: r for r in three.collect()} == alone and len(alone) < len(want)

    four = stages[3](spark, three, SF_LARGER)
    clean = {r["doc_id"]: r for r in four.collect()}
    assert set(clean) == set(alone)
    markov = secrets.trained(three)
    for i, r in clean.items():
        text = alone[i]["text"]
        spans = [tuple(map(int, x.split(":")[1:])) for x in brute_secrets(text)] + [(a, b) for k, a, b in markov.scan(text) if k == "markov"]
        hidden = {k for a, b in spans for k in range(a, b)}
        assert "".join(c for k, c in enumerate(text) if k not in hidden) == r["text"].replace("[SECRET]", "") and r["n_chars"] == len(r["text"])

    packed = stages[4](spark, four, SF_LARGER).collect()
    check_packing(packed, [(i, r["text"]) for i, r in clean.items()], 2048, 0)

    whole = corpus_pipeline.run(spark, SF_LARGER)
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole.collect()) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


def test_stages_keep_the_columns_of_documents(spark):
    docs = edge_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, docs.limit(0)):
            out = stage(spark, frame, SF_LARGER)
            assert out.columns == docs.columns and out.count() <= frame.count()
            assert all(r[c] == f"own {c}" for r in out.collect() for c in EXTRA)
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF_LARGER).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_clean_documents_stay(spark):
    """Of the documents with a good label and a long enough text, the filtering stages reject next to none."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    good = docs.join(labels.filter("quality = 1"), "doc_id", "left_semi").filter("size(split(text, '\\\\s+')) >= 25")
    total = good.count()
    for _, stage in corpus_pipeline.STAGES[:2]:
        out = stage(spark, docs, "/root/testdata/sf0.1")
        left = good.join(out, "doc_id", "left_semi").count()
        assert left >= 0.98 * total


def test_workers_forget_the_ids_of_the_packing_when_another_stage_begins(spark):
    docs = spark.read.parquet(f"{SF_LARGER}/documents.parquet").repartition(8)
    packing.pack(docs).count()

    def make():
        return lambda texts: [pa.array([len(encoding._ENCODERS)] * len(texts), pa.int64())]

    assert {r["held"] for r in common.map_texts(docs, make, "held long").collect()} == {0}
