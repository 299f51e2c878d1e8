"""Encoding, BPE, the store and packing: all against the library."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sunframe.llm import bpe, packing, store
from sunframe.llm.encoding import Encoder, default_tokenizer
from tests.conftest import SF, SF_LARGER
from tests.llm.edges import LONG, ROWS, edge_docs, no_docs

LIBRARY = Tokenizer.from_file(default_tokenizer())
LIBRARY.no_truncation()
LIBRARY.no_padding()
ENCODER, CODEC = Encoder(default_tokenizer()), bpe.PrefixBPE(default_tokenizer())
ODD = [
    "", " ", "a", "it's I'LL we've'd''", "!!!!!!!!!!!!...?", "</w>", "a</w> b</w>", "<|endoftext|>", "x<|endoftext|>y<|ENDOFTEXT|>", "•", "a • b•c", "HEḺLO", "́a", "Σas ΑΣ", "İstanbul ſK",
    "tab\tnl\nvt\x0bff\fcr\rnbsp nel\x85fs\x1cend", "漢字かな交じり文", "😀👩‍👩‍👧‍👦", "don't.stop,now;'tis", "aaaaaaaaaaaaaaaaaaaaaaaa", "x" * 5000, "word,'s word,'ll", "\x00\x01 null", "word.'s",
]


def library(text: str | None) -> bytes:
    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("coder", [ENCODER, CODEC], ids=["library cache", "prefix"])
def test_ids_of_odd_texts(coder):
    texts = [*ODD, *(t for _, t, _ in ROWS), None]
    assert coder.encode(texts) == [library(t) for t in texts]
    assert coder.encode([]) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_ids_of_any_texts(texts):
    want = [library(t) for t in texts]
    assert ENCODER.encode(texts) == want
    assert CODEC.encode(texts) == want
    for ids in want:
        assert CODEC.decode(ids) == LIBRARY.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def test_ids_of_random_words():
    r = random.Random(2)
    texts = ["".join(r.choice("aeinrsthouldcm'.é") for _ in range(r.randint(1, 25))) for _ in range(5000)]
    assert CODEC.encode(texts) == [library(t) for t in texts]


def test_caches_may_overflow(monkeypatch):
    monkeypatch.setattr("sunframe.llm.encoding.CACHE_CHUNKS", 5)
    monkeypatch.setattr("sunframe.llm.bpe.CACHE_CHUNKS", 5)
    monkeypatch.setattr("sunframe.llm.bpe.CACHE_PAIRS", 5)
    coders = Encoder(default_tokenizer()), bpe.PrefixBPE(default_tokenizer())
    texts = [f"number{i} other{i * 7} and the rest {i}" for i in range(60)]
    for at in range(0, 60, 7):
        for coder in coders:
            assert coder.encode(texts[at : at + 7]) == [library(t) for t in texts[at : at + 7]]


def test_other_tokenizers_are_encoded_whole():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    texts = ["two  spaces\nand lines ", " leading", ""]
    assert Encoder(path).encode(texts) == [np.array(own.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    with pytest.raises(ValueError, match="end-of-word"):
        bpe.PrefixBPE(path)


def test_op4_equals_the_library(spark):
    docs = dict(zip(*pq.read_table(f"{SF_LARGER}/documents.parquet").select(["doc_id", "text"]).to_pydict().values(), strict=True))
    rows = bpe.op4_bpe(spark, SF_LARGER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library(docs[r["doc_id"]])
        text = LIBRARY.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_bpe_round_trip_and_edges(spark):
    encoded = bpe.encode_documents(edge_docs(spark))
    back = bpe.decode_documents(encoded).collect()
    assert len(back) == len(ROWS)
    texts = {i: t for i, t, _ in ROWS if i is not None}
    for r in back:
        if r["doc_id"] is not None:
            assert r["text"] == LIBRARY.decode(np.frombuffer(library(texts[r["doc_id"]]), "<u4").tolist(), skip_special_tokens=False)
    assert bpe.digests(no_docs(spark)).count() == 0


def stored(texts: list[tuple[int | None, str | None]]) -> list[tuple]:
    out, start = [], 0
    for i, t in texts:
        ids = library(t) + (2).to_bytes(4, "little")
        out.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def test_op2_equals_brute_force(spark):
    docs = sorted(zip(*pq.read_table(f"{SF_LARGER}/documents.parquet").select(["doc_id", "text"]).to_pydict().values(), strict=True))
    assert sorted(tuple(r) for r in store.op2_store(spark, SF_LARGER).collect()) == stored(docs)


def test_store_round_trip_on_edges(spark, tmp_path):
    path = str(tmp_path / "store")
    store.write_store(edge_docs(spark), path)
    rows = store.read_store(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted((i for i, _, _ in ROWS), key=lambda i: (i is not None, i))
    texts: dict = defaultdict(list)
    for i, t, _ in ROWS:
        texts[i].append(library(t) + (2).to_bytes(4, "little"))
    start = 0
    for r in rows:
        assert bytes(r["ids"]) in texts[r["doc_id"]] and r["start"] == start and r["n_tokens"] == len(r["ids"]) // 4
        start += r["n_tokens"]
    chunks = spark.read.parquet(f"{path}/chunks")
    assert chunks.count() == chunks.select("hash").distinct().count()
    digests = store.read_store(spark, path, digest_only=True).orderBy("start").collect()
    assert [d["ids_crc32"] for d in digests] == [zlib.crc32(bytes(r["ids"])) for r in rows]
    assert spark.read.parquet(f"{path}/recipes").filter("place < 0").count() >= 1


def test_store_of_nothing(spark, tmp_path):
    path = str(tmp_path / "empty")
    store.write_store(no_docs(spark), path)
    assert store.read_store(spark, path, digest_only=True).count() == 0


def test_chunks_that_many_documents_share_are_dealt_to_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MOST_USES", 3)
    r = np.random.default_rng(9)
    shared = " ".join(f"w{i}" for i in r.integers(0, 9999, 900))
    docs = spark.createDataFrame([(i, f"{shared} own{i} " * (1 + i % 3)) for i in range(40)] + [(50 + i, f"only {i}") for i in range(9)], "doc_id long, text string")
    path = str(tmp_path / "store")
    store.write_store(docs, path)
    got = {x["doc_id"]: bytes(x["ids"]) for x in store.read_store(spark, path).collect()}
    assert got == {x["doc_id"]: library(x["text"]) + (2).to_bytes(4, "little") for x in docs.collect()}
    sums = {x["doc_id"]: x["ids_crc32"] for x in store.read_store(spark, path, digest_only=True).collect()}
    assert sums == {k: zlib.crc32(v) for k, v in got.items()}


def test_payloads_move_once_when_a_store_is_read(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        path = str(tmp_path / "store")
        store.write_store(edge_docs(spark), path)
        plan = store.read_store(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    (scan,) = [i for i, line in enumerate(lines) if "FileScan parquet" in line and "store_chunks" in line]
    join = max(i for i in range(scan) if "Join" in lines[i])
    depth = lines[scan].index("FileScan")
    between = [line for line in lines[join + 1 : scan] if "+- " in line and line.index("+- ") < depth and "Exchange hashpartitioning(hash" in line]
    assert "Bucketed: true" in lines[scan] and not between


@pytest.mark.parametrize("harm", ["payload", "missing chunk", "recipe", "manifest"])
def test_a_damaged_store_is_noticed(spark, tmp_path, harm):
    from pyspark.sql import functions as F

    path, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    store.write_store(edge_docs(spark), path)
    chunks, recipes = spark.read.parquet(f"{path}/chunks"), spark.read.parquet(f"{path}/recipes")
    if harm == "payload":
        chunks = chunks.withColumn("payload", F.concat(F.lit(bytearray(b"\x07\x07")), F.expr("substring(payload, 3)")))
    elif harm == "missing chunk":
        chunks = chunks.orderBy("hash").limit(chunks.count() - 1)
    elif harm == "recipe":
        recipes = recipes.withColumn("n_tokens", F.when((F.col("doc_id") == 6) & (F.col("place") >= 0), F.col("n_tokens") + 1).otherwise(F.col("n_tokens")))
    else:
        recipes = recipes.filter("place >= 0")
    chunks.write.parquet(f"{bad}/chunks")
    recipes.write.parquet(f"{bad}/recipes")
    with pytest.raises(Exception, match="match|missing"):
        store.read_store(spark, bad, digest_only=True).collect()


def test_chunks_follow_content_not_place():
    r = np.random.default_rng(0)
    passage = r.integers(0, 49000, 6000).astype("<u4")
    a, b = np.concatenate([r.integers(0, 49000, 333).astype("<u4"), passage]), np.concatenate([r.integers(0, 49000, 1200).astype("<u4"), passage])
    cut = [store.chunk_ends(x, np.array([0, len(x)]))[0] for x in (a, b)]
    pieces = [{x[i:j].tobytes() for i, j in zip([0, *ends], ends, strict=False)} for x, ends in zip((a, b), cut, strict=True)]
    assert len(pieces[0] & pieces[1]) > 0.7 * len(pieces[0])
    for x, ends in zip((a, b), cut, strict=True):
        sizes = np.diff([0, *ends])
        assert ends[-1] == len(x) and sizes.max() <= store.MOST and sizes[:-1].min() >= store.LEAST
    both = np.concatenate([a, b])
    together = store.chunk_ends(both, np.array([0, len(a), len(both)]))
    assert together == [cut[0], [e + len(a) for e in cut[1]]]  # a neighbour in the batch changes nothing


def check_packing(rows, texts, capacity, end_id):
    """Pieces cover every document once, in order, and lie gapless in their sequences."""
    of = defaultdict(list)
    for r in rows:
        of[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in of.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = []
    for i, t in texts:
        ids = library(t) + end_id.to_bytes(4, "little")
        for k in range(0, len(ids), 4 * capacity):
            part = ids[k : k + 4 * capacity]
            want.append((i, k // (4 * capacity), k // 4, len(part) // 4, zlib.crc32(part)))
    def order(x):
        return (x[0] is not None, x)

    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=lambda x: tuple((v is not None, v) for v in x)) == sorted(want, key=lambda x: tuple((v is not None, v) for v in x))
    return len(of), sum(w[3] for w in want)


def test_op7_packs_everything_tightly(spark):
    docs = list(zip(*pq.read_table(f"{SF_LARGER}/documents.parquet").select(["doc_id", "text"]).to_pydict().values(), strict=True))
    sequences, tokens = check_packing(packing.op7_packing(spark, SF_LARGER).collect(), docs, 2048, 0)
    assert sequences <= 1.01 * -(-tokens // 2048) + 1


def test_packing_of_edges_through_many_levels(spark):
    docs = edge_docs(spark).repartition(40)
    rows = packing.pack(docs, capacity=64, fan=2).collect()
    sequences, tokens = check_packing(rows, [(i, t) for i, t, _ in ROWS], 64, 0)
    assert sequences <= 1.02 * -(-tokens // 64) + 1
    assert packing.pack(no_docs(spark)).count() == 0


def test_bounds_of_a_node_lose_nothing(spark, monkeypatch):
    items = [(40, [{"doc_id": i, "piece": 0, "start": 0, "length": 40, "ids_crc32": 0, "offset": 0}]) for i in range(9)]
    monkeypatch.setattr(packing, "HANDED_UP", 3)
    done, rest = packing._settle(packing._repack(items, 64), 64, False)
    assert len(done) == 6 and len(rest) == 3
    assert sorted(m["doc_id"] for _, ms in done + rest for m in ms) == list(range(9))


def test_documents_clustered_by_length_pack_as_tightly_as_mixed_ones(monkeypatch):
    """The long half first: each of its bins is underfull until the short half comes, more than any bound of pieces."""
    monkeypatch.setattr(packing, "BLOCK", 1000)
    monkeypatch.setattr(packing, "HANDED_UP", 400)
    r = random.Random(2)
    for a, b, c, d in ((1100, 1500, 500, 900), (700, 1000, 50, 300)):
        sizes = [r.randint(a, b) for _ in range(1000)] + [r.randint(c, d) for _ in range(1000)]
        parts = list(packing.residual(((n, [{"doc_id": i, "offset": 0}]) for i, n in enumerate(sizes)), 2048))
        rest = Counter(fill for done, bins in parts for fill, _ in bins if not done)
        used = sum(len(bins) for done, bins in parts if done) + len(bins_of(packing.best_fit_counts(rest, 2048)))
        assert sorted(m["doc_id"] for _, bins in parts for _, ms in bins for m in ms) == list(range(2000))
        assert used <= 1.035 * len(packing.best_fit(sizes, 2048))


def bins_of(plan):
    """The (offset, size, rank) in each bin of a plan."""
    bins: dict[int, list] = {}
    for size, first, n, at, offset in plan:
        for k in range(n):
            bins.setdefault(at + k, []).append((offset, size, first + k))
    return bins


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200))
def test_best_fit_by_counts_is_best_fit(sizes):
    counts = Counter(sizes)
    bins = bins_of(packing.best_fit_counts(counts, 50))
    assert sorted((s, k) for inside in bins.values() for _, s, k in inside) == sorted((s, k) for s, n in counts.items() for k in range(n))
    for inside in bins.values():
        end = 0
        for offset, size, _ in sorted(inside):
            assert offset == end
            end += size
        assert end <= 50
    assert sorted(sum(s for _, s, _ in inside) for inside in bins.values()) == sorted(sum(sizes[i] for i in b) for b in packing.best_fit(sizes, 50))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit(sizes):
    bins = packing.best_fit(sizes, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    fills = [sum(sizes[i] for i in b) for b in bins]
    assert all(f <= 50 for f in fills)
    assert sum(f <= 25 for f in fills) <= 1  # two half-empty bins would have been one


def test_smallest_scale_runs(spark):
    assert packing.op7_packing(spark, SF).count() >= 200
    assert LONG
