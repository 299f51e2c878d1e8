from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from sunframe.llm import simhash
from tests.conftest import SF_LARGER
from tests.llm.edges import EXTRA, ROWS, edge_docs, no_docs


def brute_fingerprint(text: str | None) -> int:
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int], radius: int = 4) -> list[int]:
    """Index of the first member of each one's component."""
    parent = list(range(len(prints)))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    values = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius):
            a, b = sorted((top(i), top(i + 1 + int(j))))
            parent[b] = a
    return [top(i) for i in range(len(prints))]


def components_of(rows) -> list[int | None]:
    """Brute component ids for (doc_id, fingerprint) rows."""
    tops = brute_components([fp for _, fp in rows])
    least: dict[int, int] = {}
    for top, (doc_id, _) in zip(tops, rows, strict=True):
        if doc_id is not None:
            least[top] = min(doc_id, least.get(top, doc_id))
    return [least.get(t) for t in tops]


@pytest.mark.parametrize("text", [t for _, t, _ in ROWS] + ["a", "A b", "a b c d", "É É É É É", "Tab\tand\x0bfeed \x1c odd"])
def test_fingerprint_is_the_definition(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize(("groups", "seed"), [(400, 0), (30, 1), (2, 2), (1, 3)])
def test_links_connect_what_brute_force_connects(groups, seed):
    r = np.random.default_rng(seed)
    prints = np.repeat(r.integers(0, 1 << 63, 60, dtype=np.uint64), 25)
    for _ in range(4):
        prints = prints ^ (np.uint64(1) << r.integers(0, 64, len(prints)).astype(np.uint64)) * (r.random(len(prints)) < 0.6)
    prints = np.unique(prints)
    r.shuffle(prints)
    keys = np.sort(r.integers(0, groups, len(prints)))
    a, b = simhash.links(keys, prints)
    place = {int(v): i for i, v in enumerate(prints)}
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, y in zip(a, b, strict=True):
        i, j = sorted((top(place[int(x)]), top(place[int(y)])))
        parent[j] = i
    for k in np.unique(keys):
        rows = np.flatnonzero(keys == k)
        want = brute_components(prints[rows].tolist())
        got = [top(i) for i in rows]
        assert [[got.index(g)] for g in got] == [[want.index(w)] for w in want]


def test_every_radius_counts_exactly():
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 63, dtype=np.uint64)
    for distance in range(0, 8):
        other = base
        for bit in r.choice(64, distance, replace=False):
            other ^= np.uint64(1) << np.uint64(bit)
        for radius in range(0, 5):
            a, _ = simhash.links(np.zeros(2, np.int64), np.array([base, other], np.uint64), radius)
            assert len(a) == (distance <= radius)


def test_query_equals_brute_force_on_whole_documents(spark):
    got = {r["doc_id"]: r for r in simhash.op1_simhash(spark, SF_LARGER).collect()}
    docs = pq.read_table(f"{SF_LARGER}/documents.parquet").sort_by("doc_id").to_pydict()
    prints = [brute_fingerprint(t) for t in docs["text"]]
    want = components_of(list(zip(docs["doc_id"], prints, strict=True)))
    assert len(got) == len(prints)
    for doc_id, fp, component in zip(docs["doc_id"], prints, want, strict=True):
        assert (got[doc_id]["fingerprint"], got[doc_id]["component_id"]) == (f"{fp:016x}", component)
    assert len(set(want)) < len(want)


def test_large_bucket_is_cut_into_blocks_without_losing_links(spark):
    r = random.Random(1)
    base = r.getrandbits(63)
    prints = sorted({base ^ (1 << r.randrange(40)) ^ (1 << r.randrange(40)) ^ (1 << r.randrange(40)) for _ in range(900)})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = simhash.link_edges(df, block=50).collect()
    parent = {p: p for p in prints}

    def top(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for e in edges:
        x, y = sorted((top(e["a"]), top(e["b"])))
        parent[y] = x
    want = brute_components(prints)
    assert len({top(p) for p in prints}) == len(set(want))


def test_edge_rows(spark):
    got = simhash.near_duplicates(edge_docs(spark))
    rows = [(r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in got.collect()]
    assert len(rows) == len(ROWS)
    want = components_of([(i, fp) for i, fp, _ in rows])
    assert [c for _, _, c in rows] == want
    blank = {c for i, fp, c in rows if fp == 0}
    assert blank == {3}
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_stage_keeps_one_of_each_group_with_all_columns(spark):
    docs = edge_docs(spark)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    rows = kept.collect()
    ids = [r["doc_id"] for r in rows]
    assert sorted(i for i in ids if i is not None) == [-12, 1, 3, 6, 7, 8, 9, 10, 11, 9_007_199_254_740_993]
    assert ids.count(None) == 1
    assert all(r[c] == f"own {c}" for r in rows for c in EXTRA)
    assert simhash.drop_near_duplicates(no_docs(spark)).count() == 0


def test_radius_beyond_the_bands_is_refused(spark):
    with pytest.raises(ValueError, match="bands"):
        simhash.link_edges(spark.range(1).select(F.col("id").alias("fp")), radius=5)
