"""Near-duplicate texts: SimHash by bit-sliced comparison, as op1, widened to reach a Jaccard similarity and confirmed exactly.

Texts with the same set of five-word shingles are one node. Every node has several SimHash fingerprints of 64
bits, cut into bands; nodes that share a band are compared by op1's bit planes and carry-save counters at a
radius on the first fingerprint, then on the first ``WIDE`` together. Nodes that such pairs connect, directly or
not, are gathered once in a group, where pairs within the radius are compared by their whole sets.
Components are all that confirmed pairs reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunframe.llm.common import begin, give_back, map_texts, small, spread_join, written
from sunframe.llm.components import connected_components
from sunframe.llm.simhash import BLOCK, SEED, keep_first, linked_rows, shingle_hashes

WIDTH = 5
#: Least Jaccard similarity of a linked pair, in hundredths.
SIMILARITY = 80
#: Chance that a bit of the fingerprints differs at that similarity (sets of one size).
BIT_DIFFERS = acos(2 * SIMILARITY / (100 + SIMILARITY)) / pi
#: A pair at the similarity shares no band with this probability at most.
MISS = 1e-4
#: Nodes of a bucket on average, about; bits of a band follow from it and from the number of texts.
IN_BUCKET, LEAST_BITS, MOST_BITS = 64, 8, 32
#: Fingerprints of the second comparison, and the two radii: a pair at the similarity exceeds either with a chance of 4e-6 together.
WIDE, RADIUS, WIDE_RADIUS = 4, 24, 68
#: Rows of a key that are compared side by side, and rows that a task gathers before it compares them.
_SIDE_BY_SIDE, _GATHER = 256, 60_000
#: Shingles of one part of a group; larger groups are split into pairs of parts.
PART = 1_000_000
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def band_bits(texts: int) -> int:
    """Bits of a band: one more each time the number of texts doubles."""
    return min(MOST_BITS, max(LEAST_BITS, ceil(log2(max(1, texts) / IN_BUCKET))))


def fingerprints(bits: int) -> int:
    """Fingerprints whose bands of so many bits miss a pair at the similarity with probability ``MISS`` at most."""
    bands = log(MISS) / log(1 - (1 - BIT_DIFFERS) ** bits)
    return max(WIDE, ceil(bands / (64 // bits)))


def _mix(count: int) -> np.ndarray:
    """Constants of so many fingerprints; more of them begin alike."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, (count, 2), dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct hashes of the word shingles, ascending."""
    return np.unique(shingle_hashes(text, WIDTH))


def prints(shingles: np.ndarray, mix: np.ndarray) -> np.ndarray:
    """SimHash fingerprints of a set: bit b of the i-th is set if it is in over half of the i-th hashes of its shingles."""
    votes = np.zeros(64 * len(mix), np.int64)
    for at in range(0, len(shingles), 255):
        hashes = (shingles[at : at + 255, None] ^ mix[:, 0]) * mix[:, 1]
        hashes ^= hashes >> np.uint64(32)
        votes += np.add.reduce(np.unpackbits(hashes.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(2 * votes > len(shingles), bitorder="little").view(np.uint64)


def bands(shingles: np.ndarray, bits: int = 12) -> np.ndarray:
    """A key for each band, no two bands with the same; none for a text without words."""
    if not len(shingles):
        return np.empty(0, np.int64)
    own, each = prints(shingles, _mix(fingerprints(bits))), 64 // bits
    cut = (own[:, None] >> np.arange(0, each * bits, bits, dtype=np.uint64)) & np.uint64((1 << bits) - 1)
    return (np.arange(cut.size) << 32) + cut.ravel().astype(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two ascending sets reach the similarity, in whole numbers."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < SIMILARITY * len(b):
        return False
    both = int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a)) if len(b) else 0
    return 100 * both >= SIMILARITY * (len(a) + len(b) - both)


def _sketch(bits: int):
    def work(texts):
        mix = _mix(fingerprints(bits))
        nodes, whole, sizes, own = [], [], [], []
        for t in texts:
            shingles = shingle_set(t)
            nodes.append(xxhash.xxh64_intdigest(shingles.tobytes(), SEED))
            whole.append(SEED if t is None else xxhash.xxh64_intdigest(t.encode(), SEED))
            sizes.append(len(shingles))
            own.append(prints(shingles, mix).view(np.int64))
        hashes = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (nodes, whole)]
        return [*hashes, pa.array(sizes, pa.int64()), pa.array(own, pa.list_(pa.int64()))]

    return work


def _sets(batches):
    begin(__name__)
    for batch in batches:
        sets = pa.array([shingle_set(t).tobytes() for t in batch.column(batch.num_columns - 1).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sets], [*batch.schema.names[:-1], "shingles"])


def _confirm(group: pa.Table) -> pa.Table:
    """A spanning forest of the similar pairs within the wide radius: within a part, or between two."""
    nodes, part = group["node"].to_pylist(), group["part"].to_numpy()
    wide = np.array(group["wide"].to_pylist(), np.int64).view(np.uint64)
    sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
    size, label = np.array([len(s) for s in sets]), np.arange(len(nodes))
    across = len(set(group["pair"][0].as_py())) > 1
    edges = []
    for i in range(len(nodes)):
        later = slice(i + 1, None)
        near = label[later] != label[i]
        near &= 100 * np.minimum(size[later], size[i]) >= SIMILARITY * np.maximum(size[later], size[i])
        if across:
            near &= part[later] != part[i]
        at = np.flatnonzero(near) + i + 1
        for j in at[np.bitwise_count(wide[at] ^ wide[i]).sum(axis=1, dtype=np.int64) <= WIDE_RADIUS].tolist():
            if label[i] != label[j] and similar(sets[i], sets[j]):
                label[label == label[j]] = label[i]
                edges.append((nodes[i], nodes[j]))
    return pa.Table.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], schema=_EDGES)


def _link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of rows (key, node, wide fingerprints) sorted by key."""
    def out(key, node, *wide):
        wide = np.stack([w.view(np.uint64) for w in wide], axis=1)

        def sure(i, j):
            good = np.zeros(len(i), bool)
            for at in range(0, len(i), 100_000):
                some = slice(at, at + 100_000)
                good[some] = np.bitwise_count(wide[i[some]] ^ wide[j[some]]).sum(axis=1, dtype=np.int64) <= WIDE_RADIUS
            return good

        a, b = linked_rows(key, np.ascontiguousarray(wide[:, 0]), RADIUS, _SIDE_BY_SIDE, sure)
        return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], schema=_EDGES)

    held, rows = [], 0
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        rows += len(batch)
        if rows >= _GATHER:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            cut = int(np.searchsorted(columns[0], columns[0][-1], "left"))
            if cut:
                yield out(*(c[:cut] for c in columns))
            held, rows = [[c[cut:] for c in columns]], rows - cut
    if held:
        yield out(*(np.concatenate(c) for c in zip(*held, strict=True)))
    held.clear()
    give_back()


def candidates(nodes: DataFrame, bits: int) -> DataFrame:
    """Edges ``a, b`` that connect all ``node`` whose ``prints`` share a band of so many bits and are within both radii.

    A bucket over ``BLOCK`` nodes becomes pairs of blocks, each a group of its own, so no task holds a
    bucket whole and no pair is left out.
    """
    each = 64 // bits
    keys = [
        F.lit((i * each + j) << 32) + F.shiftrightunsigned(F.col("prints")[i], j * bits).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        for i in range(fingerprints(bits))
        for j in range(each)
    ]
    wide = [F.col("prints")[i].alias(f"w{i}") for i in range(WIDE)]
    dealt = nodes.filter("n > 0").select("node", *wide, F.explode(F.array(*keys)).alias("key"))
    sizes = dealt.groupBy("key").count().filter(F.col("count") > BLOCK)
    sizes = written(sizes.select(F.col("key").alias("hot"), F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")), "similar-hot")
    group, columns = F.col("key"), ["node", *(f"w{i}" for i in range(WIDE))]
    if not sizes.isEmpty():
        dealt = dealt.join(sizes, dealt["key"] == sizes["hot"], "left")
        part = F.pmod(F.xxhash64("node"), F.col("parts").cast("long")).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(j, part).cast("long") * F.lit(1 << 31) + F.greatest(j, part))
        dealt = dealt.select("key", *columns, F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(pairs)).alias("pair"))
        group = F.xxhash64("key", "pair")
    ready = dealt.select(group.alias("group"), *columns).repartition("group").sortWithinPartitions("group")
    return ready.mapInArrow(_link_rows, "a long, b long")


def _rows(docs: DataFrame, bits: int) -> DataFrame:
    """doc_id, node (a hash of the shingle set), text_hash, shingles in the set, fingerprints."""
    return written(map_texts(docs, lambda: _sketch(bits), "node long, text_hash long, n long, prints array<long>"), "similar-rows")


def similar_edges(docs: DataFrame, rows: DataFrame, bits: int) -> DataFrame:
    """Edges ``a, b`` that connect all nodes linked by a similarity that is reached, but for what the bands miss."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))).alias("first")
    nodes = written(rows.groupBy("node").agg(first, F.first("n").alias("n"), F.first("prints").alias("prints")), "similar-nodes")
    blobs = connected_components(candidates(nodes, bits))
    members = blobs.withColumnRenamed("node", "p").join(nodes, F.col("p") == nodes["node"]).select("root", "node", "n", F.slice("prints", 1, WIDE).alias("wide"), "first")
    members = written(members, "similar-members")
    large = members.groupBy("root").agg(F.ceil(F.sum("n") / PART).cast("int").alias("parts")).filter("parts > 1").withColumnRenamed("root", "large")
    sized = members.join(large, members["root"] == large["large"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    sized = sized.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts").cast("long")).cast("int"))
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    wanted = members.select("first.id", "first.hash")
    # While they are few enough to broadcast, only the texts of members are moved.
    wanted = small(wanted) or wanted
    texts = texts.withColumn("whole", F.xxhash64("text")).join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("whole") == F.col("hash")), "left_semi")
    texts = texts.dropDuplicates(["doc_id", "whole"])
    met = sized.join(texts, F.col("first.id").eqNullSafe(F.col("doc_id")) & (F.col("first.hash") == F.col("whole"))).select("root", "node", "wide", "part", "parts", "text")
    kinds = "root long, node long, wide array<long>, part int, parts int, shingles binary"
    sets = written(met.mapInArrow(_sets, kinds), "similar-sets")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.array(F.least(j, "part"), F.greatest(j, "part")))
    return sets.withColumn("pair", F.explode(pairs)).groupBy("root", "pair").applyInArrow(_confirm, "a long, b long")


def similar_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, node, text_hash), and the ``root`` of each node ``f`` that is linked to another."""
    bits = band_bits(docs.count())
    rows = _rows(docs, bits)
    found = connected_components(similar_edges(docs, rows, bits))
    return rows.select("doc_id", "node", "text_hash"), written(found.select(F.col("node").alias("f"), "root"), "similar-components")


def drop_similar(docs: DataFrame) -> DataFrame:
    """Stage: one row of each component stays, with all its columns: the smallest doc_id (nulls last, ties by a hash of the text).

    Rows that repeat the kept row whole count as copies of it, so one of them stays. Null and empty
    texts form one group. A text under five words is one shingle. Columns of any name pass through.
    """
    rows, named = similar_components(docs)
    met = spread_join(rows, named, {"node": "f"}, "left", salt=F.xxhash64("doc_id", "text_hash"))
    return keep_first(docs, met.withColumn("root", F.coalesce("root", "node")))
