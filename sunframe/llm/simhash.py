"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints of a bucket are stored as vertical bit planes (plane p holds bit p of 64
fingerprints a word). Distances of many pairs are counted at once by carry-save adders over the
planes; a block of lanes is abandoned as soon as every lane exceeds the radius.

Buckets come from the pigeonhole principle: radius 4 spoils at most four of six bands, so any
linked pair agrees on two whole bands. Each distinct fingerprint is dealt to the 15 pairs of
bands (21 or 22 exact bits each), whatever the number of its copies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunframe.llm.common import ASCII_LOWER, fresh, map_texts, small, spread_join, table, text_column, written
from sunframe.llm.components import connected_components

RADIUS = 4
WIDTH = 4
SEED = 42
#: (offset, bits) of the six bands.
BANDS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
#: Fingerprints of one bucket that one block may hold; larger buckets are split into pairs of blocks.
BLOCK = 2048
#: Rows that a task gathers before it compares them.
_GATHER = 60_000
#: Stands for a null doc_id where rows are ordered.
_LAST_ID = (1 << 63) - 1
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; the whole sequence if it is shorter; none without words."""
    words = (text or "").encode().translate(ASCII_LOWER).split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n < width:
        return np.array([digest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - width + 1].tolist()
    return np.array([digest(joined[i:j], SEED) for i, j in zip(starts, ends[width - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """64 bits, each set if it is set in over half the shingle hashes; zero for a text without words."""
    hashes = shingle_hashes(text, width)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 32768):
        part = hashes[at : at + 32768]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprint_column(width: int):
    def make():
        def work(texts):
            prints = np.array([fingerprint(t, width) for t in texts], np.uint64)
            whole = np.array([SEED if t is None else xxhash.xxh64_intdigest(t.encode(), SEED) for t in texts], np.uint64)
            return [pa.array(prints.view(np.int64)), pa.array(whole.view(np.int64))]

        return work

    return make


def planes(values: np.ndarray) -> np.ndarray:
    """Vertical bit planes: row p holds bit p of every value, 64 values a word."""
    n = len(values)
    bits = np.unpackbits(np.ascontiguousarray(values).view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    lanes = np.zeros((64, (n + 63) // 64 * 64), np.uint8)
    lanes[:, :n] = bits.T
    return np.packbits(lanes, axis=1, bitorder="little").view(np.uint64)


def _csa(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: the sum bit and the carry bit of three bits in every lane."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def lanes_within(differences, shape: tuple[int, ...], valid: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Lanes whose distance is at most ``radius`` (under 64), as words, and the columns that these words stand for.

    ``differences(p, columns)`` gives the XOR of plane p for the columns still alive; ``valid`` has
    the lanes that count. Eight planes a step go through carry-save adders; columns of which every
    lane exceeds the radius are abandoned between steps.
    """
    columns = np.flatnonzero(valid.any(axis=0) if valid.ndim > 1 else valid)
    valid = valid[..., columns]
    ones = np.zeros(valid.shape, np.uint64)
    twos, fours, over = np.zeros_like(ones), np.zeros_like(ones), np.zeros_like(ones)
    higher = [np.zeros_like(ones) for _ in range(3, radius.bit_length())]  # eights and so on
    alive = valid
    for step in range(0, 64, 8):
        if not len(columns):
            break
        x = [differences(p, columns) for p in range(step, step + 8)]
        ones, a = _csa(ones, x[0], x[1])
        ones, b = _csa(ones, x[2], x[3])
        twos, f = _csa(twos, a, b)
        ones, a = _csa(ones, x[4], x[5])
        ones, b = _csa(ones, x[6], x[7])
        twos, g = _csa(twos, a, b)
        fours, e = _csa(fours, f, g)
        for i, plane in enumerate(higher):
            higher[i], e = plane ^ e, plane & e
        over = over | e
        alive = valid & ~(over | _greater([*higher[::-1], fours, twos, ones], radius))
        living = alive.any(axis=0) if alive.ndim > 1 else alive != 0
        if living.sum() < 0.75 * len(columns):
            columns = columns[living]
            valid, ones, twos, fours, over, alive, *higher = (v[..., living] for v in (valid, ones, twos, fours, over, alive, *higher))
    return alive, columns


def _greater(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is over ``radius``; the planes of the count come largest first."""
    more, same = np.zeros_like(counter[0]), np.full_like(counter[0], _ONES)
    for place, word in zip(range(len(counter) - 1, -1, -1), counter, strict=True):
        if radius >> place & 1:
            same = same & word
        else:
            more = more | (same & word)
            same = same & ~word
    return more


def _lane_indices(words: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Positions of set bits: (lane,) for one row of words, (row, lane) for several."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=-1, bitorder="little")
    at = np.nonzero(bits)
    return (*at[:-1], columns[at[-1] // 64] * 64 + at[-1] % 64)


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union by smallest root, for arrays of pairs; ``parent`` is flat before and after."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while not np.array_equal(up := parent[parent], parent):
            parent = up
    return parent


def _pack(mask: np.ndarray, width: int) -> np.ndarray:
    """A boolean a lane, as words."""
    lanes = np.zeros(width * 64, np.uint8)
    lanes[: len(mask)] = mask
    return np.packbits(lanes, bitorder="little").view(np.uint64)


def _shifted(vertical: np.ndarray, d: int, p: int, columns: np.ndarray) -> np.ndarray:
    """Plane p with every lane moved down by d."""
    row, skip, bit = vertical[p], d // 64, np.uint64(d % 64)
    low = np.take(row, np.minimum(columns + skip, len(row) - 1)) * (columns + skip < len(row))
    if not d % 64:
        return low
    high = np.take(row, np.minimum(columns + skip + 1, len(row) - 1)) * (columns + skip + 1 < len(row))
    return (low >> bit) | (high << (np.uint64(64) - bit))


def links(keys: np.ndarray, prints: np.ndarray, radius: int = RADIUS, small: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within ``radius`` that share a key; ``keys`` must be sorted.

    Keys with up to ``small`` rows are compared side by side, each lane with the lane d further on;
    larger ones a block of queries against all of the key's planes.
    """
    a, b = linked_rows(keys, prints, radius, small)
    return prints[a], prints[b]


def linked_rows(keys: np.ndarray, prints: np.ndarray, radius: int, small: int, sure: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``links`` as numbers of rows. With ``sure``, a pair within the radius links only if it says so.

    Rows that are linked already, directly or not, are not asked about. With ``sure``, rows of a large key that are
    linked with its first one are not compared with each other.
    """
    n = len(keys)
    parent = np.arange(n)
    if n < 2:
        return parent[:0], parent[:0]

    def joined(i, j):
        if sure is not None:
            apart = parent[i] != parent[j]
            i, j = i[apart], j[apart]
            good = sure(i, j)
            i, j = i[good], j[good]
        return _join(parent, i, j)

    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, n])
    is_small = np.repeat(sizes <= small, sizes)
    vertical = planes(prints)
    for d in range(1, small):
        valid = np.zeros(n, bool)
        valid[:-d] = (keys[d:] == keys[:-d]) & is_small[:-d]
        if not valid.any():
            break
        words, columns = lanes_within(lambda p, c, d=d: vertical[p, c] ^ _shifted(vertical, d, p, c), (), _pack(valid, vertical.shape[1]), radius)
        (lane,) = _lane_indices(words, columns)
        parent = joined(lane, lane + d)
    for start, size in zip(starts[sizes > small], sizes[sizes > small], strict=True):
        place, queries = np.arange(start, start + size), size
        if sure is not None:
            parent = joined(np.full(size - 1, start), place[1:])
            rest = parent[place] != parent[start]
            place, queries = np.r_[place[rest], place[~rest]], int(rest.sum())
        own = planes(prints[place])
        for at in range(0, queries, 64):
            q = prints[place[at : min(at + 64, queries)]]
            valid = np.zeros(own.shape[1] * 64, bool)
            valid[at:size] = True
            valid = np.repeat(_pack(valid, own.shape[1])[None, :], len(q), axis=0)
            bits = [np.where((q >> np.uint64(p)) & np.uint64(1), _ONES, np.uint64(0))[:, None] for p in range(64)]
            words, columns = lanes_within(lambda p, c, bits=bits, own=own: own[p, c][None, :] ^ bits[p], (), valid, radius)
            row, lane = _lane_indices(words, columns)
            parent = joined(place[at + row], place[lane])
    linked = np.flatnonzero(parent != np.arange(n))
    return linked, parent[linked]


def _link_rows(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(k, f):
            a, b = links(k, f.view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            rows += len(batch)
            if rows >= _GATHER:
                k, f = (np.concatenate(x) for x in zip(*held, strict=True))
                cut = int(np.searchsorted(k, k[-1], "left"))
                if cut:
                    yield out(k[:cut], f[:cut])
                held, rows = [(k[cut:], f[cut:])], len(k) - cut
        if held:
            yield out(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _band(offset: int, bits: int) -> Column:
    return F.shiftrightunsigned("fp", offset).bitwiseAND(F.lit((1 << bits) - 1))


def link_edges(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges ``a, b`` that connect all fingerprints (distinct longs ``fp``) linked at ``radius`` or fewer bits.

    A bucket over ``block`` fingerprints becomes pairs of blocks, each a group of its own, so no task
    holds a bucket whole and no pair is left out.
    """
    if radius > len(BANDS) - 2:
        raise ValueError(f"radius {radius} needs more bands: at most {len(BANDS) - 2} with {len(BANDS)}")
    keys = [
        F.lit(i).cast("long") * F.lit(1 << 22) + _band(*a) * F.lit(1 << b[1]) + _band(*b)
        for i, (a, b) in enumerate(combinations(BANDS, 2))
    ]
    dealt = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = written(dealt.groupBy("key").count().filter(F.col("count") > block).select(F.col("key").alias("hot"), F.ceil(F.col("count") / block).cast("int").alias("parts")), "simhash-hot")
    joined = dealt.join(sizes, dealt["key"] == sizes["hot"], "left")
    part = F.pmod(F.xxhash64("fp"), F.col("parts").cast("long")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.least(j, part).cast("long") * F.lit(1 << 31) + F.greatest(j, part))
    blocks = joined.select("key", "fp", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(pairs)).alias("pair"))
    group = F.xxhash64("key", "pair")
    ready = blocks.select(group.alias("key"), "fp").repartition("key").sortWithinPartitions("key")
    return ready.mapInArrow(_link_rows(radius), "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    Links join fingerprints at ``radius`` or fewer differing bits; a component is all that links
    reach. ``component_id`` is the smallest doc_id in it. Null and empty texts have fingerprint zero
    and link like any other; a null doc_id takes part but names no component (null only if no row of
    the component has an id). Repeated rows each stay. An empty table gives no rows.
    """
    rows, named = _components(docs, radius, width)
    return spread_join(rows, named, {"fp": "f"}, salt=F.xxhash64("doc_id", "text_hash")).select("doc_id", "fp", "component_id")


def _components(docs: DataFrame, radius: int, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, fp, text_hash), and for each distinct fingerprint ``f`` its ``root`` and ``component_id``."""
    rows = written(map_texts(docs, _fingerprint_column(width), "fp long, text_hash long"), "simhash-prints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    found = connected_components(link_edges(nodes.select("fp"), radius))
    linked = written(found.join(nodes, found["node"] == nodes["fp"]).select("fp", "root", "first_id"), "simhash-linked")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "r")
    named = linked.join(least, F.col("root") == F.col("r")).select(F.col("fp").alias("p"), "root", F.coalesce("component_id", "first_id").alias("component_id"))
    named = nodes.join(named, F.col("fp") == F.col("p"), "left").select(
        F.col("fp").alias("f"), F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first_id").alias("component_id")
    )
    return rows, written(named, "simhash-components")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Stage: one row of each component stays, with all its columns: the smallest doc_id (nulls last, ties by a hash of the text).

    Rows that repeat the kept row whole count as copies of it, so one of them stays. Null and empty
    texts form one group. Columns of any name pass through.
    """
    rows, named = _components(docs, radius)
    return keep_first(docs, spread_join(rows, named, {"fp": "f"}, salt=F.xxhash64("doc_id", "text_hash")))


def keep_first(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """The first row of ``docs`` of each ``root``; ``rooted`` has (doc_id, text_hash, root) of every row.

    Who goes is decided on ids and hashes. While those that go are few enough to broadcast, no text is
    moved but those of repeated rows; beyond that the texts are dealt by id and hash once.
    """
    keyed = rooted.select(F.coalesce("doc_id", F.lit(_LAST_ID)).alias("id"), F.col("text_hash").alias("hash"), "root")
    each = written(keyed.groupBy("id", "hash").agg(F.first("root").alias("root"), F.count(F.lit(1)).alias("n")), "keep-rows")
    first = each.groupBy("root").agg(F.min(F.struct("id", "hash")).alias("keep")).select("keep.id", "keep.hash")
    keep = written(first.select(F.col("id").alias("keep_id"), F.col("hash").alias("keep_hash")), "keep-first")
    same = (each["id"] == keep["keep_id"]) & (each["hash"] == keep["keep_hash"])
    marked = written(each.join(keep, same, "left").select("id", "hash", F.col("keep_id").isNotNull().alias("kept"), "n").filter("not kept or n > 1"), "keep-marked")
    key, whole = fresh("row_id", docs.columns), fresh("row_hash", docs.columns)
    rows = docs.withColumns({key: F.coalesce(docs["doc_id"].cast("long"), F.lit(_LAST_ID)), whole: F.xxhash64(text_column(docs))})

    def met(keys: DataFrame):
        return (rows[key] == keys["id"]) & (rows[whole] == keys["hash"])

    out = small(marked)
    if out is None:
        once = rows.dropDuplicates([key, whole])
        return once.join(keep, (once[key] == keep["keep_id"]) & (once[whole] == keep["keep_hash"]), "left_semi").drop(key, whole)
    alone = rows.join(out, met(out), "left_anti")
    repeated = marked.filter("kept")
    if not repeated.isEmpty():
        repeated = F.broadcast(repeated)
        alone = alone.unionByName(rows.join(repeated, met(repeated), "left_semi").dropDuplicates([key, whole]))
    return alone.drop(key, whole)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = near_duplicates(table(spark, sf_dir, "documents"))
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
