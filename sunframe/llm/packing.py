"""Best-fit packing by hierarchical residual packing.

Every partition packs its own pieces best-fit (longest first), emits bins that are nearly full and
hands up all others as items. Those of all partitions are packed at once by their sizes alone: the
driver packs the number of items of each size, at most one number a token of the capacity, and
every item finds its place by its size and its rank among the items of that size.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunframe.llm.common import begin, give_back, id_and_text, table, written
from sunframe.llm.encoding import default_tokenizer, encoder

CAPACITY = 2048
END_ID = 0
#: A bin with at least this share of the capacity is emitted where it arises.
NEARLY_FULL = 0.995
#: Kept for callers of ``pack``: there is one level above the partitions, whatever it says.
FAN = 8
#: New pieces that a partition packs at once, together with all its underfull bins so far.
BLOCK = 50_000
#: Bound of ``_settle`` alone, which ``pack`` no longer uses.
HANDED_UP = 20_000
#: Pieces of one Arrow batch.
_BATCH = 20_000

_MEMBER = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])
_BIN = pa.schema([("done", pa.bool_()), ("node", pa.int64()), ("bin", pa.int64()), ("fill", pa.int64()), ("members", pa.list_(_MEMBER))])
_DDL = "done boolean, node long, bin long, fill long, members array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>>"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest item first, each into the fullest bin that holds it; ties by item number."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            where = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[where].append(item)
        else:
            where, room = len(bins), capacity
            bins.append([item])
        by_room[room - size].append(where)
        rooms |= 1 << (room - size)
    return bins


def _repack(items: list[tuple[int, list[dict]]], capacity: int) -> list[tuple[int, list[dict]]]:
    """(fill, members) of the bins that best fit the items, which are (size, members) themselves."""
    out = []
    for group in best_fit([size for size, _ in items], capacity):
        fill, members = 0, []
        for i in group:
            size, own = items[i]
            members += [m | {"offset": m["offset"] + fill} for m in own]
            fill += size
        out.append((fill, members))
    return out


def _settle(bins: list[tuple[int, list[dict]]], capacity: int, last: bool) -> tuple[list, list]:
    """Bins to emit and bins to keep, the emptiest first while their pieces are not too many. ``pack`` keeps all."""
    full = NEARLY_FULL * capacity
    done = [b for b in bins if last or b[0] >= full]
    rest = sorted((b for b in bins if not last and b[0] < full), key=lambda b: b[0])
    room = bisect_right(list(accumulate(len(members) for _, members in rest)), HANDED_UP)
    return done + rest[room:], rest[:room]


def _batches(bins: list[tuple[int, list[dict]]], done: bool, node: int, first: int) -> Iterator[pa.RecordBatch]:
    """Rows of bins numbered from ``first``, in batches of bounded pieces."""
    at = 0
    while at < len(bins):
        end, pieces_in = at, 0
        while end < len(bins) and (end == at or pieces_in + len(bins[end][1]) <= _BATCH):
            pieces_in += len(bins[end][1])
            end += 1
        part, n = bins[at:end], end - at
        yield pa.RecordBatch.from_arrays(
            [pa.array([done] * n), pa.array([node] * n, pa.int64()), pa.array(range(first + at, first + end), pa.int64()), pa.array([b[0] for b in part], pa.int64()), pa.array([b[1] for b in part], pa.list_(_MEMBER))],
            schema=_BIN,
        )
        at = end


def pieces(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, crc32) of each piece of a document's ids: only longer ones are cut."""
    for at in range(0, len(ids), 4 * capacity):
        part = ids[at : at + 4 * capacity]
        yield at // 4, len(part) // 4, zlib.crc32(part)


def residual(items: Iterator[tuple[int, list[dict]]], capacity: int) -> Iterator[tuple[bool, list[tuple[int, list[dict]]]]]:
    """(done, bins): nearly full bins as they arise, at the end all underfull ones by fill, as not done."""
    held: list[tuple[int, list[dict]]] = []
    full, fresh = NEARLY_FULL * capacity, 0
    for item in items:
        held.append(item)
        fresh += 1
        if fresh >= BLOCK:
            bins = _repack(held, capacity)
            yield True, [b for b in bins if b[0] >= full]
            held, fresh = [b for b in bins if b[0] < full], 0
    bins = _repack(held, capacity)
    yield True, [b for b in bins if b[0] >= full]
    yield False, sorted((b for b in bins if b[0] < full), key=lambda b: b[0])


def best_fit_counts(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """``best_fit`` of many items, given the number of each size: (size, first rank, items, first bin, offset).

    Items of one size are alike and known by rank. Bins with the same contents stay one entry, so the
    work grows with the sizes and not with the items.
    """
    by_room: list[list[tuple[int, list[tuple[int, int]]]]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            fits = rooms >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                bins, inside = by_room[room].pop()
            else:
                room, bins, inside = capacity, left, []
            each = min(room // size, left)
            taken = min(bins, left // each)
            if fits and bins > taken:
                by_room[room].append((bins - taken, [(s, first + taken) for s, first in inside]))
            if fits and not by_room[room]:
                rooms &= ~(1 << room)
            by_room[room - each * size].append((taken, [*inside, *((size, rank + k * taken) for k in range(each))]))
            rooms |= 1 << (room - each * size)
            rank += each * taken
            left -= each * taken
    out, bin_ = [], 0
    for group in by_room:
        for bins, inside in group:
            offset = 0
            for size, first in inside:
                out.append((size, first, bins, bin_, offset))
                offset += size
            bin_ += bins
    return sorted(out)


def _leaf(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, end, count = TaskContext.get().partitionId(), end_id.to_bytes(4, "little"), 0

        begin(__name__)

        def items():
            for batch in batches:
                pa.default_memory_pool().release_unused()  # the texts cut in chunks take several times their size
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(path).encode(batch.column(1).to_pylist()), strict=True):
                    for k, (start, length, crc) in enumerate(pieces(ids + end, capacity)):
                        yield length, [{"doc_id": doc_id, "piece": k, "start": start, "length": length, "ids_crc32": crc, "offset": 0}]

        for done, bins in residual(items(), capacity):
            if done:
                yield from _batches(bins, True, node, count)
                count += len(bins)
            else:  # numbered anew for each fill
                for _, same in groupby(bins, key=lambda b: b[0]):
                    yield from _batches(list(same), False, node, 0)
        give_back()

    return run


def _place(plan: list[tuple[int, int, int, int, int]]):
    """For items (fill, rank, members): the bin, and the members with their offsets in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first, _, bin_, offset = np.array(plan, np.int64).reshape(-1, 5).T
        keys = (size << 44) + first
        for batch in batches:
            fill, rank = (batch.column(k).to_numpy() for k in (0, 1))
            at = np.searchsorted(keys, (fill << 44) + rank, "right") - 1
            arrays = [pa.array(bin_[at] + rank - first[at]), pa.array(offset[at]), batch.column(2)]
            yield pa.RecordBatch.from_arrays(arrays, ["bin", "shift", "members"])

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, fan: int = FAN) -> DataFrame:
    """One row a piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its ids and ``end_id``; null and empty texts are the end id alone. Documents over
    ``capacity`` tokens are cut into pieces of that many; no other is cut. Rows with null or repeated
    ids are packed like any other. An empty table gives no rows. ``fan`` changes nothing.
    """
    members = _DDL[_DDL.index("members") :]
    bins = written(id_and_text(docs).mapInArrow(_leaf(tokenizer or default_tokenizer(), end_id, capacity), _DDL), "packing-0")
    rest = bins.filter("not done")
    counts = written(rest.groupBy("fill", "node").agg(F.count(F.lit(1)).alias("items")), "packing-counts")
    plan = best_fit_counts({r["fill"]: r["items"] for r in counts.groupBy("fill").agg(F.sum("items").alias("items")).collect()}, capacity)
    earlier = F.sum("items").over(Window.partitionBy("fill").orderBy("node")) - F.col("items")
    ranked = rest.join(counts.select(F.col("fill").alias("f"), F.col("node").alias("n"), earlier.alias("earlier")), (F.col("fill") == F.col("f")) & (F.col("node") == F.col("n")))
    placed = ranked.select("fill", (F.col("earlier") + F.col("bin")).alias("rank"), "members").mapInArrow(_place(plan), f"bin long, shift long, {members}")
    name = F.shiftleft("node", 32) + F.col("bin")
    own = bins.filter("done").select(name.alias("sequence_id"), F.lit(0).cast("long").alias("shift"), "members")
    every = own.unionByName(placed.select((F.lit(1 << 58) + F.col("bin")).alias("sequence_id"), "shift", "members"))
    flat = every.select("sequence_id", "shift", F.explode("members").alias("m"))
    return flat.select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", (F.col("m.offset") + F.col("shift")).alias("offset"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
