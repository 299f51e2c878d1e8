"""Token ids as files: a content-addressed store with recipes and Merkle manifests.

A rolling hash over the ids cuts every document's stream where its content says so, so equal
passages give equal chunks wherever they stand. The store keeps

* ``chunks``: ``hash`` (BLAKE2b, 16 bytes) and ``payload`` (ids, little-endian, 2 bytes each if the
  vocabulary allows, else 4), every distinct chunk once, in buckets by hash, whose number ``layout`` holds;
* ``recipes``: in ascending doc_id order, one row a document with the hashes of its chunks, the ids
  before it in its segment and the Merkle root of its chunks; after a segment's documents, a manifest
  row with their number, their ids and the Merkle root of their roots.

The files are Parquet, so any file system that Spark can write will do. Reading back verifies every
chunk against its hash, every document against its root and length, and every segment against its manifest.
As chunks lie in buckets by hash, recipes come to them: payloads move once, to their documents.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunframe.llm.common import HOT_KEYS, id_and_text, prepare, release, shared_path, table, written
from sunframe.llm.encoding import default_tokenizer, encoder

END_ID = 2
#: Ids of a chunk: at least, on average about (a power of two), at most.
LEAST, AVERAGE, MOST = 64, 256, 2048
#: Ids that the rolling hash sees; a power of two, at most LEAST.
WINDOW = 16
#: Chunk hashes that a task remembers as already handed on.
_SEEN = 500_000
#: Bytes of payloads that a bucket of chunks should hold at most; uses of a chunk that one task hands out at most.
BUCKET_BYTES, MOST_USES = 256 << 20, 10_000
#: Bytes of rebuilt ids in one batch, but for a longer document.
_OUT_BYTES = 16 << 20
_MIX, _STEP = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def chunk_ends(ids: np.ndarray, starts: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each document; ``starts`` are the documents' first positions, and the end of the last."""
    rolled = (ids.astype(np.uint32) + np.uint32(1)) * _MIX
    span, factor = 1, _STEP
    while span < WINDOW:
        ahead = np.zeros_like(rolled)
        ahead[span:] = rolled[:-span] if span < len(rolled) else 0
        rolled = rolled + factor * ahead
        with np.errstate(over="ignore"):
            span, factor = span * 2, factor * factor
    cuts = np.flatnonzero((rolled >> np.uint32(15)) % np.uint32(AVERAGE) == 0)
    bounds = np.searchsorted(cuts, starts).tolist()
    cuts, starts = cuts.tolist(), starts.tolist()
    out = []
    for i in range(len(starts) - 1):
        # The first LEAST ids of a document are never cut, so no window that counts reaches back over its start.
        at, end, ends = starts[i], starts[i + 1], []
        for cut in [*cuts[bounds[i] : bounds[i + 1]], end - 1]:
            while cut + 1 - at > MOST:
                at += MOST
                ends.append(at)
            if cut + 1 - at >= LEAST or cut + 1 == end > at:
                at = cut + 1
                ends.append(at)
        out.append(ends)
    return out


class Merkle:
    """Root of a growing list of leaves, in memory of the logarithm of its length."""

    def __init__(self, leaves: Iterable[bytes] = ()) -> None:
        self._peaks: list[tuple[int, bytes]] = []
        for leaf in leaves:
            self.add(leaf)

    def add(self, leaf: bytes) -> None:
        size, node = 1, blake2b(b"\0" + leaf, digest_size=16).digest()
        while self._peaks and self._peaks[-1][0] == size:
            node = blake2b(b"\1" + self._peaks.pop()[1] + node, digest_size=16).digest()
            size *= 2
        self._peaks.append((size, node))

    def root(self) -> bytes:
        node = b""
        for _, peak in reversed(self._peaks):
            node = blake2b(b"\1" + peak + node, digest_size=16).digest() if node else peak
        return node


def _cut_documents(path: str, end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, seen, tie = end_id.to_bytes(4, "little"), set(), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = [x + end for x in encoder(path).encode(batch.column(1).to_pylist())]
            starts = np.cumsum([0, *(len(x) // 4 for x in texts)])
            wide = np.frombuffer(b"".join(texts), "<u4")
            raw = memoryview(wide.astype(f"<u{width}").tobytes())
            recipes, fresh, payloads = [], [], []
            for first, ends in zip(starts[:-1].tolist(), chunk_ends(wide, starts), strict=True):
                hashes, new, data = [], [], []
                for last in ends:
                    payload = raw[first * width : last * width]
                    digest = blake2b(payload, digest_size=16).digest()
                    hashes.append(digest)
                    if digest not in seen:
                        seen.add(digest)
                        new.append(digest)
                        data.append(bytes(payload))
                    first = last
                recipes.append(hashes)
                fresh.append(new)
                payloads.append(data)
            if len(seen) > _SEEN:
                seen.clear()
            many = pa.list_(pa.binary())
            roots = [Merkle(h).root() for h in recipes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(starts)), pa.array(roots, pa.binary()), pa.array(recipes, many), pa.array(fresh, many), pa.array(payloads, many), pa.array(range(tie, tie + len(batch)), pa.int64())],
                ["doc_id", "n_tokens", "root", "hashes", "new", "payloads", "tie"],
            )
            tie += len(batch)

    return run


_RECIPE = pa.schema([("segment", pa.int32()), ("place", pa.int64()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("root", pa.binary()), ("hashes", pa.list_(pa.binary()))])
_RECIPE_DDL = "segment int, place long, doc_id long, before long, n_tokens long, root binary, hashes array<binary>"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the sorted recipes of a segment and close it with its manifest (``place`` -1, documents in ``before``)."""
    segment, place, before, tree = TaskContext.get().partitionId(), 0, 0, Merkle()
    for b in batches:
        n = len(b)
        sizes = b.column(1).to_numpy()
        for root in b.column(2).to_pylist():
            tree.add(root)
        starts = before + np.cumsum(sizes) - sizes
        yield pa.RecordBatch.from_arrays([pa.array([segment] * n, pa.int32()), pa.array(range(place, place + n), pa.int64()), b.column(0), pa.array(starts, pa.int64()), b.column(1), b.column(2), b.column(3)], schema=_RECIPE)
        place, before = place + n, before + int(sizes.sum())
    if place:
        yield pa.RecordBatch.from_pylist([{"segment": segment, "place": -1, "doc_id": None, "before": place, "n_tokens": before, "root": tree.root(), "hashes": []}], schema=_RECIPE)


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id`` and write the store to the folder ``path``, which must not exist.

    Null and empty texts are the end id alone. Null ids come first; rows with the same id are ordered by
    their content. An empty table gives a store without rows.
    """
    from tokenizers import Tokenizer

    tokenizer = tokenizer or default_tokenizer()
    width = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    ddl = "doc_id long, n_tokens long, root binary, hashes array<binary>, new array<binary>, payloads array<binary>, tie long"
    spark, staging = prepare(docs.sparkSession), shared_path(docs.sparkSession, "store-staged")
    id_and_text(docs).mapInArrow(_cut_documents(tokenizer, end_id, width), ddl).write.options(**_FILES).parquet(staging)
    staged = spark.read.schema(ddl).parquet(staging)
    ids = staged.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-ids * width // BUCKET_BYTES))
    each = staged.select(F.explode(F.arrays_zip("new", "payloads")).alias("c")).select(F.col("c.new").alias("hash"), F.col("c.payloads").alias("payload"))
    # Dealt as the buckets are, so that the rows that are once only need no second exchange and a bucket is one file.
    once = each.repartition(buckets, "hash").dropDuplicates(["hash"]).withColumn("width", F.lit(width))
    with _as_table(spark) as name:
        once.write.options(**_FILES).option("path", f"{path}/chunks").bucketBy(buckets, "hash").saveAsTable(name)
    spark.range(1).select(F.lit(buckets).cast("int").alias("buckets")).write.parquet(f"{path}/layout")
    # The tie cuts even a single doc_id that many rows share.
    order = ("doc_id", "root", "tie")
    ordered = staged.select("doc_id", "n_tokens", "root", "hashes", "tie").repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    ordered.mapInArrow(_segments, _RECIPE_DDL).write.options(**_FILES).parquet(f"{path}/recipes")
    release(spark, staging)


#: Compact files; payloads never repeat, so no dictionary.
_FILES = {"compression": "zstd", "parquet.enable.dictionary": "false"}
_CHUNK_DDL = "hash binary, payload binary, width int"


@contextmanager
def _as_table(spark: SparkSession) -> Iterator[str]:
    """A table name that is free; the catalogue forgets it afterwards, the files stay."""
    name = f"store_chunks_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"drop table if exists {name}")


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of a store; where ``layout`` is there they are known to lie in buckets by hash."""
    try:
        layout = spark.read.schema("buckets int").parquet(f"{path}/layout")
    except AnalysisException:
        return spark.read.schema(_CHUNK_DDL).parquet(f"{path}/chunks")
    with _as_table(spark) as name:
        spark.sql(f"create table {name} ({_CHUNK_DDL}) using parquet clustered by (hash) into {layout.first()[0]} buckets location '{path}/chunks'")
        return spark.table(name)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of ids and the CRC-32 of every chunk, which must match its hash."""
    for b in batches:
        sizes, crcs = [], []
        for digest, payload, width in zip(*(c.to_pylist() for c in b.columns), strict=True):
            _verify(digest, payload)
            sizes.append(len(payload) // width)
            crcs.append(zlib.crc32(payload if width == 4 else np.frombuffer(payload, "<u2").astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())], ["hash", "size", "crc"])


def _verify(digest: bytes, payload: bytes) -> None:
    if blake2b(payload, digest_size=16).digest() != digest:
        raise ValueError(f"chunk {digest.hex()} does not match its hash")


class _Shift:
    """CRC-32 of ``a + b`` from those of ``a`` and ``b``: the first is carried over the bytes of the second, a linear map by tables."""

    def __init__(self) -> None:
        self._tables: dict[int, list[list[int]]] = {}

    def join(self, first: int, second: int, size: int) -> int:
        t = self._tables.get(size)
        if t is None:
            zeros = bytes(size)
            empty = zlib.crc32(zeros)
            unit = [zlib.crc32(zeros, 1 << k) ^ empty for k in range(32)]
            t = [[0] * 256 for _ in range(4)]
            for k in range(4):
                for v in range(1, 256):
                    low = v & -v
                    t[k][v] = t[k][v ^ low] ^ unit[8 * k + low.bit_length() - 1]
            self._tables[size] = t
        return t[0][first & 255] ^ t[1][first >> 8 & 255] ^ t[2][first >> 16 & 255] ^ t[3][first >> 24] ^ second


_SHIFT = _Shift()


def _documents(digest_only: bool):
    """Rebuild documents from their sorted chunks: their ids, or the length and CRC-32 of these. A document's first row holds its ``head``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, row, crc, count, tree, parts = None, None, 0, 0, Merkle(), []
        shift = _SHIFT.join

        def done():
            ids = b""
            if not digest_only:
                ids = b"".join(parts) if width == 4 else np.frombuffer(b"".join(parts), "<u2").astype("<u4").tobytes()
            if (count if digest_only else len(ids) // 4) != row["n_tokens"] or tree.root() != row["root"]:
                raise ValueError(f"document {row['doc_id']} does not match its recipe")
            return {"doc_id": row["doc_id"], "start": row["start"], "n_tokens": row["n_tokens"]} | ({"ids_crc32": crc} if digest_only else {"ids": ids})

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()) if digest_only else ("ids", pa.binary())])
        for b in batches:
            out, held = [], 0
            numbers = b.column(0).to_numpy()
            firsts = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]) if len(numbers) else np.zeros(0, np.int64)
            heads = b.column(1).take(pa.array(firsts)).to_pylist()
            digests, whats, extras = (b.column(k).to_pylist() for k in (2, 3, 4))
            for head, i, j in zip(heads, firsts.tolist(), [*firsts[1:].tolist(), len(numbers)], strict=True):
                if numbers[i] != key:
                    if row:
                        out.append(done())
                        held += len(out[-1].get("ids", b""))
                        if held > _OUT_BYTES:
                            yield pa.RecordBatch.from_pylist(out, schema=schema)
                            out, held = [], 0
                    key, row, crc, count, tree, parts = numbers[i], head, 0, 0, Merkle(), []
                for digest, what, extra in zip(digests[i:j], whats[i:j], extras[i:j], strict=True):
                    if what is None:
                        raise ValueError(f"chunk {digest.hex()} of document {row['doc_id']} is missing")
                    tree.add(digest)
                    if digest_only:
                        crc = shift(crc, extra, 4 * what)
                        count += what
                    else:
                        _verify(digest, what)
                        parts.append(what)
                        width = extra
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if row:
            yield pa.RecordBatch.from_pylist([done()], schema=schema)

    return run


def _check_segments(recipes: DataFrame) -> None:
    """Every segment's documents against its manifest; a missing or altered one raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree, count, ids, wrong = None, Merkle(), 0, 0, []
        closed: set = set()
        for b in batches:
            for segment, place, n, root, before in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if segment != key:
                    if key is not None and key not in closed:
                        wrong.append(key)
                    key, tree, count, ids = segment, Merkle(), 0, 0
                if place < 0:
                    closed.add(segment)
                    if (count, ids, tree.root()) != (before, n, root):
                        wrong.append(segment)
                elif place == count:
                    tree.add(root)
                    count, ids = count + 1, ids + n
        if key is not None and key not in closed:
            wrong.append(key)
        yield pa.RecordBatch.from_arrays([pa.array(wrong, pa.int32())], ["segment"])

    last = F.when(F.col("place") < 0, F.lit((1 << 63) - 1)).otherwise(F.col("place"))
    rows = recipes.repartition("segment").sortWithinPartitions("segment", last).select("segment", "place", "n_tokens", "root", "before")
    wrong = rows.mapInArrow(run, "segment int").limit(10).collect()
    if wrong:
        raise ValueError(f"segments {sorted(r['segment'] for r in wrong)} do not match their manifests")


def read_store(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit) of every document, verified; ``start`` counts the ids before it.

    ``digest_only`` gives ``ids_crc32`` in place of ``ids``: chunks are read, verified and summed where they
    lie, and a document's sum is joined from those of its chunks, so no ids are moved. Uses of a chunk
    that very many documents share are dealt to several copies of it.
    """
    recipes = prepare(spark).read.schema(_RECIPE_DDL).parquet(f"{path}/recipes")
    _check_segments(recipes)
    manifest = recipes.filter("place < 0").select(F.col("segment").alias("s"), "n_tokens")
    # One row a segment: the window is as long as the list of files.
    ahead = F.coalesce(F.sum("n_tokens").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = manifest.select("s", ahead.alias("ahead"))
    rows = recipes.filter("place >= 0").join(F.broadcast(offsets), F.col("segment") == F.col("s"))
    number = F.shiftleft(F.col("segment").cast("long"), 40) + F.col("place")
    # The document's own row goes with its first chunk alone.
    head = F.struct("doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "root")
    uses = rows.select(number.alias("number"), head.alias("head"), F.posexplode("hashes").alias("at", "digest"))
    uses = uses.withColumn("head", F.when(F.col("at") == 0, F.col("head")))
    held = ("size", "crc") if digest_only else ("payload", "width")
    chunks = _chunks(spark, path).select("hash", "payload", "width")
    if digest_only:
        chunks = chunks.mapInArrow(_sums, "hash binary, size long, crc long")
    total = recipes.agg(F.sum(F.size("hashes"))).first()[0] or 0
    most = max(MOST_USES, total // HOT_KEYS)
    hot = recipes.select(F.explode("hashes").alias("hot")).groupBy("hot").count().filter(F.col("count") > most)
    hot = written(hot.select("hot", F.ceil(F.col("count") / most).cast("int").alias("parts")), "store-hot")
    if hot.isEmpty():
        joined = uses.join(chunks, uses["digest"] == chunks["hash"], "left")
    else:
        hot = F.broadcast(hot)  # at most HOT_KEYS rows
        marked = uses.join(hot, uses["digest"] == hot["hot"], "left")
        cold, warm = marked.filter("parts is null").select(*uses.columns), marked.filter("parts is not null").select(*uses.columns, F.pmod("number", "parts").cast("int").alias("part"))
        copies = chunks.join(hot, chunks["hash"] == hot["hot"]).select(*chunks.columns, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("copy"))
        met = warm.join(copies, (warm["digest"] == copies["hash"]) & (warm["part"] == copies["copy"]), "left").drop("part", "copy")
        joined = cold.join(chunks, cold["digest"] == chunks["hash"], "left").unionByName(met)
    ready = joined.select("number", "head", "digest", *held, "at").repartition("number").sortWithinPartitions("number", "at").drop("at")
    last = "ids_crc32 long" if digest_only else "ids binary"
    return ready.mapInArrow(_documents(digest_only), f"doc_id long, start long, n_tokens long, {last}")


def op2_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the store, read it back and sum the ids that were rebuilt from its chunks."""
    path = shared_path(spark, "store")
    write_store(table(spark, sf_dir, "documents"), path)
    return read_store(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
