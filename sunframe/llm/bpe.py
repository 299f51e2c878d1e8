"""BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a word exactly one token can end its encoding. The suffix-matching automaton
of the vocabulary lists the tokens that end at each position; the one whose pair with the last
token of the shorter prefix is compatible is stored, and back-pointers give the ids. No merge is
ever replayed on a text.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunframe.llm.common import map_texts, table
from sunframe.llm.encoding import CACHE_CHUNKS, ChunkCoder, default_tokenizer, drops_white_space

#: Moves the last symbol of a word to an alphabet of its own, as the end-of-word suffix does.
_END = 0x4000
_NEVER = 1 << 40
#: Pair tests a worker remembers before it starts afresh.
CACHE_PAIRS = 500_000
#: The tokenizer's split pattern on lower-case ASCII texts.
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
_PRINTABLE = re.compile(r"[!-~]*\Z")


class PrefixBPE(ChunkCoder):
    """Encoder and decoder of one vocabulary file with an end-of-word suffix and white space dropped."""

    def __init__(self, path: str) -> None:
        super().__init__()
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix")
        if model["type"] != "BPE" or not suffix or not drops_white_space(spec):
            raise ValueError(f"{path} is not a word BPE file with an end-of-word suffix")
        self._tokenizer = Tokenizer.from_file(path)
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.strings = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) + ")") if self._special else None
        self._left: dict[int, int] = {}
        self._right: dict[int, int] = {}
        self._rank: dict[int, int] = {}
        self._pair: dict[tuple[int, int], int] = {}
        made = {a + b for a, b in merges}
        text = {i: (t[: -len(suffix)][:-1] + chr(ord(t[: -len(suffix)][-1]) + _END) if t.endswith(suffix) and len(t) > len(suffix) else t) for t, i in vocab.items() if t not in made}
        for rank, (a, b) in enumerate(merges):
            t, a, b = vocab[a + b], vocab[a], vocab[b]
            self._pair[a, b] = rank
            self._left[t], self._right[t], self._rank[t] = a, b, rank
            text[t] = text[a] + text[b]
        self._right_spines: dict[int, list[tuple[int, int]]] = {}
        self._left_spines: dict[int, list[tuple[int, int]]] = {}
        self._fits: dict[int, bool] = {}
        # A token whose own string encodes to something else never appears.
        stands: dict[int, bool] = {}
        for t in sorted(text, key=lambda t: self._rank.get(t, -1)):
            a, b = self._left.get(t), self._right.get(t)
            stands[t] = a is None or stands[a] and stands[b] and not self._crossed(a, b, self._rank[t])
        self._length = {t: len(x) for t, x in text.items()}
        self._suffixes = ahocorasick.Automaton()
        for t, x in text.items():
            if stands[t]:
                self._suffixes.add_word(x, t)
        self._suffixes.make_automaton()
        self._words: dict[str, list[int]] = {}

    def _spine(self, t: int, known: dict, child: dict) -> list[tuple[int, int]]:
        """Symbols that stand at one end of a token while it forms, each with the rank of the merge that uses it up."""
        if t not in known:
            spine, used, x = [], _NEVER, t
            while x is not None:
                spine.append((x, used))
                used, x = self._rank.get(x, _NEVER), child.get(x)
            known[t] = spine
        return known[t]

    def _crossed(self, a: int, b: int, before: int = _NEVER) -> bool:
        """Whether a merge of rank under ``before`` would run across the border of two tokens.

        Of equal merges the left one comes first: a symbol left of the border that the same rank uses up
        is gone, one right of it is not.
        """
        pair = self._pair.get
        for x, x_used in self._spine(a, self._right_spines, self._right):
            for y, y_used in self._spine(b, self._left_spines, self._left):
                rank = pair((x, y))
                if rank is not None and rank < x_used and rank <= y_used and rank < before:
                    return True
        return False

    def fits(self, a: int, b: int) -> bool:
        """Whether token b can follow token a within a word."""
        key = a << 20 | b
        found = self._fits.get(key)
        if found is None:
            if len(self._fits) >= CACHE_PAIRS:
                self._fits.clear()
            found = self._fits[key] = not self._crossed(a, b)
        return found

    def word(self, symbols: str) -> list[int]:
        """Ids of one pre-token, given as its byte-level symbols."""
        n = len(symbols)
        marked = symbols[:-1] + chr(ord(symbols[-1]) + _END)
        last, length, fits = [-1] * (n + 1), self._length, self.fits
        for end, t in self._suffixes.iter(marked):
            if last[end + 1] < 0:
                start = end + 1 - length[t]
                if not start or last[start] >= 0 and fits(last[start], t):
                    last[end + 1] = t
        ids, at = [], n
        while at:
            ids.append(last[at])
            at -= length[last[at]]
        return ids[::-1]

    def _symbols(self, chunk: str) -> list[str]:
        """Pre-tokens of a space-free chunk without special tokens, in byte-level symbols."""
        if _PRINTABLE.match(chunk):
            return _ASCII_WORDS.findall(chunk.lower())
        normal = self._tokenizer.normalizer.normalize_str(chunk)
        return [w for w, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for part in self._split.split(chunk) if self._split and "<" in chunk else [chunk]:
            if part in self._special:
                ids.append(self._special[part])
                continue
            for w in self._symbols(part) if part else []:
                got = self._words.get(w)
                if got is None:
                    got = self.word(w)
                    if len(w) < 64:
                        self._words[w] = got
                ids += got
        return np.array(ids, "<u4").tobytes()

    def whole(self, texts: list[str]) -> list[bytes]:
        if len(self._words) > CACHE_CHUNKS:
            self._words.clear()
        return [self._chunk(t) for t in texts]

    def decode(self, ids: bytes) -> str:
        """The text that the library's decode gives with skip_special_tokens=False: tokens joined by spaces; unknown ids are left out."""
        strings = self.strings
        return " ".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist() if i in strings])


_CODECS: dict[str, PrefixBPE] = {}


def codec(path: str) -> PrefixBPE:
    if path not in _CODECS:
        _CODECS[path] = PrefixBPE(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text, however long; null and empty texts have no ids.

    Each row stands for itself, also with null or repeated ids; repeated rows each stay. Columns but
    ``doc_id`` and ``text`` do not matter. An empty table gives no rows.
    """
    path = tokenizer or default_tokenizer()

    def make():
        return lambda texts: [pa.array([np.frombuffer(x, "<i4") for x in codec(path).encode(texts)], pa.list_(pa.int32()))]

    return map_texts(docs, make, "ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null and empty ids decode to the empty text.

    Each row stands for itself, also with a null or repeated ``doc_id``; an empty table gives no rows.
    """
    path = tokenizer or default_tokenizer()

    def run(batches):
        for batch in batches:
            texts = [codec(path).decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: ids and the text decoded from them, of every whole text.

    Null and empty texts have no ids and both digests of nothing; long texts are encoded whole. Each row
    stands for itself, also with null or repeated ids; repeated rows each stay. Columns but ``doc_id`` and
    ``text`` do not matter. An empty table gives no rows.
    """
    path = tokenizer or default_tokenizer()

    def make():
        def work(texts):
            ids = codec(path).encode(texts)
            hexes = [hashlib.sha256(x).hexdigest() for x in ids]
            back = [hashlib.sha256(codec(path).decode(x).encode()).hexdigest() for x in ids]
            return [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(hexes), pa.array(back)]

        return work

    return map_texts(docs, make, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
