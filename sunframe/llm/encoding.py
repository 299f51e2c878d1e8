"""Token ids of whole texts by the tokenizers library, with a bounded cache of space-free chunks."""

from __future__ import annotations

import json
import os
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sunframe.llm.common import forgotten

#: Distinct chunks a worker remembers before it starts afresh: bounds its memory.
CACHE_CHUNKS = 500_000
#: Fixed value: the split pattern whose matches never hold white space, so that texts can be encoded by the chunk.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: A character that is one token, of which no other text makes a part; texts that hold it are encoded one by one.
MARK = "•"
#: A letter before punctuation that starts no contraction: always the end of a pre-token.
_WORD_END = r"([a-zß-öø-ÿ])([!-&(-/:-@\[-`{-~])"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def drops_white_space(spec: dict) -> bool:
    """Whether the ids of a text are those of its space-separated chunks, one after the other."""
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    added = [t["content"] for t in spec.get("added_tokens") or []]
    kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    return (
        first.get("pattern") == {"Regex": WORD_PATTERN}
        and first.get("behavior") == "Removed"
        and first.get("invert") is True
        and kinds == ["NFC", "Replace", "Lowercase"]
        and not any(" " in a for a in added)
        and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens") or [])
    )


def lowered(text: str) -> str:
    """The text in lower case where that cannot change its ids: Latin-1 has no marks that compose."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text.lower()


class ChunkCoder:
    """``encode(texts)``: for each text its ids as little-endian unsigned 32-bit integers; null counts as empty.

    Arrow cuts a batch of texts into space-free chunks, words apart from the punctuation after them, and
    numbers the distinct ones; ``whole`` encodes those that are not remembered. White space other than
    spaces, line feeds and tabs stays inside a chunk and is left to ``whole``. Texts with ``<|``, which
    special tokens hold, are neither lowered nor cut at punctuation.
    """

    def __init__(self) -> None:
        self._known: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not texts:
            return []
        plain = ["<|" not in t if t else True for t in texts]
        flat = [(lowered(t) if p else t).replace("\n", " ").replace("\t", " ") if t else "" for t, p in zip(texts, plain, strict=True)]
        array = pa.array(flat, pa.large_string())
        cut = pc.replace_substring_regex(array, _WORD_END, r"\1 \2")
        if not all(plain):
            cut = pc.if_else(pa.array(plain), cut, array)
        parts = pc.split_pattern(cut, " ")
        numbered = parts.values.dictionary_encode()
        chunks = numbered.dictionary.to_pylist()
        ids = pa.array(self._ids(chunks), pa.large_binary()).take(numbered.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[np.asarray(parts.offsets)].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[i:j]) for i, j in pairwise(ends)]

    def _ids(self, chunks: list[str]) -> list[bytes]:
        got = [b"" if c == "" else g for c, g in zip(chunks, map(self._known.get, chunks), strict=True)]
        new = [c for c, g in zip(chunks, got, strict=True) if g is None]
        if not new:
            return got
        if len(self._known) >= CACHE_CHUNKS and 2 * len(new) > len(chunks):  # other texts than those it has learnt from
            self._known.clear()
        found = dict(zip(new, self.whole(new), strict=True))
        if len(self._known) < CACHE_CHUNKS:  # once full, the frequent chunks, which came early, stay
            self._known.update((c, g) for c, g in found.items() if len(c) < 100)
        return [found[c] if g is None else g for c, g in zip(chunks, got, strict=True)]


class Encoder(ChunkCoder):
    """Ids by the tokenizers library.

    Truncation and padding of the file are off and no special tokens are added; special tokens'
    strings in a text become their ids, as the library does.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            self._by_chunk = drops_white_space(json.load(f))
        mark = self._tokenizer.encode(MARK, add_special_tokens=False).ids
        self._mark = mark[0] if self._by_chunk and len(mark) == 1 else None

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return super().encode(texts) if self._by_chunk else self.whole([t or "" for t in texts])

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, one call of the library a few hundred: a mark that none holds stands between them."""
        if self._mark is None or any(MARK in t for t in texts):
            got = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(x.ids, "<u4").tobytes() for x in got]
        between = f" {MARK} "
        lots = [between.join([*texts[i : i + 256], ""]) for i in range(0, len(texts), 256)]
        ids = np.concatenate([np.array(x.ids, "<u4") for x in self._tokenizer.encode_batch_fast(lots, add_special_tokens=False)])
        ends = np.flatnonzero(ids == self._mark)
        raw, starts = ids.tobytes(), np.concatenate([[0], ends[:-1] + 1]) * 4
        return [raw[i:j] for i, j in zip(starts.tolist(), (ends * 4).tolist(), strict=True)]


_ENCODERS: dict[str, Encoder] = {}
forgotten(_ENCODERS.clear)


def encoder(path: str) -> Encoder:
    """One encoder a worker process, kept from task to task of one operator."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
