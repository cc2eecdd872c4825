"""Byte-level BPE: encoding by an automaton scan and cached pair merging, decoding by retained offsets.

``encode`` adds the ids of every text and the byte offset of every token; ``decode`` turns them back into bytes.
Token borders come from ``scan.token_starts``, so no regex runs; each distinct slice is merged once per worker.

Defined results: null and empty texts have no ids and decode to nothing; equal rows get equal results; other columns
pass through, whatever their names, unless they are named like an output column, in which case the output replaces them.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidetable.llm.arrays import text_chunks
from tidetable.llm.scan import token_starts

#: Distinct slices that a worker remembers, and the longest one; beyond that it starts again.
CACHE_ENTRIES, CACHE_CHARS = 600_000, 64
_SHORT = 48
BatchMap = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in JSON vocabularies: printable ones for themselves, the rest from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ranks of byte strings, and the strings that a JSON vocabulary keeps whole inside texts."""

    def __init__(self, path: str):
        self.special: dict[str, int] = {}
        if path.endswith(".json"):
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            kind = (spec.get("pre_tokenizer") or {}).get("type")
            if kind != "ByteLevel" or spec.get("normalizer") is not None:
                raise ValueError(f"{path} is not a plain byte-level vocabulary")
            letters = _byte_letters()
            self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
            self.ranks = {bytes(letters[x] for x in k): v for k, v in spec["model"]["vocab"].items() if k not in self.special}
        else:
            with open(path, "rb") as f:
                self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.tokens = [b""] * (max([*self.ranks.values(), *self.special.values()]) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        for token, rank in self.special.items():
            self.tokens[rank] = token.encode()
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.longest = max(map(len, self.ranks))

    def merge(self, word: bytes) -> list[bytes]:
        """The tokens of one slice: the pair of lowest rank joins first, the leftmost of equals."""
        ranks = self.ranks
        if word in ranks:
            return [word]
        if len(word) > _SHORT:
            return self._merge_long(word)
        parts = [word[i : i + 1] for i in range(len(word))]
        none = len(self.tokens)
        pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return parts

    def _merge_long(self, word: bytes) -> list[bytes]:
        """The same in n log n steps, with a heap of pairs over a linked list."""
        ranks, n = self.ranks, len(word)
        end = list(range(1, n + 1))  # of the part that starts here; 0: no part starts here
        left = list(range(-1, n - 1))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, a, b, stop = heapq.heappop(heap)
            if end[a] != b or b >= n or end[b] != stop:
                continue  # one of the two has changed since
            end[a], end[b] = stop, 0
            if stop < n:
                left[stop] = a
                if (r := ranks.get(word[a : end[stop]])) is not None:
                    heapq.heappush(heap, (r, a, stop, end[stop]))
            if a and (r := ranks.get(word[left[a] : stop])) is not None:
                heapq.heappush(heap, (r, left[a], a, stop))
        out, i = [], 0
        while i < n:
            out.append(word[i : end[i]])
            i = end[i]
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Packed(dict):
    """Slice -> its ids as packed 32-bit numbers; merges what it has not seen."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab = vocab
        self.packed = {t: r.to_bytes(4, "little") for t, r in vocab.ranks.items()}

    def __missing__(self, word: str) -> bytes:
        packed = self.packed
        ids = b"".join([packed[t] for t in self.vocab.merge(word.encode())])
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=4)
def packed_cache(path: str) -> _Packed:
    return _Packed(vocabulary(path))


def slices(points: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The pre-tokens of a chunk, and where each document's begin among them (one entry more than documents)."""
    starts = token_starts(points, offsets)
    text = points.tobytes().decode("utf-32-le")
    ends = np.append(starts[1:], len(points)) if len(starts) else starts
    words = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    return words, np.searchsorted(starts, offsets)


@lru_cache(maxsize=4)
def _specials(special: tuple[str, ...]) -> re.Pattern:
    return re.compile("(" + "|".join(re.escape(s) for s in special) + ")")


def segments(text: str, vocab: Vocabulary) -> list[str]:
    """Plain segments and special strings in turn, without empty ones."""
    if not vocab.special or not any(s in text for s in vocab.special):
        return [text] if text else []
    return [p for p in _specials(tuple(vocab.special)).split(text) if p]


def text_ids(text: str, path: str) -> np.ndarray:
    """The ids of one text whose special strings stay whole."""
    vocab, cache, out = vocabulary(path), packed_cache(path), []
    for piece in segments(text, vocab):
        if piece in vocab.special:
            out.append(vocab.special[piece].to_bytes(4, "little"))
        else:
            points = np.frombuffer(piece.encode("utf-32-le"), np.uint32)
            out += [cache[w] for w in slices(points, np.array([0, len(points)]))[0]]
    return np.frombuffer(b"".join(out), "<u4")


def _replace(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *columns.values()], names=[*kept, *columns])


def _numbers(values: np.ndarray, bounds: np.ndarray, packed: bool) -> pa.Array:
    """Rows of 32-bit numbers, as lists or as little-endian binary."""
    if packed:
        limits = pa.py_buffer((bounds * 4).astype(np.int64).tobytes())
        data = pa.py_buffer(values.astype("<u4").tobytes())
        return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, limits, data]).cast(pa.binary())
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def _with(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    names = {f.name for f in fields}
    return T.StructType([*(f for f in df.schema.fields if f.name not in names), *fields])


def _number_type(packed: bool) -> T.DataType:
    return T.BinaryType() if packed else T.ArrayType(T.IntegerType())


def encoding(path: str, keep: list[str], text: str = "text", packed: bool = False) -> BatchMap:
    """What ``encode`` does to the batches of one task; such functions can be chained within a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, cache = vocabulary(path), packed_cache(path)
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            for a, b, points, offsets in text_chunks(column):
                words, first = slices(points, offsets)
                packs = [cache[w] for w in words]
                ids = np.frombuffer(b"".join(packs), "<u4")
                sizes = np.fromiter(map(len, packs), np.int64, len(packs)) // 4
                bounds = np.concatenate(([0], np.cumsum(sizes)))[first]
                ends = np.cumsum(vocab.lengths[ids])
                begins = ends - vocab.lengths[ids]
                own = np.concatenate((begins, [ends[-1] if len(ends) else 0]))[bounds]
                begins = begins - np.repeat(own[:-1], np.diff(bounds))
                part = batch.slice(a, b - a).select(keep)
                yield _replace(part, {"ids": _numbers(ids, bounds, packed), "offsets": _numbers(begins, bounds, packed)})

    return work


def encode(df: DataFrame, path: str, text: str = "text", packed: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) with ``ids`` and ``offsets``, the byte at which each token starts.

    Special strings of the vocabulary are ordinary text here.  ``packed`` gives binary columns of 32-bit numbers.
    """
    source = df.select(*dict.fromkeys([*(keep if keep is not None else df.columns), text]))
    rest = source if keep is None or text in keep else source.drop(text)
    work = encoding(path, rest.columns, text, packed)
    kind = _number_type(packed)
    return source.mapInArrow(work, _with(rest, [T.StructField("ids", kind), T.StructField("offsets", kind)]))


def unpack(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of lists or of packed binary, and the rows' bounds among them."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary()).fill_null(b"")
        bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        data = column.buffers()[2]
        values = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].view("<u4") if data is not None else np.zeros(0, "<u4")
        return values, (bounds - bounds[0]) // 4
    lengths = np.array([0 if v is None else v for v in column.value_lengths().to_pylist()], np.int64)
    return np.asarray(column.flatten()), np.concatenate(([0], np.cumsum(lengths)))


def decode_rows(vocab: Vocabulary, ids: np.ndarray, offsets: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The bytes of each row: one join over all tokens, cut where the last offset and its token end."""
    tokens = vocab.tokens
    whole = b"".join([tokens[i] for i in ids.tolist()])
    out, at = [], 0
    last = bounds[1:] - 1
    sizes = np.where(np.diff(bounds) > 0, offsets.take(last, mode="clip") + vocab.lengths[ids.take(last, mode="clip")], 0) if len(ids) else np.zeros(len(bounds) - 1, int)
    for size in sizes.tolist():
        out.append(whole[at : at + size])
        at += size
    return out


def decoding(path: str, output: str = "decoded") -> BatchMap:
    """What ``decode`` does to the batches of one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids, bounds = unpack(part.column(part.schema.names.index("ids")))
                offsets, _ = unpack(part.column(part.schema.names.index("offsets")))
                yield _replace(part, {output: pa.array(decode_rows(vocab, ids, offsets, bounds), pa.binary())})

    return work


def decode(df: DataFrame, path: str, output: str = "decoded") -> DataFrame:
    """``df``, which ``encode`` made, with the bytes of each row's ids in ``output``; null ids decode to nothing."""
    return df.mapInArrow(decoding(path, output), _with(df, [T.StructField(output, T.BinaryType())]))
