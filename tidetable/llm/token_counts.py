"""Token counts by prefix dynamic programming.

Within one pre-token, the encoding of a prefix is the encoding of a shorter prefix plus one last token: the token that
ends the prefix and can stand behind the shorter prefix's last token, which is one at most.  So the count of each prefix
follows from an earlier one, and the state (count, last token) of a prefix is stored once per worker for all words that
begin with it.  Over a text, the count at a prefix is the sum over the finished pre-tokens plus the state inside the open
one.  White space at the end of a prefix is one run, and an unfinished contraction is a quote and a letter.

Truncation and budgets are then look-ups: ``token_counts`` gives the longest prefix within a limit, and
``prefix_counts`` stores the count at every code point for ``tokens_at`` and ``longest_prefix``.

Defined results: null and empty texts have 0 bytes, 0 tokens and a prefix of 0; strings that the vocabulary keeps whole
count as one token where they are complete; repeated rows are counted alike; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidetable.llm.arrays import text_chunks
from tidetable.llm.bpe import CACHE_CHARS, CACHE_ENTRIES, Vocabulary, _replace, _with, segments, slices, vocabulary
from tidetable.llm.scan import WHITE

_WHITE = {chr(c) for c in WHITE}
#: A quote and the first letter of a two-letter contraction: two tokens until the second letter comes.
_OPEN = {b"'r", b"'v", b"'l"}


class PrefixStates:
    """Token count and last token of prefixes of pre-tokens, as one number: count * SPAN + id of the token."""

    SPAN = 1 << 24

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.states: dict[bytes, int] = {}
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.sizes: dict[tuple[int, int], int] = {}  # last token and next byte -> size of the token that ended last there

    def _follows(self, a: int, b: int) -> bool:
        """Whether token b can stand behind token a, that is, merging both together leaves them apart."""
        key = a * self.SPAN + b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= CACHE_ENTRIES:
                self.pairs.clear()
            x, y = self.vocab.tokens[a], self.vocab.tokens[b]
            found = self.pairs[key] = self.vocab.merge(x + y) == [x, y]
        return found

    def _alone(self, a: int) -> bool:
        found = self.alone.get(a)
        if found is None:
            found = self.alone[a] = self.vocab.merge(self.vocab.tokens[a]) == [self.vocab.tokens[a]]
        return found

    def of(self, word: bytes) -> list[int]:
        """The state of every prefix of ``word``, from one byte on."""
        ranks, states, longest, span, guesses = self.vocab.ranks, self.states, self.vocab.longest, self.SPAN, self.sizes
        if len(states) >= CACHE_ENTRIES:
            states.clear()
        out: list[int] = []
        for i in range(1, len(word) + 1):
            prefix = word[:i] if i <= CACHE_CHARS else None
            state = states.get(prefix) if prefix is not None else None
            if state is None:
                # one size at most fits, so the one that did last time is tried first
                key = (out[-1] % span if out else -1, word[i - 1])
                guess = guesses.get(key, 1)
                for size in (guess, *range(min(i, longest), 0, -1)):
                    t = ranks.get(word[i - size : i]) if size <= i else None
                    if t is None:
                        continue
                    if size == i:
                        if self._alone(t):
                            state = span + t
                            break
                    elif self._follows((before := out[i - size - 1]) % span, t):
                        state = before - before % span + span + t
                        break
                if state is None:
                    raise ValueError("the vocabulary lacks a byte")
                if len(guesses) >= CACHE_ENTRIES:
                    guesses.clear()
                guesses[key] = size
                if prefix is not None:
                    states[prefix] = state
            out.append(state)
        return out

    def count(self, word: bytes) -> int:
        return self.of(word)[-1] // self.SPAN

    def at_points(self, word: str) -> list[int]:
        """Token counts of the prefixes of a pre-token, by code point."""
        raw = word.encode()
        states = self.of(raw)
        ends = np.cumsum([len(c.encode()) for c in word]).tolist()
        counts = [states[e - 1] // self.SPAN for e in ends]
        if raw[:2] in _OPEN and len(raw) > 1:
            counts[1] = 2
        return counts


class _Counts(dict):
    """Pre-token -> its token count."""

    def __init__(self, states: PrefixStates):
        super().__init__()
        self.states = states

    def __missing__(self, word: str) -> int:
        count = self.states.count(word.encode())
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = count
        return count


@lru_cache(maxsize=4)
def counter(path: str) -> _Counts:
    return _Counts(PrefixStates(vocabulary(path)))


def _open_counts(states: PrefixStates, words: list[str], j: int) -> list[int]:
    """Counts of the prefixes of pre-token j on top of the ones before it.

    If a white-space token stands before a white-space token, a prefix that ends in the second has both as one run.
    """
    word = words[j]
    counts = states.at_points(word)
    if j and word[0] in _WHITE and words[j - 1][-1] in _WHITE:
        run = words[j - 1] + word[0]
        counts[0] = states.count(run.encode()) - states.count(words[j - 1].encode())
    return counts


def plain_prefix_counts(words: list[str], cache: _Counts) -> list[int]:
    """Exact token counts after 0, 1, 2, ... code points of a text without special strings."""
    out, base = [0], 0
    for j, word in enumerate(words):
        out += [base + c for c in _open_counts(cache.states, words, j)]
        base += cache[word]
    return out


def _words(text: str) -> list[str]:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return slices(points, np.array([0, len(points)]))[0]


def text_prefix_counts(text: str, path: str) -> list[int]:
    """Exact token counts after 0, 1, 2, ... code points; special strings count as one token once complete."""
    cache = counter(path)
    out, plain, base = [0], "", 0  # the plain segment that ends here, and the count before it
    for piece in segments(text, cache.states.vocab):
        if piece in cache.states.vocab.special:
            # until it is complete, its beginning is ordinary text behind the last segment
            tail = plain_prefix_counts(_words(plain + piece[:-1]), cache)
            done = out[-1] + 1
            out += [base + c for c in tail[len(plain) + 1 :]] + [done]
            plain, base = "", done
        else:
            plain, base = piece, out[-1]
            out += [base + c for c in plain_prefix_counts(_words(piece), cache)[1:]]
    return out


def _fit(words: list[str], totals: np.ndarray, limit: int, cache: _Counts) -> int:
    """Code points of the longest prefix with at most ``limit`` tokens; totals: counts after each pre-token.

    A prefix inside a pre-token has more tokens than the whole ones before it, so the first pre-token that passes the
    limit is the last that can hold the end.
    """
    j = int(np.searchsorted(totals, limit, side="right"))
    chars = sum(map(len, words[:j]))
    if j == len(words):
        return chars
    base = int(totals[j - 1]) if j else 0
    inside = [i + 1 for i, c in enumerate(_open_counts(cache.states, words, j)) if base + c <= limit]
    return chars + (inside[-1] if inside else 0)


def token_counts(df: DataFrame, path: str, limit: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) with ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fit_chars``.

    ``fit_chars`` is the length in code points of the longest prefix with at most ``limit`` tokens.
    """
    source = df.select(*dict.fromkeys([*(keep if keep is not None else df.columns), text]))
    rest = source if keep is None or text in keep else source.drop(text)
    names = rest.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = counter(path)
        special = cache.states.vocab.special
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            for a, b, points, offsets in text_chunks(column):
                words, first = slices(points, offsets)
                counts = np.fromiter((cache[w] for w in words), np.int64, len(words))
                sums = np.concatenate(([0], np.cumsum(counts)))
                n_tokens = sums[first[1:]] - sums[first[:-1]]
                fits = np.diff(offsets)
                for i in np.flatnonzero(n_tokens > limit).tolist():
                    own = slice(first[i], first[i + 1])
                    fits[i] = _fit(words[own], np.cumsum(counts[own]), limit, cache)
                own = column.slice(a, b - a).fill_null("")
                if special and any(s in t for s in special for t in own.to_pylist()):
                    for i, t in enumerate(own.to_pylist()):
                        if any(s in t for s in special):
                            at = text_prefix_counts(t, path)
                            n_tokens[i] = at[-1]
                            fits[i] = max(k for k, c in enumerate(at) if c <= limit)
                part = batch.slice(a, b - a).select(names)
                n_bytes = pa.compute.binary_length(own).cast(pa.int64())
                columns = {"n_bytes": n_bytes, "n_tokens": pa.array(n_tokens), "over_limit": pa.array(n_tokens > limit), "fit_chars": pa.array(fits)}
                yield _replace(part, columns)

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()), T.StructField("fit_chars", T.LongType())]
    return source.mapInArrow(work, _with(rest, fields))


def prefix_counts(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``prefix_tokens``: the token count after 0, 1, 2, ... code points of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            for i in range(batch.num_rows):
                own = column[i].as_py() or ""
                yield _replace(batch.slice(i, 1), {"prefix_tokens": pa.array([text_prefix_counts(own, path)], pa.list_(pa.int32()))})

    return df.mapInArrow(work, _with(df, [T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))]))


def tokens_at(stored: Column, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` code points, from what ``prefix_counts`` stored; null beyond the text."""
    return F.get(stored, F.lit(chars) if isinstance(chars, int) else chars)


def longest_prefix(stored: Column, budget: Column | int) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens; 0 for a budget of 0, null for null."""
    limit = F.lit(budget) if isinstance(budget, int) else budget
    return F.array_max(F.transform(stored, lambda c, i: F.when(c <= limit, i)))
