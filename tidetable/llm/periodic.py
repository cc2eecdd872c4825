"""Periodic runs of words: suffix automaton, last-occurrence paths, squares.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends; those of a least length
and a least exponent (length / period) are found.

Method.  The suffix automaton of a stretch gives the tree of its suffix links.  Its words are appended in turn; with word i
the path from the state of the prefix that ends there to the root is accessed as in a link-cut tree: the path falls into
segments of one colour, the place where their strings ended last, and all of it is then recoloured i.  A segment of colour
j whose longest string has L words says that the L words up to j and those up to i are alike and that no shorter distance
joins them.  Where i - j <= L that is a square of period i - j, which reaches L + i - j words back from i; where the next
word breaks the period, this is the whole run.  As all links are known before the first access, preferred paths need no
splay trees: each heavy path of the tree holds a stack of its segments, which an access pops and pushes; there are
O(n log n) of them.

Before that, texts are cut to the stretches where a run can be: every word triple of a run comes back in it, so triples
that are too rare end a stretch.  That is repeated in the stretches, keeps every run whole, and leaves plain prose empty.

Defined results: null, empty and blank texts have no words and no runs; repeated rows are rows of their own; columns that
are asked for pass through, whatever they are called.  A text is handled in one piece, and a stretch takes about 600 bytes
of memory for each of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidetable.llm.arrays import mix
from tidetable.llm.bpe import _replace, _with

#: Bytes of text whose words are held at once; a longer text is held alone.
CHUNK_BYTES = 1 << 21
_U = np.uint64
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


@dataclass(frozen=True)
class Rule:
    """Least words of a run, and its least exponent."""

    length: int = 6
    exponent: int = 4

    def least(self, period: int) -> int:
        return max(self.length, self.exponent * period)

    @property
    def gram(self) -> tuple[int, int]:
        """Words that are looked at together, and how often they occur at least in a run that holds them."""
        return (3, self.exponent - 1) if self.length > self.exponent else (1, self.exponent)


def suffix_automaton(words: list) -> tuple[list[int], list[int], list[int]]:
    """Longest string and suffix link of every state, the root first, and the state of every prefix."""
    length, link, following = [0], [-1], [{}]
    last, ends = 0, []
    for w in words:
        new, p = len(length), last
        length.append(length[last] + 1)
        link.append(0)
        following.append({})
        while p >= 0 and w not in following[p]:
            following[p][w] = new
            p = link[p]
        if p >= 0:
            q = following[p][w]
            if length[q] != length[p] + 1:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                following.append(dict(following[q]))
                link[q] = copy
                while p >= 0 and following[p].get(w) == q:
                    following[p][w] = copy
                    p = link[p]
                q = copy
            link[new] = q
        last = new
        ends.append(new)
    return length, link, ends


def heavy_heads(length: list[int], link: list[int]) -> list[int]:
    """The first state of the heavy path of every state of the link tree."""
    order = np.argsort(length, kind="stable").tolist()
    size, heavy, most = [1] * len(length), [0] * len(length), [0] * len(length)
    for v in reversed(order[1:]):
        p = link[v]
        size[p] += size[v]
        if size[v] > most[p]:
            most[p], heavy[p] = size[v], v
    head = list(range(len(length)))
    for v in order[1:]:
        if heavy[link[v]] == v:
            head[v] = head[link[v]]
    return head


def runs_of(words: list, rule: Rule) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``words``, by start and period."""
    length, link, ends = suffix_automaton(words)
    head = heavy_heads(length, link)
    paths: list[list[tuple[int, int]]] = [[] for _ in length]
    out = []
    for i, v in enumerate(ends):
        squares: dict[int, int] = {}
        while v > 0:
            top, reach = head[v], length[v]
            segments, longest = paths[top], 0  # (longest string, last end), the deepest first
            while segments and segments[-1][0] <= reach:
                longest, j = segments.pop()
                if i - j <= longest:
                    squares.setdefault(i - j, longest)  # one colour's deepest segment is met first
            # a segment that goes on below v is cut there
            if longest < reach and segments and i - segments[-1][1] <= reach:
                squares.setdefault(i - segments[-1][1], reach)
            segments.append((reach, i))
            v = link[top]
        for period, longest in squares.items():
            if longest + period >= rule.least(period) and (i + 1 == len(words) or words[i + 1] != words[i + 1 - period]):
                out.append((i + 1 - longest - period, longest + period, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def stretches(hashes: np.ndarray, offsets: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that can hold runs, in texts whose words lie between ``offsets``."""
    width, times = rule.gram
    n = len(hashes)
    first = np.arange(n - width + 1) if n >= width else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    first = first[owner[first] == owner[first + width - 1]]
    gram = np.zeros(len(first), _U)
    for k in range(width):
        gram = mix(gram * _U(0x9E3779B97F4A7C15) + hashes[first + k])
    part, parts = owner[first], len(offsets)
    while len(first):
        order = np.argsort(mix(gram + mix(part.astype(_U))), kind="stable")
        same = gram[order], part[order]
        border = np.flatnonzero(np.concatenate(([True], (same[0][1:] != same[0][:-1]) | (same[1][1:] != same[1][:-1]), [True])))
        often = np.empty(len(first), bool)
        often[order] = np.repeat(np.diff(border) >= times, np.diff(border))
        first, gram, part = first[often], gram[often], part[often]
        fresh = np.concatenate(([True], (first[1:] != first[:-1] + 1) | (part[1:] != part[:-1]))) if len(first) else np.zeros(0, bool)
        part = np.cumsum(fresh)
        # a stretch shorter than a run holds none
        long = (np.bincount(part, minlength=1) + width - 1 >= rule.length)[part] if len(part) else fresh
        first, gram, part = first[long], gram[long], part[long]
        if often.all() and long.all() and int(fresh.sum()) == parts:
            break
        parts = int(fresh.sum())
    begins = np.flatnonzero(np.diff(part, prepend=-1))
    stops = np.concatenate((begins[1:], [len(part)])).astype(np.int64) - 1
    return first[begins], first[stops] + width if len(begins) else first[begins]


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact exponent, then smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, with one space between."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    held, size, at = [], 0, 0
    for i, t in enumerate(texts):
        own = (t or "").encode()
        held.append(own.split())  # at the six ASCII white-space bytes
        size += len(own)
        if size >= CHUNK_BYTES:
            yield at, held
            held, size, at = [], 0, i + 1
    if held:
        yield at, held


def detecting(rule: Rule, keep: list[str], text: str = "text"):
    """A worker of ``mapInArrow``: the columns ``keep``, ``n_words``, ``runs`` and ``collapsed`` of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            for at, texts in _chunks(column.to_pylist()):
                words = [w for own in texts for w in own]
                offsets = np.concatenate(([0], np.cumsum([len(own) for own in texts]))).astype(np.int64)
                # hashes only cut the stretches; words are compared themselves
                hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(_U)
                found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                begins, stops = stretches(hashes, offsets, rule)
                for a, b, row in zip(begins.tolist(), stops.tolist(), (np.searchsorted(offsets, begins, side="right") - 1).tolist()):
                    shift = a - int(offsets[row])
                    found[row] += [(shift + start, length, period) for start, length, period in runs_of(words[a:b], rule)]
                columns = {
                    "n_words": pa.array(np.diff(offsets)),
                    "runs": pa.array([[dict(zip(RUN.names, r)) for r in own] for own in found], pa.list_(pa.struct([(c, pa.int64()) for c in RUN.names]))),
                    "collapsed": pa.array([collapsed(own, runs).decode() for own, runs in zip(texts, found)], pa.large_string()).cast(pa.string()),
                }
                yield _replace(batch.slice(at, len(texts)).select(keep), columns)

    return work


def find(df: DataFrame, rule: Rule = Rule(), keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row (all, if not given), its ``n_words``, ``runs`` by start and period, and its
    ``collapsed`` text, in which each run is left with its first period."""
    keep = list(df.columns) if keep is None else keep
    source = df.select(*dict.fromkeys([*keep, text]))
    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    return source.mapInArrow(detecting(rule, keep, text), _with(source.select(*keep), fields))
