"""Pre-tokenisation without regex: code point classes, and an associative scan of a small automaton.

The automaton reads one class at a time.  Reading a class is a function from states to states; functions compose, and
all compositions that can occur form a finite monoid, which is enumerated once.  The scan then works on element numbers:
the text is laid out as many columns of equal length, all columns advance by one composition at a time, the columns'
products are chained, and the state before each code point follows.  Tokens start where the automaton says so, at the
code point just read or at the one before it.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

from tidetable.llm.arrays import CODE_POINTS

# Classes of code points.  S: letters that end a contraction by themselves; R, V, L, E: letters of the longer ones.
OTHER, LETTER, NUMBER, SPACE, BLANK, QUOTE, S, R, V, L, E, BORDER = range(12)
CLASSES = 12
# States: before a document; in a run of letters, digits or others; after a first or a later white space, which is a
# space or not; after a quote that starts a token, with r, v or l behind it; after a whole contraction.
(FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, SPACE_ONE, SPACE_MORE, BLANK_ONE, BLANK_MORE, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, CONTRACTED) = range(13)
STATES = 13
HERE, BEFORE = 1, 2
# The white space of the pattern's \s.
WHITE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def _step(state: int, c: int) -> tuple[int, int]:
    """Next state, and where a token starts: HERE, BEFORE (at the code point read last), both or neither."""
    if c == BORDER:
        return FRESH, BEFORE if state in (QUOTED_R, QUOTED_V, QUOTED_L) else 0
    letter = c in (LETTER, S, R, V, L, E)
    white = c in (SPACE, BLANK)
    starts = 0
    if state == QUOTED:
        if c in (S, R, V, L):
            return {S: CONTRACTED, R: QUOTED_R, V: QUOTED_V, L: QUOTED_L}[c], 0
        state = IN_OTHERS
    elif state in (QUOTED_R, QUOTED_V, QUOTED_L):
        if c == (L if state == QUOTED_L else E):
            return CONTRACTED, 0
        starts, state = BEFORE, IN_LETTERS  # the quote stood alone
    in_white = state in (SPACE_ONE, SPACE_MORE, BLANK_ONE, BLANK_MORE)
    if white:
        if in_white:
            return SPACE_MORE if c == SPACE else BLANK_MORE, starts
        return SPACE_ONE if c == SPACE else BLANK_ONE, starts | HERE
    if state in (SPACE_MORE, BLANK_MORE):
        starts |= BEFORE  # the last white space leaves the run
    kind = IN_LETTERS if letter else IN_NUMBERS if c == NUMBER else IN_OTHERS
    if state in (SPACE_ONE, SPACE_MORE):
        return kind, starts  # a space belongs to what follows
    if c == QUOTE and state != IN_OTHERS:
        return QUOTED, starts | HERE
    return kind, starts | (HERE if state != kind else 0)


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """The class of every code point, from its general category."""
    table = np.zeros(CODE_POINTS, np.uint8)
    for c in range(CODE_POINTS):
        major = unicodedata.category(chr(c))[0]
        table[c] = LETTER if major == "L" else NUMBER if major == "N" else OTHER
    table[list(WHITE)] = BLANK
    table[0x20], table[0x27] = SPACE, QUOTE
    for letters, c in (("stmd", S), ("r", R), ("v", V), ("l", L), ("e", E)):
        for x in letters:
            table[ord(x)] = c
    return table


@lru_cache(maxsize=1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(element of each class, composition table, element x state -> state, state x class -> starts)."""
    steps = [[_step(s, c) for s in range(STATES)] for c in range(CLASSES)]
    letters = [tuple(t[0] for t in row) for row in steps]
    number = {tuple(range(STATES)): 0}
    elements = [tuple(range(STATES))]
    for f in elements:  # grows while it is read
        for g in letters:
            h = tuple(g[s] for s in f)  # f first, then g
            if h not in number:
                number[h] = len(elements)
                elements.append(h)
    functions = np.array(elements, np.uint8)
    n = len(elements)
    compose = np.empty((n, n), np.uint16)
    for i, f in enumerate(functions):
        compose[i] = [number[tuple(g[f])] for g in functions]
    emits = np.array([[steps[c][s][1] for c in range(CLASSES)] for s in range(STATES)], np.uint8)
    return np.array([number[x] for x in letters], np.uint16), compose.ravel(), functions, emits


def token_starts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the tokens of all documents start, in code points; ``offsets`` bounds the documents.

    Every non-empty document's start is among them.
    """
    rows = len(offsets) - 1
    of_class, compose, functions, emits = monoid()
    n = len(points) + rows
    classes = np.full(n + 1, BORDER, np.uint8)
    # one border before each document, and one after the last
    place = np.arange(len(points)) if rows == 1 else np.arange(len(points)) + np.repeat(np.arange(rows), np.diff(offsets))
    classes[place + 1] = class_table()[points]
    n = len(classes)
    width = max(64, int(n**0.5))
    columns = -(-n // width)
    padded = np.zeros(columns * width, np.intp)  # element 0 changes nothing
    padded[:n] = of_class[classes]
    lanes = np.ascontiguousarray(padded.reshape(columns, width).T)
    size = len(functions)
    scaled = compose.astype(np.intp) * size  # a product is kept as the start of its row in the table
    product = np.zeros(columns, np.intp)
    before = np.empty((width, columns), np.intp)
    for i in range(width):
        before[i] = product
        product = scaled.take(product + lanes[i])
    enter = np.empty(columns, np.intp)
    total = 0
    for j, p in enumerate((product // size).tolist()):
        enter[j] = total
        total = int(scaled[total + p])
    entered = functions.take(enter // size * STATES + FRESH)
    # before holds element * size: a table with that row length gives the state for each entry state
    wide = np.zeros((size, size), np.uint8)
    wide[:, :STATES] = functions
    state = wide.ravel().take(before + entered[None, :]).T.ravel()[:n]
    starts = emits.ravel().take(state.astype(np.intp) * CLASSES + classes)
    flags = (starts & HERE) != 0
    flags[:-1] |= (starts[1:] & BEFORE) != 0
    return np.flatnonzero(flags[place + 1])
