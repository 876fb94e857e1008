"""Benchmark decontamination by the q-gram lemma: count, filter, verify.

An item of m characters that occurs in a document with at most k edits shares at least m - q + 1 - k q of its q-grams
with the place where it occurs, and their diagonals (document position minus item position) differ by at most k.  The
benchmark's q-grams are indexed; each document's hits are counted per item in diagonal bands that overlap by k, so that
every occurrence lies in one band as a whole; bands that reach the lemma's bound are verified by a banded alignment.
Nothing that has at most k edits is missed, and nothing with more is reported.

k is ``rate`` times the item's length, or less where the bound would not be positive.  Characters are code points with
A-Z in lower case.  Items of fewer than ``min_chars`` characters match without edits (k = 0) and as whole words only: no
letter or digit may go on before or behind them, but for scripts from U+2E80 on, which are written without spaces.  Where
an item is shorter than q its q-gram is the item itself.  Items of fewer than ``min_exact`` characters are no evidence by
definition and match nothing.

The benchmark is the stated query set: it is read in blocks of at most ``BLOCK_CHARS`` characters, each block's index is
broadcast, and documents are never shuffled.

Defined cases: null and empty texts match nothing on either side; ids, null or repeated, are passed through; equal items
are reported each; texts of any length are searched whole.  Of overlapping places of one item, that with the fewest edits,
then the leftmost, is reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chars
from tidemark.llm.common import bound_batches

Q = 8
RATE = 0.1
MIN_CHARS = 24
MIN_EXACT = 3
NO_SPACES = 0x2E80
BLOCK_CHARS = 4_000_000
FILTER_BITS = 22
MATCHES = "array<struct<item_id:bigint,begin:bigint,end:bigint,edits:int>>"


@dataclass
class Index:
    item_ids: list[int | None]
    items: list[np.ndarray]
    budget: np.ndarray
    step: np.ndarray  # bands begin at multiples of it and reach ``budget`` beyond the next
    needed: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    item_of: np.ndarray
    at: np.ndarray
    present: np.ndarray
    exact: np.ndarray  # items that have to be whole words
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # per length below Q: keys in order and their items


def build(
    rows: list[tuple[int | None, str | None]], rate: float = RATE, min_chars: int = MIN_CHARS, min_exact: int = MIN_EXACT
) -> Index:
    least = max(1, min(min_chars, min_exact))
    kept = [(i, chars.ascii_lower(chars.code_points(t))) for i, t in rows if t and len(t) >= least]
    items = [t for _, t in kept]
    length = np.array([len(t) for t in items], np.int64)
    exact = length < max(min_chars, Q)
    budget = np.where(exact, 0, np.minimum((length * rate).astype(np.int64), (length - Q) // Q))
    step = np.array([1 << int(k).bit_length() for k in budget], np.int64)
    keys = [chars.grams(chars.fold(t), Q) for t in items]
    flat = np.concatenate([*keys, np.empty(0, np.uint64)])
    item_of = np.repeat(np.arange(len(items)), [len(k) for k in keys]) if items else np.empty(0, np.int64)
    at = np.concatenate([np.arange(len(k)) for k in keys] + [np.empty(0, np.int64)]).astype(np.int64)
    order = np.argsort(flat, kind="stable")
    unique, first = np.unique(flat[order], return_index=True)
    present = np.zeros(1 << FILTER_BITS, bool)
    present[chars.slots(unique, FILTER_BITS)] = True
    short = {}
    for m in {int(n) for n in length if n < Q}:
        of = np.flatnonzero(length == m)
        own = np.array([chars.grams(chars.fold(items[i]), m)[0] for i in of], np.uint64)
        sort = np.argsort(own, kind="stable")
        short[m] = own[sort], of[sort]
    return Index(
        [i for i, _ in kept], items, budget, step, length - Q + 1 - budget * Q, unique, np.append(first, len(flat)),
        item_of[order], at[order], present, exact, short,
    )


def bands(points: np.ndarray, index: Index) -> list[tuple[int, int]]:
    """(item, first diagonal) of the bands with as many shared q-grams as an occurrence needs."""
    found = chars.grams(chars.fold(points), Q)
    where = np.flatnonzero(index.present[chars.slots(found, FILTER_BITS)])
    if not len(where):
        return []
    key = np.searchsorted(index.keys, found[where])
    right = (key < len(index.keys)) & (index.keys[np.minimum(key, len(index.keys) - 1)] == found[where])
    where, key = where[right], key[right]
    many = index.first[key + 1] - index.first[key]
    posting = np.repeat(index.first[key] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
    item = index.item_of[posting]
    diagonal = np.repeat(where, many) - index.at[posting]
    step = index.step[item]
    band = diagonal // step
    overlap = diagonal - band * step < index.budget[item]  # also within the reach of the band before
    item, band = np.append(item, item[overlap]), np.append(band, band[overlap] - 1)
    shift = np.int64(1) << 40
    code, n = np.unique(item * shift + (band + (shift >> 1)), return_counts=True)
    item, band = code // shift, code % shift - (shift >> 1)
    enough = n >= index.needed[item]
    return [(int(i), int(b * index.step[i])) for i, b in zip(item[enough], band[enough])]


def short_bands(folded: np.ndarray, index: Index) -> list[tuple[int, int]]:
    """(item, position) of the places whose q-gram is an item's, for items shorter than ``Q``."""
    hits = []
    for m, (keys, of) in index.short.items():
        found = chars.grams(folded, m)
        low = np.searchsorted(keys, found)
        where = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == found)  # beyond the last key nothing is equal
        for at in where.tolist():
            n = int(low[at])
            while n < len(keys) and keys[n] == found[at]:
                hits.append((int(of[n]), at))
                n += 1
    return hits


def whole_words(points: np.ndarray, begin: int, end: int) -> bool:
    """No letter or digit on one side of an end of the stretch goes on on the other."""

    def goes_on(left: int, right: int) -> bool:
        return all(int(c) < NO_SPACES and chr(int(c)).isalnum() for c in points[left : right + 1])

    return not (begin > 0 and goes_on(begin - 1, begin)) and not (end < len(points) and goes_on(end - 1, end))


def align(item: np.ndarray, points: np.ndarray, diagonal: int, width: int, budget: int) -> tuple[int, int] | None:
    """(edits, end) of the best occurrence of ``item`` whose path stays on ``width`` diagonals from ``diagonal`` on.

    Unit-cost alignment of the whole item against any stretch; of equal costs the leftmost end.
    """
    far = budget + 1
    steps = np.arange(width)
    padded = np.concatenate([
        np.full(max(0, -diagonal), 0xFFFFFFFF, np.uint32), points[max(0, diagonal) : diagonal + len(item) + width],
        np.full(len(item) + width, 0xFFFFFFFF, np.uint32),
    ])
    position = diagonal + steps
    cost = np.where((position >= 0) & (position <= len(points)), 0, far)
    for i, c in enumerate(item):
        moved = cost + (padded[i : i + width] != c)
        moved[:-1] = np.minimum(moved[:-1], cost[1:] + 1)  # the item's character is missing in the document
        moved = np.minimum.accumulate(moved - steps) + steps  # characters that only the document has
        position = diagonal + i + 1 + steps
        moved[(position < 0) | (position > len(points))] = far
        cost = np.minimum(moved, far)
        if cost.min() >= far:
            return None
    best = int(cost.argmin())
    return int(cost[best]), diagonal + len(item) + best


def occurrences(text: str | None, index: Index) -> list[tuple[int | None, int, int, int]]:
    """(item_id, begin, end, edits) of all places, overlapping places of one item reduced to the best."""
    if not text or not index.items:
        return []
    points = chars.ascii_lower(chars.code_points(text))
    places: dict[int, list[tuple[int, int, int]]] = {}
    for i, begin in short_bands(chars.fold(points), index) if index.short else ():
        end = begin + len(index.items[i])
        if np.array_equal(points[begin:end], index.items[i]) and whole_words(points, begin, end):
            places.setdefault(i, []).append((0, begin, end))
    for i, diagonal in bands(points, index):
        item, k = index.items[i], int(index.budget[i])
        if index.exact[i]:
            end = diagonal + len(item)
            if diagonal >= 0 and np.array_equal(points[diagonal:end], item) and whole_words(points, diagonal, end):
                places.setdefault(i, []).append((0, diagonal, end))
            continue
        # A path may stray by k from any diagonal of the band on which it begins.
        first, width = diagonal - k, int(index.step[i]) + 3 * k + 1
        low = max(0, first)
        part, whole = points[low : first + width + len(item)].tobytes(), item.tobytes()
        at = part.find(whole)
        while at > 0 and at % 4:  # between two characters
            at = part.find(whole, at + 1)
        if at >= 0:
            places.setdefault(i, []).append((0, low + at // 4, low + at // 4 + len(item)))
            continue
        hit = align(item, points, first, width, k)
        if hit and hit[0] <= k:
            edits, end = hit
            places.setdefault(i, []).append((edits, _begin(item, points, end, edits, k), end))
    found = []
    for i, many in places.items():
        chosen: list[tuple[int, int, int]] = []
        for place in sorted(set(many)):
            if all(place[2] <= b or place[1] >= e for _, b, e in chosen):
                chosen.append(place)
        found += [(index.item_ids[i], b, e, n) for n, b, e in sorted(chosen, key=lambda p: p[1])]
    return sorted(found, key=lambda m: (m[1], m[2], m[0] is None, m[0]))


def _begin(item: np.ndarray, points: np.ndarray, end: int, edits: int, k: int) -> int:
    """The rightmost begin with ``edits`` edits to ``end``: the whole item against prefixes of the reversed stretch."""
    stretch = points[max(0, end - len(item) - k) : end][::-1]
    cost = np.arange(len(stretch) + 1)
    steps = np.arange(len(stretch) + 1)
    for n, c in enumerate(item[::-1], 1):
        moved = np.minimum(cost[:-1] + (stretch != c), cost[1:] + 1)
        cost = np.minimum.accumulate(np.append(n, moved) - steps) + steps
    return end - int(np.flatnonzero(cost == edits)[0])


def _search(shared: Broadcast):
    @F.pandas_udf(MATCHES)
    def places(texts: pd.Series) -> pd.Series:
        names = ("item_id", "begin", "end", "edits")
        return pd.Series([[dict(zip(names, m)) for m in occurrences(t, shared.value)] for t in texts], dtype=object)

    # Otherwise the optimizer puts a filter on the array's size in front of an explode and searches twice.
    return places.asNondeterministic()


def matches(text: Column, benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text", **options) -> Column:
    """An array of the places of benchmark items in ``text``; one broadcast index per block of the benchmark."""
    bound_batches(benchmark.sparkSession)
    context = benchmark.sparkSession.sparkContext
    columns = []
    for block in _blocks(benchmark.select(F.col(item_col).cast("long"), F.col(item_text)).toLocalIterator()):
        shared = context.broadcast(build(block, **options))

        columns.append(_search(shared)(text))
    return F.concat(*columns) if columns else F.array().cast(MATCHES)


def _blocks(rows: Iterator) -> Iterator[list[tuple[int | None, str | None]]]:
    block, held = [], 0
    for item_id, text in rows:
        block.append((item_id, text))
        held += len(text or "")
        if held >= BLOCK_CHARS:
            yield block
            block, held = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, item_id, begin, end, edits``: one row for each place of an item in a document."""
    found = matches(F.col(text_col), benchmark, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), found.alias("m")).select("doc_id", F.explode("m").alias("m"))
    return rows.select("doc_id", "m.item_id", "m.begin", "m.end", "m.edits")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item occurs, columns unchanged."""
    return docs.filter(F.size(matches(F.col(text_col), benchmark, **options)) == 0)
