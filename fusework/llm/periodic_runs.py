"""Periodic run detection by recompression.

The words of a piece of texts become one sequence of numbers, with a mark between texts. Recompression makes a
run-length grammar of it: block compression replaces each maximal block of one symbol, then pair compression splits
the symbols into left and right ones by a hash and replaces each left-right pair, in turn, until each text is one
symbol. Equal symbols have equal expansions, and each level is decided locally, so two equal stretches are parsed
alike but for a symbol at each end of a level. The longest common extension of two places is therefore found by
climbing, one symbol or block a level, up to the first two symbols that differ, and by going down from there to
the first two words that differ.

A run of period q with 4 q words or more has a place i, i + q on the grid of multiples of 3 q. All such pairs with
equal words are candidates; their extensions to both sides are exact, so a run is found whole or not at all, and
without suffix arrays. Queries of all texts of a piece move through the grammar together, as NumPy arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fusework.llm.textbatch import bounded_batches, mix, pieces

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
GRID_PAIRS = 2_000_000  # candidate places looked at in one step

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_MARK = 0


@dataclass
class Level:
    """Symbols of a level and, but for the top, the index of each one's parent and where the parents begin.

    ``begin`` has one entry more than there are parents. ``blocks`` tells block from pair compression.
    """

    symbols: np.ndarray
    parent: np.ndarray | None = None
    begin: np.ndarray | None = None
    blocks: bool = False


def _grow(symbols: np.ndarray, begin: np.ndarray, keys: np.ndarray, whole: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """Symbols of the next level: those at ``begin``, but new ones, equal for equal keys, where ``whole``."""
    out = symbols[begin]
    names, place = np.unique(keys, return_inverse=True)
    out[whole] = fresh + place
    return out, fresh + len(names)


def recompress(symbols: np.ndarray) -> list[Level]:
    """The levels of the grammar of a sequence of symbols over ``_MARK``; marks stand at both ends and never side by side."""
    levels, fresh, now = [], int(symbols.max(initial=0)) + 1, symbols.astype(np.int64)
    least = 2 * int((now == _MARK).sum()) - 1
    turn = 0
    while len(now) > least:
        turn += 1
        blocks = turn % 2 == 1
        first = np.ones(len(now), bool)
        if blocks:
            first[1:] = now[1:] != now[:-1]
        else:
            salt = np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            right = (mix(now.astype(np.uint64) + salt) & np.uint64(1)).astype(bool)
            words = now != _MARK
            first[1:] = ~(words[:-1] & ~right[:-1] & words[1:] & right[1:])
        begin = np.flatnonzero(first)
        if len(begin) == len(now):
            continue
        sizes = np.diff(np.append(begin, len(now)))
        whole = np.flatnonzero(sizes > 1)
        other = sizes[whole] if blocks else now[begin[whole] + 1]
        upper, fresh = _grow(now, begin, now[begin[whole]] * (int(other.max()) + 1) + other, whole, fresh)
        parent = np.repeat(np.arange(len(begin)), sizes)
        levels.append(Level(now, parent, np.append(begin, len(now)), blocks))
        now = upper
    levels.append(Level(now))
    return levels


def mirrored(levels: list[Level]) -> list[Level]:
    """The same grammar read from right to left."""
    out = []
    for level in levels:
        if level.parent is None:
            out.append(Level(level.symbols[::-1]))
        else:
            parents = len(level.begin) - 1
            out.append(Level(level.symbols[::-1], parents - 1 - level.parent[::-1], len(level.symbols) - level.begin[::-1], level.blocks))
    return out


def common_extension(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of equal symbols from each place i and j on; i < j stand in one text, a mark ends it."""
    a, b = i.copy(), j.copy()
    active = np.arange(len(a))
    stopped: list[np.ndarray] = []
    for level in levels:
        x, y = a[active], b[active]
        equal = level.symbols[x] == level.symbols[y]
        differ = [active[~equal]]
        active = active[equal]
        if level.parent is not None and len(active):
            x, y = x[equal], y[equal]
            left = level.begin[level.parent[x] + 1] - x
            right = level.begin[level.parent[y] + 1] - y
            starts = (level.begin[level.parent[x]] == x) & (level.begin[level.parent[y]] == y)
            step = np.where(starts, 0, np.minimum(left, right))
            x, y = x + step, y + step
            # blocks with different rests: the next symbols differ
            uneven = ~starts & (left != right)
            a[active], b[active] = np.where(uneven, x, level.parent[x]), np.where(uneven, y, level.parent[y])
            differ.append(active[uneven])
            active = active[~uneven]
        stopped.append(np.concatenate(differ))
    assert not len(active), "two places of a text with the same rest"
    down = np.zeros(0, np.int64)
    for level, here in zip(levels[-2::-1], stopped[:0:-1]):
        down = np.concatenate([down, here])
        x, y = a[down], b[down]
        size = np.minimum(level.begin[x + 1] - level.begin[x], level.begin[y + 1] - level.begin[y])
        x, y = level.begin[x], level.begin[y]
        step = np.where(level.symbols[x] == level.symbols[y], size if level.blocks else 1, 0)
        a[down], b[down] = x + step, y + step
    return a - i


def grid(lengths: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of all grid places of texts of ``lengths`` words that begin at ``starts``, in bounded parts."""
    periods = lengths // LEAST_EXPONENT
    periods[lengths < LEAST_LENGTH] = 0
    text = np.repeat(np.arange(len(lengths)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    least = np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
    step = least - period
    counts = -(-(lengths[text] - period) // step)
    sums = np.cumsum(counts)
    at = 0
    while at < len(text):
        stop = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + GRID_PAIRS, "right")))
        n = counts[at:stop]
        number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        t, q = np.repeat(text[at:stop], n), np.repeat(period[at:stop], n)
        yield t, starts[t] + number * np.repeat(step[at:stop], n), q
        at = stop


def find_runs(symbols: np.ndarray, lengths: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``symbols`` as for :func:`recompress`, of texts of ``lengths`` symbols that begin at ``starts``.
    """
    levels = recompress(symbols)
    back = mirrored(levels)
    parts = []
    for text, place, period in grid(lengths, starts):
        same = symbols[place] == symbols[place + period]
        text, place, period = text[same], place[same], period[same]
        ahead = common_extension(levels, place, place + period)
        before = common_extension(back, len(symbols) - place - period, len(symbols) - place)
        length = before + period + ahead
        good = length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
        parts.append(np.stack([text[good], (place - before)[good], length[good], period[good]]))
    found = np.concatenate(parts, 1) if parts else np.zeros((4, 0), np.int64)
    # the same stretch is found with its smallest period and with multiples of it
    found = found[:, np.lexsort((found[3], found[2], found[1]))]
    new = np.ones(found.shape[1], bool)
    new[1:] = (found[1, 1:] != found[1, :-1]) | (found[2, 1:] != found[2, :-1])
    found = found[:, new]
    found = found[:, np.lexsort((found[3], found[1]))]
    return found[0], found[1] - starts[found[0]], found[2], found[3]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs, collapsed of every row of ``docs`` (doc_id, text).

    ``runs`` holds start (word number from 0), length and period of every maximal run of words with smallest period
    q and max(6, 4 q) words or more, by start and period. ``collapsed`` is the text without the words after the
    first period of any run, joined by single spaces. NULL and empty texts, and texts without words, have no words, no
    runs and an empty ``collapsed``. Repeated rows give repeated rows; other columns don't matter. A task holds one
    piece of texts, so memory is bounded by the longest text.
    """
    bounded_batches(docs.sparkSession)
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for rows, data, offsets in pieces(batches):
            raw = data.tobytes()
            words = [raw[p:q].split() for p, q in zip(offsets[:-1], offsets[1:])]  # bytes split at ASCII white space
            counts = np.array([len(w) for w in words])
            some = np.flatnonzero(counts)
            ids = pa.array([w for k in some for w in words[k]], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
            lengths = counts[some]
            starts = np.cumsum(lengths + 1) - lengths
            symbols = np.zeros(int((lengths + 1).sum()) + 1, np.int64)
            symbols[np.arange(len(ids)) + np.repeat(np.arange(1, len(some) + 1), lengths)] = ids + 1
            text, start, length, period = find_runs(symbols, lengths, starts)
            # words after the first period of a run
            ends = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(ends, starts[text] + start + period, 1)
            np.add.at(ends, starts[text] + start + length, -1)
            gone = np.cumsum(ends) > 0
            collapsed = [b" ".join(w) for w in words]
            for t in np.unique(text):
                w = words[some[t]]
                keep = ~gone[starts[t] : starts[t] + lengths[t]]
                collapsed[some[t]] = b" ".join(w[k] for k in np.flatnonzero(keep).tolist())
            bounds = np.zeros(rows.num_rows + 1, np.int32)
            bounds[1:] = np.cumsum(np.bincount(some[text], minlength=rows.num_rows))
            items = pa.StructArray.from_arrays([pa.array(v) for v in (start, length, period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(bounds), items),
                 pa.array(collapsed, pa.binary()).view(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {key}, n_words bigint, runs {RUNS}, collapsed string")
