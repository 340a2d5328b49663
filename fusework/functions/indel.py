"""Indel similarity of texts: 200 * LCS / (len a + len b).

The longest common subsequence is counted bit-parallel (Hyyroe 2004) for a whole Arrow batch at a
time: every row is one lane of a NumPy vector, every 64 pattern characters one machine word, so
texts of any length are compared in full.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import pandas_udf

WORD = 64
_PAD = 0  # code of "no character"; its mask is always zero


def code_points(texts) -> tuple[np.ndarray, np.ndarray]:
    """Texts as a padded matrix of code points, plus their lengths."""
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    width = max(1, int(lengths.max()) if len(lengths) else 1)
    padded = "".join(t.ljust(width, "\0") for t in texts)
    flat = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return flat.reshape(len(lengths), width), lengths


def lcs_lengths(
    masks: list[np.ndarray], codes: np.ndarray, rows: int, alive: list[np.ndarray] | None = None
) -> np.ndarray:
    """LCS per row.

    ``masks[w][..., c]`` holds the positions of character ``c`` in word ``w`` of the pattern, for
    one shared pattern (1-d) or one per row (2-d). ``codes`` are the characters of the other text.
    ``alive`` limits every row to some positions of the pattern.
    """
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    state = [np.full(rows, ones, dtype=np.uint64) for _ in masks]
    lane = np.arange(rows)
    for column in range(codes.shape[1]):
        c = codes[:, column]
        carry = None
        for w, mask in enumerate(masks):
            hit = mask[c] if mask.ndim == 1 else mask[lane, c]
            s = state[w]
            u = s & hit if alive is None else s & hit & alive[w]
            total = s + u
            over = total < s
            if carry is not None:
                total = total + carry
                over = over | ((total == 0) & carry.astype(bool))
            state[w] = total | (s & ~u)
            carry = over.astype(np.uint64)
    return sum(WORD - np.bitwise_count(s).astype(np.int64) for s in state)


def pattern_masks(codes: np.ndarray, alphabet: int) -> list[np.ndarray]:
    """Per-row position masks of the pattern matrix ``codes``."""
    rows, width = codes.shape
    lane = np.arange(rows)
    masks = []
    for start in range(0, width, WORD):
        mask = np.zeros((rows, alphabet), dtype=np.uint64)
        for bit, column in enumerate(range(start, min(start + WORD, width))):
            c = codes[:, column]
            mask[lane, c] |= np.uint64(1 << bit)
        mask[:, _PAD] = 0
        masks.append(mask)
    return masks


def pairwise_lcs(a, b, batch: int = 4096) -> np.ndarray:
    """LCS of each pair of two equally long text sequences."""
    result = np.zeros(len(a), dtype=np.int64)
    # rows of similar length share a chunk, so one long text does not widen all others
    order = np.argsort([max(len(x), len(y)) for x, y in zip(a, b)], kind="stable")
    for start in range(0, len(order), batch):
        rows = order[start : start + batch]
        left, _ = code_points([a[i] for i in rows])
        right, _ = code_points([b[i] for i in rows])
        symbols = np.unique(np.concatenate([left.ravel(), right.ravel(), [0]]))
        left, right = np.searchsorted(symbols, left), np.searchsorted(symbols, right)
        masks = pattern_masks(left, len(symbols))
        result[rows] = lcs_lengths(masks, right, len(rows))
    return result


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Indel ratio of each pair; two empty texts are equal."""
    length = np.array([len(x) + len(y) for x, y in zip(a, b)], dtype="float64")
    lcs = pairwise_lcs(a, b)
    return np.where(length > 0, 200.0 * lcs / np.maximum(length, 1), 100.0)


def sort_tokens(text: str) -> str:
    return " ".join(sorted(text.split()))


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    both = a.notna() & b.notna()
    out = pd.Series(np.nan, index=a.index, dtype="float64")
    out[both] = ratios(a[both].tolist(), b[both].tolist())
    return out


_indel = pandas_udf(_ratios, T.DoubleType())


def indel_ratio(a: Column, b: Column) -> Column:
    # an Arrow function has no NULL for doubles, only NaN
    return F.nanvl(_indel(a, b), F.lit(None).cast("double"))


def sorted_tokens(text: Column) -> Column:
    return F.array_sort(F.filter(F.split(text, r"\s+"), lambda t: t != ""))


def token_sort_ratio(a: Column, b: Column) -> Column:
    return indel_ratio(F.array_join(sorted_tokens(a), " "), F.array_join(sorted_tokens(b), " "))


_lcs = pandas_udf(lambda a, b: pd.Series(pairwise_lcs(a.tolist(), b.tolist())), T.LongType())


def token_set_ratio(a: Column, b: Column) -> Column:
    """Best ratio among shared tokens and shared-plus-own tokens; 100 when one set holds the other."""
    ta, tb = F.array_distinct(sorted_tokens(a)), F.array_distinct(sorted_tokens(b))
    shared = F.array_join(F.array_intersect(ta, tb), " ")
    only_a = F.array_join(F.array_except(ta, tb), " ")
    only_b = F.array_join(F.array_except(tb, ta), " ")
    s, x, y = F.length(shared), F.length(only_a), F.length(only_b)
    gap = F.when(s > 0, 1).otherwise(0)
    left, right = s + gap + x, s + gap + y
    lcs = _lcs(F.coalesce(only_a, F.lit("")), F.coalesce(only_b, F.lit("")))
    whole = 100.0 * (1.0 - (x + y - 2 * lcs) / (left + right))
    best = F.when(
        s > 0,
        F.greatest(
            whole,
            100.0 * (1.0 - (gap + x) / (s + left)),
            100.0 * (1.0 - (gap + y) / (s + right)),
        ),
    ).otherwise(whole)
    subset = (s > 0) & ((x == 0) | (y == 0))
    nothing = (F.size(ta) == 0) | (F.size(tb) == 0)
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(nothing, F.lit(0.0))
        .when(subset, F.lit(100.0))
        .otherwise(best)
    )


class TokenSetBlock:
    """Token-set scores of one text against a block of texts, without forming the pairs.

    The block is encoded once, with an index from words to the texts that have them. Comparing only the words
    two texts do not share is done by switching positions off: a switched-off character never matches, which
    leaves the LCS of the rest.
    """

    def __init__(self, texts: list[str]):
        split = [sorted(set(t.split())) for t in texts]
        self.rows = len(texts)
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for s in split for w in s}))}
        width = max(1, max((len(s) for s in split), default=1))
        self.tokens = np.zeros((self.rows, width), dtype=np.int32)
        for i, words in enumerate(split):
            self.tokens[i, : len(words)] = [self.vocabulary[w] for w in words]
        sizes = np.zeros(len(self.vocabulary) + 1, dtype=np.int64)
        for w, i in self.vocabulary.items():
            sizes[i] = len(w)
        self.sizes = sizes[self.tokens]
        self.counts, self.letters = (self.tokens > 0).sum(axis=1), self.sizes.sum(axis=1)
        # the texts of each word: a slice of one array
        flat = self.tokens.ravel()
        order = np.argsort(flat, kind="stable")
        self.owners = order // width
        self.begin = np.searchsorted(flat[order], np.arange(len(sizes) + 1))
        joined = [" ".join(s) for s in split]
        raw, self.lengths = code_points(joined)
        self.symbols = np.unique(np.concatenate([raw.ravel(), [0]]))
        self.codes = np.searchsorted(self.symbols, raw).astype(np.int32)
        # which word every character belongs to; a space belongs to the word before it
        space = raw == ord(" ")
        self.word_of = (np.cumsum(space, axis=1) - space).astype(np.int32)
        self.space = space
        # how often each letter stands in each text
        self.bags = np.zeros((len(self.symbols), self.rows), dtype=np.int32)
        np.add.at(self.bags, (self.codes, np.arange(self.rows)[:, None]), 1)
        self.index = {int(c): i for i, c in enumerate(self.symbols)}

    def scores(self, text: str) -> np.ndarray:
        """The score of every text of the block."""
        return self._exact(sorted(set(text.split())), np.arange(self.rows))

    def best(self, text: str, k: int, floor: float = -1.0) -> tuple[np.ndarray, np.ndarray]:
        """(row, score) of all texts that score at least ``floor`` and as much as the k-th best of the block, ties included.

        Upper bounds come from the words and letters that two texts share; texts are compared in their order until the
        next bound is below the k-th best score.
        """
        words = sorted(set(text.split()))
        bounds = self._bounds(words)
        order = np.argsort(-bounds, kind="stable")
        order = order[: np.searchsorted(-bounds[order], -floor, "right")]
        rows, values, at, step = order[:0], np.zeros(0), 0, 4 * k + 28
        while at < len(order):
            if len(values) >= k:
                floor = max(floor, np.partition(values, len(values) - k)[len(values) - k])
                if bounds[order[at]] < floor:
                    break
            part = order[at : at + step]
            rows, values = np.concatenate([rows, part]), np.concatenate([values, self._exact(words, part)])
            at, step = at + step, min(2 * step, 4096)
        if len(values) >= k:
            floor = max(floor, np.partition(values, len(values) - k)[len(values) - k])
        keep = values >= floor
        return rows[keep], values[keep]

    def _shared(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number, letters) of the words that each text shares."""
        number, letters = np.zeros(self.rows, dtype=np.int64), np.zeros(self.rows, dtype=np.int64)
        for w in words:
            code = self.vocabulary.get(w)
            if code is not None:
                at = self.owners[self.begin[code] : self.begin[code + 1]]
                number[at] += 1
                letters[at] += len(w)
        return number, letters

    def _lengths(self, words: list[str], number: np.ndarray, letters: np.ndarray, rows=slice(None)):
        """Lengths of the shared words, of the text's others and of the words' others, joined by spaces."""
        own, own_text = self.counts[rows] - number, len(words) - number
        s = letters + np.maximum(number - 1, 0)
        x = self.letters[rows] - letters + np.maximum(own - 1, 0)
        y = sum(map(len, words)) - letters + np.maximum(own_text - 1, 0)
        return s, x, y

    def _score(self, s, x, y, lcs, rows=slice(None)) -> np.ndarray:
        gap = (s > 0).astype(np.int64)
        left, right = s + gap + x, s + gap + y
        with np.errstate(divide="ignore", invalid="ignore"):
            best = 100.0 * (1.0 - (x + y - 2 * lcs) / (left + right))
            with_a = 100.0 * (1.0 - (gap + x) / (s + left))
            with_b = 100.0 * (1.0 - (gap + y) / (s + right))
        best = np.where(s > 0, np.maximum(best, np.maximum(with_a, with_b)), best)
        best = np.where((s > 0) & ((x == 0) | (y == 0)), 100.0, best)
        return np.where(self.counts[rows] > 0, best, 0.0)

    def _bounds(self, words: list[str]) -> np.ndarray:
        """No score is larger: the LCS has no letter more often than both sides."""
        if not words:
            return np.zeros(self.rows)
        number, letters = self._shared(words)
        s, x, y = self._lengths(words, number, letters)
        bag = -letters  # letters of shared words are counted on both sides
        text = "".join(words)
        for ch in set(text):
            row = self.index.get(ord(ch))
            if row is not None:
                bag = bag + np.minimum(self.bags[row], text.count(ch))
        spaces = np.minimum(np.maximum(self.counts - number - 1, 0), np.maximum(len(words) - number - 1, 0))
        return self._score(s, x, y, np.minimum(bag + spaces, np.minimum(x, y)))

    def _exact(self, words: list[str], rows: np.ndarray) -> np.ndarray:
        n = len(rows)
        if not words or not n:
            return np.zeros(n)
        lane = np.arange(n)
        tokens = self.tokens[rows]
        present = tokens > 0
        common_here = np.zeros_like(present)  # block words that the text has
        common_text = np.zeros((n, len(words)), dtype=bool)  # text words the block row has
        for i, w in enumerate(words):
            code = self.vocabulary.get(w)
            if code is not None:
                hit = tokens == code
                common_here |= hit
                common_text[:, i] = hit.any(axis=1)
        own = present & ~common_here
        own_text = ~common_text
        s, x, y = self._lengths(words, common_here.sum(axis=1), (common_here * self.sizes[rows]).sum(axis=1), rows)

        # characters of the block rows that take part: own words and the spaces between them
        width = own.shape[1]
        last_own = np.where(own.any(axis=1), width - 1 - own[:, ::-1].argmax(axis=1), -1)
        word_of = self.word_of[rows]
        live = own[lane[:, None], np.minimum(word_of, width - 1)]
        live &= ~(self.space[rows] & (word_of == last_own[:, None]))
        codes = np.where(live, self.codes[rows], _PAD)

        # the same for the text, as bit masks per block row
        pattern = " ".join(words)
        n_words = (len(pattern) + WORD - 1) // WORD
        base = [np.zeros(len(self.symbols), dtype=np.uint64) for _ in range(n_words)]
        alive = [np.zeros(n, dtype=np.uint64) for _ in range(n_words)]
        n_text = len(words)
        last_text = np.where(own_text.any(axis=1), n_text - 1 - own_text[:, ::-1].argmax(axis=1), -1)
        position = 0
        for i, w in enumerate(words):
            bits = [0] * n_words
            for p in range(position, position + len(w)):
                bits[p // WORD] |= 1 << (p % WORD)
            for k in range(n_words):
                alive[k] |= np.where(own_text[:, i], np.uint64(bits[k]), np.uint64(0))
            gap = position + len(w)
            if gap < len(pattern):
                keep = own_text[:, i] & (last_text != i)
                alive[gap // WORD] |= np.where(keep, np.uint64(1 << (gap % WORD)), np.uint64(0))
            position = gap + 1
        for p, ch in enumerate(pattern):
            i = self.index.get(ord(ch), _PAD)
            if i != _PAD:
                base[p // WORD][i] |= np.uint64(1 << (p % WORD))
        return self._score(s, x, y, lcs_lengths(base, codes, n, alive), rows)
