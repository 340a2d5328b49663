"""Language identification by cross-parsing with suffix automata.

A bounded sample of labelled text gives one suffix automaton per language. A text is parsed against
each: a phrase is the longest match in the language's sample, then the parse starts anew. Phrases
times the logarithm of the sample size, per character, estimate the cross entropy; the language
that needs the fewest bits wins.

Texts are parsed whole. They are cut into segments of ``SEGMENT`` characters, where a phrase ends in
any case, and all segments of a piece move through the automata in step, one table look-up a
character, so that one very long text costs no more than many short ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fusework.llm.textbatch import bounded_batches, pieces, send

UNDETERMINED = "und"
SEGMENT = 256
SAMPLE_DOCS = 64  # labelled rows per language at most
SAMPLE_CHARS = 40_000  # characters per language at most, in whole texts

_UNKNOWN, _SPACE = 0, 1


def bucket(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a NULL id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the states of the automaton of all substrings; state 0 is the root."""
    following, length, link, last = [{}], [0], [-1], 0
    for c in codes:
        now = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = now
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                twin = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    return following


@dataclass
class LanguageModel:
    """The automata of all languages in one table that their transitions share.

    The transition of a state by code c stands at place ``base`` of the state + c, if ``owner`` names the state there,
    and leads to ``to``. States count from 1, so 0 means no transition. The table takes little more than eight bytes
    a transition, of which an automaton has at most three times as many as its sample has letters, whatever the alphabet.
    """

    languages: list[str]
    base: np.ndarray
    owner: np.ndarray
    to: np.ndarray
    roots: np.ndarray
    bits: np.ndarray
    letters: dict[str, int]
    codes: np.ndarray
    alpha: np.ndarray


def displaced(states: list[dict[int, int]], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base of each state, state at each place or -1, where that leads) of an automaton with codes below ``span``.

    The rows of its transition table are laid over each other so that no two transitions share a place: those
    with most transitions first, and single transitions into the holes that are left.
    """
    base, taken = [0] * len(states), bytearray(4 * span + sum(map(len, states)))
    at, several = span, 0
    for state in sorted(range(len(states)), key=lambda k: -len(states[k])):
        codes = sorted(states[state])
        if not codes:
            break
        if len(codes) != several:
            at, several = span, len(codes)
        while True:
            if at + 2 * span > len(taken):
                taken.extend(bytes(len(taken)))
            start = at - codes[0]
            if not any(taken[start + c] for c in codes):
                break
            at += 1
        base[state] = start
        for c in codes:
            taken[start + c] = 1
        at += several == 1
    owner, to = np.full(max(base) + span, -1, np.int32), np.zeros(max(base) + span, np.int32)
    for state, arcs in enumerate(states):
        for c, end in arcs.items():
            owner[base[state] + c], to[base[state] + c] = state, end
    return np.array(base, np.int32), owner, to


def code_tables(letters: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(code, is a letter) of every code point; all that is no letter is white space."""
    codes = np.full(0x110000, _SPACE, np.min_scalar_type(len(letters) + 2))
    alpha = np.zeros(0x110000, bool)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            alpha[cp] = True
            codes[cp] = letters.get(ch.lower(), _UNKNOWN)
    return codes, alpha


def fit_language_model(docs: DataFrame, label: str = "lang", sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """Fits on at most ``sample_docs`` rows per language, picked by a hash of id and text, with their whole texts.

    Rows are taken for as long as they have ``sample_chars`` characters or fewer together; one is taken in any case,
    and longer ones only if a language has no others. Rows with NULL text or label, and texts without a letter,
    teach nothing. The driver gets at most ``sample_chars`` characters, or one text, for each of the languages.
    """
    usable = docs.where(F.col(label).isNotNull() & F.col("text").rlike(r"\p{L}"))
    narrow = usable.select(F.col(label).alias("label"), "doc_id", "text", F.char_length("text").alias("size"))
    order = W.partitionBy("label").orderBy(F.col("size") > sample_chars, F.xxhash64("doc_id", "text"), "doc_id")
    # rank first: the window group limit keeps a few rows of each language and task
    ranked = narrow.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample_docs)
    so_far = F.sum("size").over(W.partitionBy("label").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = ranked.withColumn("so_far", so_far).where((F.col("so_far") <= sample_chars) | (F.col("place") == 1)).select(
        "label", "place", "text"
    ).collect()
    samples: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r.label, r.place)):
        samples.setdefault(row.label, []).append(row.text.lower())
    known = sorted({ch for texts in samples.values() for text in texts for ch in text if ch.isalpha()})
    letters = {c: i + 2 for i, c in enumerate(known)}
    span = len(letters) + 2
    languages = sorted(samples)
    model = LanguageModel(languages, np.zeros(1, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(len(languages), np.int32),
                          np.zeros(len(languages)), letters, *code_tables(letters))
    for k, language in enumerate(languages):
        codes: list[int] = []
        for text in samples[language]:
            part = []
            for ch in text:
                code = letters[ch] if ch.isalpha() else _SPACE
                if code != _SPACE or not part or part[-1] != _SPACE:
                    part.append(code)
            codes += part
        base, owner, to = displaced(suffix_automaton(codes), span)
        first, places = len(model.base), len(model.owner)
        model.base = np.concatenate([model.base, base + places])
        model.owner = np.concatenate([model.owner, np.where(owner >= 0, owner + first, 0)])
        model.to = np.concatenate([model.to, np.where(owner >= 0, to + first, 0)])
        model.roots[k], model.bits[k] = first, np.log2(max(2, len(codes)))
    return model


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a piece and where its rows begin among them."""
    raw = data.tobytes()
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    try:
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:
        rows = [raw[a:b].decode(errors="replace").encode("utf-32-le") for a, b in zip(offsets[:-1], offsets[1:])]
        starts = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])])
        points = np.frombuffer(b"".join(rows), np.uint32)
    return points, starts


def follow(model: LanguageModel, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Where the transitions from ``state`` by ``codes`` (of its last axis) lead; 0 where there is none."""
    place = model.base[state] + codes
    return np.where(model.owner[place] == state, model.to[place], 0)


def parse(model: LanguageModel, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Phrases of each row in each language: (languages, rows). starts: where rows begin in codes."""
    n_rows = len(starts) - 1
    lengths = np.diff(starts)
    parts = -(-lengths // SEGMENT)
    row = np.repeat(np.arange(n_rows), parts)
    number = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = starts[:-1][row] + number * SEGMENT
    size = np.minimum(SEGMENT, starts[1:][row] - begin)
    order = np.argsort(-size, kind="stable")
    begin, size, row = begin[order], size[order], row[order]
    state = np.repeat(model.roots[:, None], len(row), 1)
    root = state.copy()
    phrases = np.zeros(state.shape, np.int32)
    active = np.searchsorted(-size, -np.arange(SEGMENT), "left")
    for t in range(int(size.max(initial=0))):
        n = active[t]
        c = codes[begin[:n] + t]
        now = state[:, :n]
        to = follow(model, now, c)
        missed = np.flatnonzero(to == 0)
        if len(missed):
            lang, col = np.divmod(missed, n)
            again = follow(model, root[lang, col], c[col])
            # the phrase so far ends; a letter unknown to the language is a phrase of its own
            phrases[lang, col] += (now[lang, col] != root[lang, col]).astype(np.int32) + (again == 0)
            to[lang, col] = np.where(again == 0, root[lang, col], again)
        state[:, :n] = to
    phrases += state != root
    return np.stack([np.bincount(row, phrases[k], n_rows) for k in range(len(model.languages))])


def _identified(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text of a piece."""
    points, starts = code_points(data, offsets)
    n = len(offsets) - 1
    codes, is_letter = model.codes[points], model.alpha[points]
    owner = np.repeat(np.arange(n), np.diff(starts))
    letters = np.bincount(owner, is_letter, n)
    known = np.bincount(owner, is_letter & (codes != _UNKNOWN), n)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE) | (owner[1:] != owner[:-1])
    kept = np.concatenate([[0], np.cumsum(keep)])[starts]
    if not model.languages:
        return [UNDETERMINED] * n, np.zeros(n)
    length = np.maximum(1, np.diff(kept))
    cost = parse(model, codes[keep], kept) * model.bits[:, None] / length
    best = cost.argmin(0)
    ordered = np.sort(cost, 0)
    score = np.ones(n)
    if len(model.languages) > 1:
        total = ordered[0] + ordered[1]
        score = np.where(total > 0, ordered[1] / np.where(total > 0, total, 1), 0.5)
    score = np.where(letters > 0, score * known / np.maximum(1, letters), 0.0)
    return [model.languages[b] if k else UNDETERMINED for b, k in zip(best, letters)], score


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs`` (doc_id, text).

    ``und`` with score 0 where the text is NULL or has no letter, or where no language was learned.
    The score is the second best cross entropy's share of the two best, times the share of letters
    that any language knows: 0.5 for a tie, towards 1 for a clear case, towards 0 for a foreign script.
    Ties go to the first language by code point. Repeated rows give repeated rows; other columns don't matter.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    receive = send(spark, model)
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        model = receive()
        for rows, data, offsets in pieces(batches):
            names, score = _identified(model, data, offsets)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {key}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, least_score: float) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language with a score of at least ``least_score``.

    All columns stay as they are, whatever their names. Rows are judged where they stand: nothing is shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    receive = send(spark, model)

    def work(batches):
        model = receive()
        for rows, data, offsets in pieces(batches):
            names, score = _identified(model, data, offsets)
            keep = (np.array(names) != UNDETERMINED) & (score >= least_score)
            if keep.any():
                yield rows.filter(pa.array(keep))

    return docs.mapInArrow(work, docs.schema)
