"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled one after the other into a deterministic automaton over tokens. Its states
are "just read token u"; a fresh automaton over the base symbols accepts every word. The gadget of a
merge (u, v) -> uv changes it so that

* u can no longer be followed by v: the arc v of state u goes,
* wherever u can be read, uv can be read: the column of uv is a copy of the column of u,
* after uv the automaton goes on as it did after v: the row of uv is a copy of the row of v.

What remains accepts exactly the token sequences that BPE produces, one for every word. Rows and
columns are copied on write: an arc is looked up through the history of its copies and then kept in
the transition table, so the automaton takes memory for arcs that texts use and not for the square
of the vocabulary.

Every beginning of a word is spelled by exactly one path too, so a word is encoded symbol by symbol: for each place the
tokens that end there are found in a table of the reversed labels, and the only one that may follow the last token of
the path up to its start is kept. That takes a bounded number of table look-ups a symbol, however long the word.
Decoding emits the arcs' labels.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import regex

# White space of Unicode, and the splitting pattern of the tokenizer file's family.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+"
ASCII_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"
END = "</w>"

CACHED_WORDS = 400_000
CACHED_ARCS = 1_000_000
HEAD = 4  # symbols that words begin with and whose places are kept
SYMBOLS = 512  # more than the code points of the byte symbols
NEVER = 1 << 40  # a time after all merges


def byte_symbols() -> list[str]:
    """A visible character for each byte: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(extra)
            extra += 1
    return [symbols[b] for b in range(256)]


class TokenAutomaton:
    """The compiled automaton of one tokenizer file, with bounded caches for arcs and words."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or spec.get("decoder"):
            raise ValueError("a BPE file with word ends and without a decoder is needed")
        self.vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.vocab.values(), *self.added.values()]) + 1
        self.labels: list[bytes] = [b""] * size
        for table in (self.vocab, self.added):
            for label, token in table.items():
                self.labels[token] = label.encode()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self._compile([(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in merges], size)
        self._prepare()

    def _compile(self, merges: list[tuple[int, int, int]], size: int) -> None:
        self.left = [-1] * size
        self.right = [-1] * size
        self.born = [-1] * size
        self.gone: dict[int, int] = {}
        self.size = size
        made = {uv for _, _, uv in merges}
        self.alive = [token not in made for token in range(size)]
        for rank, (u, v, uv) in enumerate(merges):
            if self.born[uv] >= 0 or not (self.alive[u] and self.alive[v] and self._arc(u, v, rank)):
                continue  # no path reads u, v any more: the gadget changes nothing
            self.gone[u * size + v] = rank
            self.left[uv], self.right[uv], self.born[uv], self.alive[uv] = u, v, rank, True

    def _arc(self, state: int, token: int, time: int) -> bool:
        """Whether state has an arc token before the gadget of rank ``time`` is applied."""
        born, gone, size = self.born, self.gone, self.size
        while True:
            if gone.get(state * size + token, time) < time:
                return False
            i, j = born[state], born[token]
            if i < 0 and j < 0:
                return True
            if j > i:  # the column was copied from the column of its left part
                token, time = self.left[token], j
                # the removal of (u, v) comes before the copy, which matters for u = v
                if gone.get(state * size + token) == time:
                    return False
            elif i > j:  # the row was copied from the row of its right part, as it was before
                state, time = self.right[state], i
            else:  # a token after itself: its own new row and column
                state, token, time = self.right[state], self.left[token], i

    def _prepare(self) -> None:
        names = "|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True))
        self.special = re.compile(f"({names})") if names else None
        self.inside, self.inside_token = self._reversed({s: t for s, t in self.vocab.items() if not s.endswith(END)})
        self.ending, self.ending_token = self._reversed({s[: -len(END)]: t for s, t in self.vocab.items() if s.endswith(END)})
        self.symbols = byte_symbols()
        self.table: dict[int, bool] = {}
        self.heads: dict[str, tuple[list[int], list[int]]] = {}
        self.words = _Words(self)
        self.split = regex.compile(SPLIT)
        self.ascii_split = re.compile(ASCII_SPLIT)

    def __getstate__(self):
        """What the merges were compiled into, without caches."""
        keep = ("vocab", "added", "labels", "left", "right", "born", "gone", "size", "alive")
        return {k: self.__dict__[k] for k in keep}

    def _reversed(self, tokens: dict[str, int]) -> tuple[dict[int, int], list[int]]:
        """Transitions (state * SYMBOLS + symbol: state) that read labels backwards, and the token of each state or -1."""
        step, token = {}, [-1]
        for label, value in tokens.items():
            if not self.alive[value]:
                continue
            state = 0
            for symbol in reversed(label):
                key = state * SYMBOLS + ord(symbol)
                state = step.get(key, 0)
                if not state:
                    state = step[key] = len(token)
                    token.append(-1)
            token[state] = value
        return step, token

    def encode_word(self, word: str) -> bytes:
        """The ids of one pre-split word: the only path of the automaton that spells it."""
        s = word if word.isascii() and word.isprintable() else "".join(map(self.symbols.__getitem__, word.encode()))
        codes, n, table, size = list(map(ord, s)), len(s), self.table, self.size
        if len(table) > CACHED_ARCS:
            table.clear()
        # last token of the path up to each place, and where it starts
        head = self.heads.get(s[:HEAD]) if n > HEAD else None
        last, before = map(list, head) if head else ([-1], [0])
        known = len(last)
        last += [-1] * (n + 1 - known)
        before += [0] * (n + 1 - known)
        step, tokens = self.inside, self.inside_token
        for end in range(known, n + 1):
            if end == n:
                step, tokens = self.ending, self.ending_token
            state, start, ends = 0, end, []
            while start:
                start -= 1
                state = step.get(state * SYMBOLS + codes[start])
                if state is None:
                    break
                token = tokens[state]
                if token >= 0 and (not start or last[start] >= 0):
                    ends.append((start, token))
            # one of them at most may follow; longer ones do so more often
            for start, token in reversed(ends):
                if start:
                    arc = last[start] * size + token
                    found = table.get(arc)
                    if found is None:
                        found = table[arc] = self._arc(last[start], token, NEVER)
                    if not found:
                        continue
                last[end], before[end] = token, start
                break
        if head is None and n > HEAD:
            if len(self.heads) >= CACHED_WORDS:
                self.heads.clear()
            self.heads[s[:HEAD]] = last[: HEAD + 1], before[: HEAD + 1]
        out, end = [], n
        while end:
            if last[end] < 0:
                raise ValueError(f"no path for {s!r}")
            out.append(last[end])
            end = before[end]
        return np.array(out[::-1], "<u4").tobytes()

    def pieces(self, text: str) -> list[str]:
        """Normalises (NFC, lower case) and splits; white space falls away."""
        if text.isascii():
            return self.ascii_split.findall(text.lower())
        return self.split.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.special is None or "<" not in text:
            return b"".join(map(self.words.__getitem__, self.pieces(text)))
        out = []
        for part in self.special.split(text):
            if part in self.added:
                out.append(self.added[part].to_bytes(4, "little"))
            else:
                out += map(self.words.__getitem__, self.pieces(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The labels of the arcs, which a file without a decoder joins by spaces; UTF-8."""
        return b" ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Words(dict):
    """Encoded words; emptied when full, so that it stays small over any number of texts."""

    def __init__(self, automaton: TokenAutomaton):
        self.automaton = automaton

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        ids = self.automaton.encode_word(word)
        if len(word) <= 64:
            self[word] = ids
        return ids


def load_automaton(path: str) -> TokenAutomaton:
    with open(path, encoding="utf-8") as file:
        return TokenAutomaton(file.read())


def encode_documents(docs, tokenizer_path: str, with_ids: bool = False):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs`` (doc_id, text).

    ``with_ids`` adds the ids (array<int>). NULL is an empty text, which has no tokens. Very long texts and words
    take time in proportion. The file at ``tokenizer_path`` is read once by the driver; its automaton, a few megabytes
    whatever the input, is broadcast. Order, repeated rows and other columns don't matter.
    """
    import hashlib

    import pyarrow as pa

    from fusework.llm.textbatch import bounded_batches, pieces, send

    spark = docs.sparkSession
    bounded_batches(spark)
    receive = send(spark, load_automaton(tokenizer_path))
    key = docs.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>" if with_ids else ""

    def work(batches):
        automaton = receive()
        for batch, data, offsets in pieces(batches):
            raw, ids, decoded = data.tobytes(), [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                ids.append(automaton.encode(raw[a:b].decode(errors="replace")))
                decoded.append(hashlib.sha256(automaton.decode(ids[-1])).hexdigest())
            counts = [len(x) // 4 for x in ids]
            arrays = [pa.array(counts, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names[: 1 + len(arrays)])

    schema = f"doc_id {key}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{more}"
    return docs.select("doc_id", "text").mapInArrow(work, schema)
