"""Best-fit packing of tokenized documents into sequences, certified by dual feasible functions.

Documents longer than a sequence are cut; the pieces are dealt into groups of bounded size, each with an even
share of every length, and each group is packed by best-fit decreasing. A dual feasible function f maps sizes to [0, 1] such that
pieces that fit into one sequence have values of at most 1 together, so the sum of f over a group's pieces is a
lower bound of its number of sequences. The best of three families certifies the group: where the bound is met
exactly all its sequences stay. Where only rounding up parts them, the emptiest sequence is opened; where there is a gap,
all sequences with room are, and as many full ones of small pieces. The pieces of opened sequences of all groups are dealt anew, into fewer groups, and
packed again, for as long as that saves sequences.
"""

from __future__ import annotations

import json
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from fusework.llm.bpe import byte_symbols
from fusework.llm.textbatch import bounded_batches, stored

CAPACITY = 2048
GROUP_PIECES = 65_536  # pieces of a group on average; a task holds one group, about 10 MB
STRATUM = 65_536  # pieces of one length that are numbered in one task, on average
ROUNDS = 12  # each deals out what the one before opened; on the whole a small share of its pieces
DIVISIONS = 64  # functions of the second family

# Fixed value: the splitting pattern of the tokenizer file's family.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_level_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(id of each token's bytes, id of each special token) of a byte-level BPE file, whose ids follow its merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    known = spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["pre_tokenizer"]["add_prefix_space"] and not spec["normalizer"]
    if not known or any(model["vocab"][a + b] != 256 + k for k, (a, b) in enumerate(merges)):
        raise ValueError("a byte-level BPE file with ids in the order of merges is needed")
    values = {c: b for b, c in enumerate(byte_symbols())}
    return {bytes(values[c] for c in s): k for s, k in model["vocab"].items() if s not in special}, special


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the pieces of every row of ``docs`` (doc_id, text).

    A document is the ids of its whole text and then ``end``, so NULL and empty texts have one id. Longer ones than
    ``capacity`` are cut into pieces of that length, of which only the first may be shorter. ``with_ids`` adds the
    ids (array<int>). Repeated rows and other columns don't matter.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    ranks, special = byte_level_ranks(tokenizer_path)
    shared = spark.sparkContext.broadcast({"ranks": ranks, "special": special})
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        import tiktoken

        held = shared.value
        if "encoding" not in held:
            held["encoding"] = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=held["ranks"], special_tokens=held["special"])
        encode, last = held["encoding"].encode_to_numpy, np.array([end], "<u4")
        for batch in batches:
            owner, rows, ids = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                tokens = np.concatenate([encode(text or "", allowed_special="all").astype("<u4"), last])
                cuts = list(range(len(tokens), 0, -capacity))[::-1]
                for piece, (a, b) in enumerate(zip([0, *cuts[:-1]], cuts)):
                    owner.append(row)
                    rows.append((piece, a, b - a, zlib.crc32(tokens[a:b].tobytes())))
                    if with_ids:
                        ids.append(tokens[a:b].astype(np.int32))
            columns = list(zip(*rows)) or [()] * 4
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(owner, pa.int64())), *arrays], names[: 1 + len(arrays)])

    more = ", ids array<int>" if with_ids else ""
    schema = f"doc_id {key}, piece int, start bigint, length bigint, ids_crc32 bigint{more}"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """(sequence, offset) of each length, given in decreasing order, and the number of sequences."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # open sequences by what is left in them
    open_rooms = count = 0  # the bits of a number say which rooms there are
    sequences, offsets = [], []
    for length in lengths:
        fits = open_rooms >> length
        if fits:
            left = length + (fits & -fits).bit_length() - 1
            sequence = room[left].pop()
            if not room[left]:
                open_rooms ^= 1 << left
        else:
            left, sequence = capacity, count
            count += 1
        sequences.append(sequence)
        offsets.append(capacity - left)
        if left > length:
            room[left - length].append(sequence)
            open_rooms |= 1 << (left - length)
    return sequences, offsets, count


def dual_functions(capacity: int):
    """(values of the sizes 0 to ``capacity``, what they are parts of) of the dual feasible functions, as whole numbers.

    The size itself; sizes over capacity - e count whole and those under e nothing; rounding to kth parts; the
    complement of a large size in units of e.
    """
    size = np.arange(capacity + 1)
    yield size, capacity
    for e in range(1, capacity // 2 + 1):
        yield np.where(size > capacity - e, capacity, np.where(size < e, 0, size)), capacity
    for k in range(1, DIVISIONS + 1):
        parts, rest = np.divmod((k + 1) * size, capacity)
        yield np.where(rest == 0, k * size, capacity * parts), k * capacity
    for e in range(1, capacity // 2 + 1):
        units = capacity // e
        yield np.where(2 * size > capacity, units - (capacity - size) // e, (size >= e).astype(np.int64)), units


class Bounds:
    """The dual functions of one capacity as a matrix, built once a worker."""

    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def of(cls, lengths: np.ndarray, capacity: int) -> Fraction:
        """The largest of the lower bounds of the number of sequences, not rounded."""
        if capacity not in cls.held:
            values, units = zip(*dual_functions(capacity))
            cls.held[capacity] = np.stack(values).astype(np.int32), np.array(units)
        values, units = cls.held[capacity]
        counts = np.bincount(lengths, minlength=capacity + 1)
        some = np.flatnonzero(counts)
        sums = values[:, some].astype(np.int64) @ counts[some]
        # near the largest, compare exactly
        share = sums / units
        best = np.flatnonzero(share >= share.max() * (1 - 1e-9))
        return max(Fraction(int(sums[k]), int(units[k])) for k in best)


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """(sequence, offset, opened) of each length, the number of sequences and the certified bound."""
    order = np.argsort(-lengths, kind="stable")
    sequences, offsets, count = best_fit_decreasing(lengths[order].tolist(), capacity)
    sequence, offset = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    sequence[order], offset[order] = sequences, offsets
    least = Bounds.of(lengths, capacity)
    bound = -(-least.numerator // least.denominator)
    fill = np.bincount(sequence, lengths, count)
    opened = np.zeros(count, bool)
    if count > bound:
        opened = fill < capacity
        # and as many full ones, of the smallest pieces, which fit what the others have left
        small = np.lexsort((-np.bincount(sequence, minlength=count), opened))
        opened[small[: int(opened.sum())]] = True
    elif count > least:
        opened[np.argmin(fill)] = True
    return sequence, offset, opened[sequence], count, bound


def _dealt(pieces: DataFrame, groups: int, turn: int) -> DataFrame:
    """``pieces`` with a group, each of which gets an even share of every length."""
    if groups == 1:
        return pieces.withColumn("group", F.lit(0).cast("long"))
    # one row a length, as many as a sequence has places at most
    lengths = pieces.groupBy("length").agg(F.ceil(F.count(F.lit(1)) / F.lit(STRATUM)).alias("parts"))
    part = F.pmod(F.xxhash64("uid", F.lit(turn)), F.col("parts"))
    rows = pieces.join(F.broadcast(lengths), "length").withColumn("part", part)
    place = F.row_number().over(W.partitionBy("length", "part").orderBy("uid"))
    group = F.pmod(place + F.xxhash64("length", "part", F.lit(turn)), F.lit(groups))
    return rows.withColumn("group", group).select(*pieces.columns, "group")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with sequence_id and offset; every row and column stays.

    ``length`` lies between 1 and ``capacity``. Sequence ids are any numbers, offsets have no gaps. Repeated rows are
    placed one by one. An empty table stays empty.
    """
    names = pieces.columns
    boxed = pieces.select(F.struct("*").alias("row"), F.col("length").cast("long").alias("length"))
    rest = stored(boxed.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    schema = rest.schema.simpleString()[len("struct<"):-1]
    out_schema = f"{schema}, sequence_id bigint, offset bigint, opened boolean, sequences bigint, bound bigint"
    done, used = [], None
    for turn in range(rounds):
        groups = max(1, -(-rest.count() // group_pieces))

        def pack(key, table, turn=turn):
            lengths = table.column("length").to_numpy()
            sequence, offset, opened, _, bound = pack_group(lengths, capacity)
            ids = (turn << 56) + (key[0].as_py() << 24) + sequence
            # the numbers of a group stand in one of its rows
            first = np.zeros(len(lengths), np.int64)
            first[0] = len(np.unique(sequence[opened]))
            least = np.zeros(len(lengths), np.int64)
            least[0] = bound
            for name, column in (("sequence_id", ids), ("offset", offset), ("opened", opened), ("sequences", first), ("bound", least)):
                table = table.append_column(name, pa.array(column))
            return table

        packed = _dealt(rest, groups, turn).groupBy("group").applyInArrow(lambda key, table: pack(key, table.drop(["group"])), out_schema)
        packed = stored(packed, f"packed-{turn}")
        now = packed.agg(F.countDistinct("sequence_id").alias("used"), F.sum("sequences").alias("opened")).first()
        if used is not None and now.used >= used:
            break  # dealing out anew saved nothing: what was opened stays as it was
        if done:
            done[-1] = done[-1].where("NOT opened")
        done.append(packed)
        used = now.opened
        if not used or groups == 1:
            break
        rest = packed.where("opened").select(*rest.columns)
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.select(*[F.col("row").getField(c).alias(c) for c in names], "sequence_id", "offset")
