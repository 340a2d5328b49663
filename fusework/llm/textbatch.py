"""What the operators share: text in bounded pieces of bytes, word hashes, stored intermediate tables.

Texts reach Python as Arrow batches. A piece is a run of rows of one batch with at most
``PIECE_BYTES`` of text (one row at least), so memory depends neither on the number of rows of a
batch nor on the size of a partition. Hashes are 64-bit polynomials over UTF-8 bytes, taken from
prefix sums, so that a piece needs a few NumPy passes and no loop over words.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PIECE_BYTES = 2 << 20
BATCH_BYTES = 16 << 20
BITMAP_BITS = 32_768  # of a bitmap that Spark's bitmap functions make
MOST_BITMAPS = 1 << 14
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_POWERS: dict[str, np.ndarray] = {}


def spaces() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


SPACES = spaces()


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Arrow batches of this session end at a number of bytes, not only at a number of rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the one that all executors share; a temporary one only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it: later steps survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more, as all that was made of them is stored too."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path.getParent(), True)


def perhaps_in(df: DataFrame, ids: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """``df`` with a column ``perhaps``: false only where ``ids``, of ``n`` rows, surely has no row with the same ``keys``.

    Rows with wide columns can so be told from the few that a join by ``keys`` is about before they are shuffled. An id sets one
    of 16 bits or more that there are for it, in broadcast bitmaps of 4 KB; beyond 64 MB of them more rows are in doubt.
    """
    spots = F.lit(BITMAP_BITS * min(1 << max(0, (16 * n // BITMAP_BITS).bit_length()), MOST_BITMAPS)).cast("bigint")

    def placed(rows: DataFrame) -> DataFrame:
        spot = F.pmod(F.xxhash64(*keys), spots)
        return rows.withColumns({"__map": F.floor(spot / BITMAP_BITS).cast("int"), "__bit": (spot % BITMAP_BITS).cast("int")})

    # all rows of a bitmap meet first, so that no task sends a bitmap of its own for each
    bits = placed(ids).select("__map", "__bit").repartition("__map")
    maps = bits.groupBy("__map").agg(F.bitmap_construct_agg(F.col("__bit").cast("bigint")).alias("__bits"))
    byte = F.substring("__bits", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))
    known = F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), F.col("__bit") % 8) == 1
    joined = placed(df).join(F.broadcast(maps), "__map", "left")
    return joined.select(*df.columns, F.coalesce(known, F.lit(False)).alias("perhaps"))


def send(spark: SparkSession, model):
    """Broadcasts an object's plain state, so that executors need no copy of this package.

    Gives a function that tasks call for the object; a worker builds it once and keeps it.
    """
    state = model.__getstate__() if hasattr(type(model), "_prepare") else dict(vars(model))
    shared, kind = spark.sparkContext.broadcast({"state": state}), type(model)

    def receive():
        held = shared.value
        if "object" not in held:
            held["object"] = built = kind.__new__(kind)
            built.__dict__.update(held["state"])
            if hasattr(kind, "_prepare"):
                built._prepare()
        return held["object"]

    return receive


def words_column(text: Column) -> Column:
    """The words of a text as an array; empty for NULL and for text without words."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of each piece of at most ``size`` bytes, or one row; NULL texts have no bytes."""
    for batch in batches:
        values = batch.column(column)
        if values.null_count:
            values = pc.fill_null(values, "")
        values = values.cast(pa.large_string())
        bounds = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
        if not len(values):
            continue
        buffer = values.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
        row = 0
        while row < len(values):
            stop = int(np.searchsorted(bounds, bounds[row] + size, "right")) - 1
            stop = min(max(stop, row + 1), len(values))
            yield batch.slice(row, stop - row), data[bounds[row] : bounds[stop]], bounds[row : stop + 1] - bounds[row]
            row = stop


def powers(n: int, inverse: bool = False) -> np.ndarray:
    name = "inverse" if inverse else "base"
    if name not in _POWERS or len(_POWERS[name]) < n:
        factor = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        steps = np.full(max(n, 1024), factor & _MASK, np.uint64)
        steps[0] = 1
        _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[name][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal bytes give equal hashes wherever they stand."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(len(data) + 1, inverse=True)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row of each word) of all words of a piece, in order."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~SPACES[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[1:-1][cuts]
    last[cuts - 1] = inside[1:-1][cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def shingle_hashes(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``size`` words; a row with fewer words, but some, is one shingle."""
    counts = np.bincount(rows, minlength=n_rows)
    if len(words) >= size:
        total = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            total = total * np.uint64(0x100000001B3) + words[k : len(words) - size + 1 + k]
        whole = rows[: len(total)] == rows[size - 1 :]
        hashes, owner = mix(total[whole]), rows[: len(total)][whole]
    else:
        hashes, owner = np.zeros(0, np.uint64), np.zeros(0, rows.dtype)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.searchsorted(rows, short)
        extra = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = counts[short] > k
            extra[has] = extra[has] * np.uint64(0x100000001B3) + words[first[has] + k]
        hashes = np.concatenate([hashes, mix(extra + counts[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    return hashes, owner
