"""Line deduplication over a corpus by a segment-partition edit join, in DataFrame operations only.

Equal lines are folded first. Of the different lines, those of ``MIN_CHARS`` characters or more are
cut into ``EDITS + 1`` segments: if two lines are within ``EDITS`` edits, one segment of the shorter
stands unchanged in the longer, and no further off its place than the edits before and after allow.
So each line is indexed by its segments, and probes, for its own and each shorter length, the
substrings at those places. Pairs that meet are verified with a banded bit-parallel edit distance:
the 2 * EDITS + 1 diagonals that matter are the bits of one number, moved a column at a time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fusework.llm.textbatch import stored

EDITS = 2
MIN_CHARS = 20
BROADCAST_KEYS = 2_000_000  # 8 bytes each; more keys are joined by a shuffle

# Characters that are counted per line; an edit changes two of the counts by one at most.
CLASSES = (
    "[aàáâä]", "[eèéê]", "[iíìï]", "[oóöô]", "[uúüù]", "n", "r", "s", "t", "[hjk]", "[dñ]", "[lßç]", "[cm]", "[gw]", "[bvpf]", "[ yxqz]",
    "[A-Z]", "[.,;:!?0-9]",
)


def segment_places(length: int, edits: int = EDITS) -> list[tuple[int, int]]:
    """(start, length) of the segments of a line of ``length`` characters, from 0; the last are longer."""
    size, longer = divmod(length, edits + 1)
    out, at = [], 0
    for i in range(edits + 1):
        n = size + (i >= edits + 1 - longer)
        out.append((at, n))
        at += n
    return out


def probe_shifts(edits: int = EDITS) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift): where segments of a line can stand in one that is longer.

    With i segments before and edits - i after, the shift is at most i and leaves at most edits - i
    for the rest: max(-i, diff - (edits - i)) <= shift <= min(i, diff + edits - i).
    """
    return [
        (diff, i, shift)
        for diff in range(edits + 1) for i in range(edits + 1)
        for shift in range(max(-i, diff - (edits - i)), min(i, diff + edits - i) + 1)
    ]


def _place(size: Column, longer: Column, i: int, edits: int) -> tuple[Column, Column]:
    """Start (from 0) and size of segment i as columns, as ``segment_places`` has them for a line of ``size`` and ``longer``."""
    least = edits + 1 - i  # segment i is a longer one if there are so many
    before = F.greatest(F.lit(0), longer - least) if i else F.lit(0)
    return size * i + before, size + (longer >= least).cast("int")


def _cuts(lines: DataFrame, edits: int) -> DataFrame:
    """``lines`` (line, n) with ``size<d>`` and ``longer<d>``: the size of the segments of a line d shorter, and how many have one more.

    They are columns, as the optimizer would else write them into every key: the JVM compiles no method of over 8,000 bytes,
    and runs the loop over the lines as byte code.
    """
    parts, columns = edits + 1, {}
    for diff in range(edits + 1):
        length = F.col("n") - diff
        columns |= {f"size{diff}": F.floor(length / parts).cast("int"), f"longer{diff}": (length % parts).cast("int")}
    return lines.withColumns(columns)


def edit_distance(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Edit distance of two arrays of characters if it is at most ``edits``, else a larger number.

    ``b`` is as long as ``a`` or up to ``edits`` longer. Bit k in column j stands for row j - edits + k
    of the matrix; vp and vn are the vertical differences of +1 and -1, d0 the diagonal steps without
    cost. The cost follows the diagonal that ends in the last cell.
    """
    width = 2 * edits + 1
    wide, one = F.lit((1 << width) - 1).cast("long"), F.lit(1).cast("long")
    goal = F.lit(edits) - (F.size(b) - F.size(a))  # the bit of that diagonal

    def flipped(x: Column) -> Column:
        return F.bitwise_not(x).bitwiseAND(wide)

    def diagonals(acc: Column, j: Column) -> Column:
        ch = F.get(b, j - 1)
        same = reduce(
            lambda x, y: x + y,
            [F.when(F.get(a, j - 1 - edits + k) == ch, F.lit(1 << k)).otherwise(F.lit(0)) for k in range(width)],
        ).cast("long")
        carry = (same.bitwiseAND(acc["vp"]) + acc["vp"]).bitwiseAND(wide)
        d0 = carry.bitwiseXOR(acc["vp"]).bitwiseOR(same).bitwiseOR(acc["vn"])
        return F.struct(d0.alias("d0"), acc["vp"].alias("vp"), acc["vn"].alias("vn"), acc["cost"].alias("cost"))

    def verticals(now: Column) -> Column:
        hp = now["vn"].bitwiseOR(flipped(now["d0"].bitwiseOR(now["vp"])))
        hn = now["d0"].bitwiseAND(now["vp"])
        down = F.shiftrightunsigned(now["d0"], 1)
        at_goal = reduce(
            lambda x, k: F.when(goal == k, F.shiftrightunsigned(now["d0"], k)).otherwise(x), range(1, edits + 1), now["d0"]
        )
        return F.struct(
            hn.bitwiseOR(flipped(down.bitwiseOR(hp))).alias("vp"), down.bitwiseAND(hp).alias("vn"),
            (now["cost"] + one - at_goal.bitwiseAND(one)).alias("cost"),
        )

    start = F.struct(
        F.lit(((1 << width) - 1) ^ ((1 << edits) - 1)).cast("long").alias("vp"),
        F.lit(0).cast("long").alias("vn"), F.lit(0).cast("long").alias("cost"),
    )
    # the inner transform holds the diagonal bits, which the second half needs several times
    cost = F.aggregate(
        F.sequence(F.lit(1), F.size(b)), start,
        lambda acc, j: F.get(F.transform(F.array(diagonals(acc, j)), verticals), 0),
        lambda acc: acc["cost"],
    )
    return F.when(F.size(b) == 0, F.lit(0).cast("long")).otherwise(cost)


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, uid, line_no (from 0), line of every line with a word; uid tells rows with one doc_id apart."""
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("uid"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def _keys(edits: int) -> tuple[list[Column], list[Column]]:
    """Hashes of what a line (line, n, and its ``_cuts``) is indexed by, and of what it probes for."""

    def key(diff: int, i: int, shift: int = 0) -> Column:
        start, size = _place(F.col(f"size{diff}"), F.col(f"longer{diff}"), i, edits)
        return F.xxhash64(F.col("n") - diff, F.lit(i), F.substring(F.col("line"), start + (1 + shift), size))

    return [key(0, i) for i in range(edits + 1)], [key(*probe) for probe in probe_shifts(edits)]


def _contested_lines(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """h, h2, line, n of the different lines that share a key with another line.

    Nearly every key belongs to one line. Only the smallest and the largest line of a key are
    gathered, which shuffles numbers and no text, however often a line stands in the corpus.
    """
    index, probes = _keys(edits)
    lines = _lines(docs).select(*_hashes(), "line", F.char_length("line").cast("int").alias("n")).where(F.col("n") >= min_chars)
    # an index key is also a probe key of length difference 0 and shift 0
    keyed = _cuts(lines, edits).select("h", "h2", "line", "n", F.explode(F.array(*probes)).alias("key"))
    contested = stored(
        keyed.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low < high").select("key"), "contested"
    )
    if contested.count() <= BROADCAST_KEYS:
        found = keyed.join(F.broadcast(contested), "key", "left_semi")
    else:
        wanted = keyed.select("h", "key").join(contested, "key", "left_semi").select("h").distinct()
        found = lines.join(wanted, "h", "left_semi")
    return stored(found.groupBy("h", "h2").agg(F.first("line").alias("line"), F.first("n").alias("n")), "lines")


def _close_lines(lines: DataFrame, edits: int) -> DataFrame:
    """h, h2, h_b, h2_b, edits of the pairs of ``lines`` within ``edits`` edits."""
    index, probes = _keys(edits)
    counts = [F.regexp_count("line", F.lit(c)).alias(f"c{k}") for k, c in enumerate(CLASSES)]
    known = _cuts(lines.select("h", "h2", "line", "n", F.array(*counts).alias("counts")), edits)
    left = known.select("h", "h2", "n", "counts", F.explode(F.array(*index)).alias("key"))
    right = known.select(
        F.col("h").alias("h_b"), F.col("h2").alias("h2_b"), F.col("n").alias("n_b"), F.col("counts").alias("counts_b"),
        F.explode(F.array(*probes)).alias("key"),
    )
    off = reduce(lambda x, y: x + y, [F.abs(F.get("counts", k) - F.get("counts_b", k)) for k in range(len(CLASSES))])
    met = (
        left.join(right, "key")
        .where((F.col("n") < F.col("n_b")) | (F.col("h") < F.col("h_b"))).where(off <= 2 * edits)
        .select("h", "h2", "h_b", "h2_b").distinct()
    )
    # split below the joins: above them the optimizer would split anew for each character compared
    short = lines.select("h", "h2", F.split("line", "").alias("a"))
    long = lines.select(F.col("h").alias("h_b"), F.col("h2").alias("h2_b"), F.split("line", "").alias("b"))
    pairs = met.join(short, ["h", "h2"]).join(long, ["h_b", "h2_b"])
    # what both lines begin and end with costs nothing and is cut off first; each step is stored, as the
    # optimizer would else write one step's expressions into every use of them in the next
    head, tail = _common(F.col("a"), F.col("b")), _common(F.reverse("a"), F.reverse("b"))
    names = ["h", "h2", "h_b", "h2_b"]
    pairs = stored(pairs.select(*names, "a", "b", head.alias("head"), tail.alias("tail")), "ends")
    rest = F.least(F.col("tail"), F.least(F.size("a"), F.size("b")) - F.col("head"))
    pairs = stored(
        pairs.select(*names, *[F.slice(x, F.col("head") + 1, F.size(x) - F.col("head") - rest).alias(x) for x in ("a", "b")]), "middles"
    )
    return pairs.select("h", "h2", "h_b", "h2_b", edit_distance(F.col("a"), F.col("b"), edits).alias("edits")).where(F.col("edits") <= edits)


def _common(a: Column, b: Column) -> Column:
    """Length of the longest common beginning of two arrays of characters."""
    first = F.array_position(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), True).cast("int")
    return F.when(first > 0, first - 1).otherwise(F.size(a))


def removed_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row for each line to remove: doc_id, uid, line_no, kept_doc_id, kept_line_no, edits.

    A line goes if an equal line, or one within ``edits`` edits where both have ``min_chars``
    characters or more, comes before it by (doc_id, uid, line_no); NULL ids come first. The kept line is
    the first of these. Lines without a word stay. Rows equal in id and text are one document. NULL
    texts have no lines.
    """
    own = F.struct("doc_id", "uid", "line_no")
    places = stored(_lines(docs).select(*_hashes(), "doc_id", "uid", "line_no"), "places")
    distinct = places.groupBy("h", "h2").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n_lines"))
    close = stored(_close_lines(_contested_lines(docs, edits, min_chars), edits), "pairs")
    # both directions: what each of the two lines has near it, and where that stands first
    near = close.union(close.select("h_b", "h2_b", "h", "h2", "edits"))
    firsts = distinct.select(F.col("h").alias("h_b"), F.col("h2").alias("h2_b"), F.col("first").alias("other"))
    nearest = near.join(firsts, ["h_b", "h2_b"]).groupBy("h", "h2").agg(F.min(F.struct("other", "edits")).alias("near"))
    classes = distinct.join(nearest, ["h", "h2"], "left").select(
        "h", "h2", "n_lines", F.col("first").alias("own"), F.when(F.col("near.other") < F.col("first"), F.col("near")).alias("earlier")
    ).where("n_lines > 1 OR earlier IS NOT NULL")
    goes = places.join(classes, ["h", "h2"]).where(F.col("earlier").isNotNull() | ~own.eqNullSafe(F.col("own")))
    to = F.coalesce(F.col("earlier.other"), F.col("own"))
    return goes.select(
        "doc_id", "uid", "line_no", to["doc_id"].alias("kept_doc_id"), to["line_no"].alias("kept_line_no"),
        F.coalesce(F.col("earlier.edits"), F.lit(0)).alias("edits"),
    ).distinct()


def _hashes() -> list[Column]:
    """Two independent hashes of a line: together its identity, the first alone its short name."""
    return [F.xxhash64("line").alias("h"), F.xxhash64(F.lit("second"), F.col("line")).alias("h2")]


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, whole: str | None = None) -> DataFrame:
    """``docs`` with the removed lines cut out of ``text`` and ``n_chars``, if it has it, counted anew.

    Every row stays, with all its columns; a text may become empty. NULL texts stay NULL. ``whole`` names a
    column to add: the text with all its lines.
    """
    gone = removed_lines(docs.select("doc_id", "text"), edits, min_chars).groupBy("uid").agg(F.collect_set("line_no").alias("gone"))
    boxed = docs.select(F.struct("*").alias("doc"), F.xxhash64("doc_id", "text").alias("uid"))
    joined = boxed.join(gone, "uid", "left")
    lines = F.split(F.col("doc.text"), "\n")
    flags = F.map_from_arrays(F.col("gone"), F.transform("gone", lambda x: F.lit(True)))
    kept = F.filter(lines, lambda x, i: F.element_at(flags, i).isNull())
    text = F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(F.array_join(kept, "\n"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("_text").alias(name))
        elif name == "n_chars":
            columns.append(F.char_length("_text").cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col("doc").getField(name).alias(name))
    if whole:
        columns.append(F.col("doc.text").alias(whole))
    return joined.withColumn("_text", text).select(*columns)
