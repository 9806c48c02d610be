"""Line dedup: lines within one edit of an earlier line, by a deletion-neighbourhood join.

Two lines are linked if at most one insertion, deletion or substitution of a character turns one
into the other. Every line emits hashed keys of its variants: the line with the character at a
position left out, and the line with nothing left out at a position. Lines linked by a
substitution meet where they leave out the same position; lines linked by an insertion meet where
the longer one leaves a character out and the shorter one nothing. All lines of a key are within
one edit of each other, so each is joined with the earliest one only: a key costs one row per line
however many lines share it. The edit distance of every joined pair is verified.

Only lines that can have a partner emit variants: one edit leaves the first or the second half of
a line as it is, so a line whose halves no other line has is passed over. Of the others, one edit
leaves all but one of 16 segments as they are, so variants are emitted at the positions of those
segments only outside of which another line is the same. A key hashes the block around its
position and takes chained hashes of the blocks before and behind it, so that a line costs time in
proportion to its length.

Exact repeats are grouped by digest, whatever the length of the line.

All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearpanel.llm.common import keyed_texts, small
from yearpanel.sources.scratch import materialise

#: Lines with fewer characters (outer blanks aside) are within one edit of others by chance: they go
#: as exact repeats only.
MIN_CHARS = 20
#: A line that has more than white space.
NOT_BLANK = r"(?U)\S"
#: Blocks of the chained hashes have 32 characters.
BLOCK_BITS = 5
#: Segments that positions are narrowed to.
SEGMENTS = 16

PLACE = ["doc_id", "text_key", "line_no"]
DIGEST = ["high", "low"]


def lines_of(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_key, line_no (from 0), line, long, high, low: the lines that take part.

    ``long`` lines are compared by edits, others, which have more than white space, as a whole. The
    digest of 128 bits stands for the line.
    """
    lines = keyed_texts(docs).select("doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)))
    return (
        lines.toDF(*PLACE, "line")
        .withColumn("long", F.char_length(F.trim("line")) >= min_chars)
        .filter(F.col("long") | F.col("line").rlike(NOT_BLANK))
        .withColumn("high", F.xxhash64("line"))
        .withColumn("low", F.xxhash64(F.lit("low"), "line"))
    )


def _halves() -> list[Column]:
    """Keys of which two linked lines share at least one.

    For the smaller length m of the two, either the first m // 2 characters agree or the last
    m - m // 2. A line of n characters may be the longer one, so m is n or n - 1.
    """
    n = F.char_length("line")
    keys = []
    for m in (n, n - 1):
        half = F.shiftright(m, 1)
        keys.append(F.xxhash64(F.lit("first"), m, F.substring(F.col("line"), F.lit(1), half)))
        keys.append(F.xxhash64(F.lit("last"), m, F.right(F.col("line"), m - half)))
    return keys


def distinct_lines(lines: DataFrame) -> DataFrame:
    """high, low, n, place columns of the earliest occurrence and halves of every different line.

    A line that is not long has no halves.
    """
    halves = F.when(F.col("long"), F.array(*_halves())).alias("halves")
    own = lines.select(*DIGEST, F.struct(*PLACE, halves).alias("own"))
    grouped = own.groupBy(*DIGEST).agg(F.min("own").alias("own"), F.count("*").alias("n"))
    return grouped.select(*DIGEST, "n", "own.*")


def candidates(different: DataFrame, lines: DataFrame) -> DataFrame:
    """Place and text of the different lines that share a half with another one."""
    halves = different.select(*PLACE, F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    places = halves.join(small(materialise(shared, "line-halves")), "half", "left_semi")
    places = materialise(places.select(*PLACE).distinct(), "line-candidates")
    return lines.join(small(places), PLACE, "left_semi").select(*PLACE, "line").dropDuplicates(PLACE)


def _share(length: Column, k: Column) -> Column:
    return F.floor(length * k / SEGMENTS).cast("int")


def segments(near: DataFrame) -> DataFrame:
    """place, line, m, low, high: positions in which a line may differ from another one by an edit.

    ``m`` is the length of the shorter of the two, the line's own or one less. Both lines have the
    same characters before ``low`` and the same ones behind ``high``, counted from the end.
    """
    n = F.char_length("line")

    def segment(m: Column, k: Column) -> Column:
        low, high = _share(m, k), _share(m, k + 1)
        head = F.substring(F.col("line"), F.lit(1), low)
        tail = F.right(F.col("line"), m - high)
        key = F.xxhash64(m, k, head, tail)
        return F.struct(m.alias("m"), low.alias("low"), high.alias("high"), key.alias("key"))

    def every(m: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)), lambda k: segment(m, k))

    both = F.concat(every(n), every(n - 1))
    own = near.select(*PLACE, F.inline(both))
    shared = own.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    found = own.join(small(materialise(shared, "line-segments")), "key", "left_semi")
    return found.drop("key").join(near, PLACE)


def _chain(blocks: str) -> Column:
    """Hashes of the first 0, 1, 2, ... blocks."""
    start = F.lit(42).cast("long")
    return F.aggregate(
        blocks,
        F.struct(F.array(start).alias("all"), start.alias("last")),
        lambda held, block: F.struct(
            F.array_append(held["all"], F.xxhash64(held["last"], block)).alias("all"),
            F.xxhash64(held["last"], block).alias("last"),
        ),
        lambda held: held["all"],
    )


def variants(lines: DataFrame) -> DataFrame:
    """Place and key: a row for each line and variant.

    A variant is known by its length, its position, the whole blocks before the position counted
    from the start, the whole blocks behind it counted from the end, and the characters between.
    ``lines`` are those of ``segments``: the shorter of two lines leaves out a character, for a
    substitution, or nothing; the longer one leaves out a character.
    """
    n = F.char_length("line")
    tile = F.lit(f"(?s).{{1,{1 << BLOCK_BITS}}}")

    def part(blocks: str, length: Column) -> tuple[Column, Column]:
        """Number of whole blocks of a length, and the characters beyond them."""
        number = F.shiftright(length, BLOCK_BITS)
        block = F.coalesce(F.get(blocks, number), F.lit(""))
        return number, F.substring(block, F.lit(1), length - F.shiftleft(number, BLOCK_BITS))

    def key(position: Column, length: Column) -> Column:
        before, head = part("forward", position)
        behind, tail = part("backward", length - position)
        chains = F.get("forward_hash", before), F.get("backward_hash", behind)
        return F.xxhash64(length, position, *chains, head, tail)

    tiled = lines.select(
        *PLACE,
        "line",
        "m",
        F.sequence("low", "high").alias("positions"),
        F.regexp_extract_all("line", tile, F.lit(0)).alias("forward"),
        F.regexp_extract_all(F.reverse("line"), tile, F.lit(0)).alias("backward"),
    ).withColumns({"forward_hash": _chain("forward"), "backward_hash": _chain("backward")})
    inner = F.filter("positions", lambda p: p < n)
    without = F.transform(inner, lambda p: key(p, n - 1))
    whole = F.when(n == F.col("m"), F.transform("positions", lambda p: key(p, n)))
    keys = F.concat(without, F.coalesce(whole, F.array().cast("array<bigint>")))
    return tiled.select(*PLACE, F.explode(keys).alias("key")).distinct()


def linked(near: DataFrame) -> DataFrame:
    """The places of ``candidates`` that have an earlier line within one edit."""
    place = F.struct(*PLACE)
    keys = materialise(variants(segments(near)), "line-variants")
    heads = (
        keys.groupBy("key")
        .agg(F.min(place).alias("head"), F.max(place).alias("last"))
        .filter("head < last")
        .select("key", "head")
    )
    pairs = (
        keys.join(small(materialise(heads, "line-heads")), "key")
        .filter(F.col("head") < place)
        .select(*PLACE, "head")
        .distinct()
    )
    other = near.select(place.alias("head"), F.col("line").alias("head_line"))
    return (
        pairs.join(near, PLACE)
        .join(other, "head")
        .filter(F.levenshtein("line", "head_line", 1) >= 0)
        .select(*PLACE)
        .distinct()
    )


def removals(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_key, gone: the numbers of a document's lines that go. Only where there are any.

    A line goes if a line at an earlier place is equal to it or, for lines of ``min_chars`` and
    more, within one edit, whether or not that one goes itself. Blank lines stay. Places are ordered by
    doc_id, then text_key, then line; rows that repeat whole share their places and keep what they
    have.
    """
    lines = lines_of(docs, min_chars)
    different = materialise(distinct_lines(lines), "lines")
    near = materialise(candidates(different, lines), "line-texts")
    late = linked(near).withColumn("late", F.lit(True))
    suspect = (
        different.join(late, PLACE, "left")
        .filter("late or n > 1")
        .select(*DIGEST, "late", F.struct(*PLACE).alias("first"))
    )
    return (
        lines.select(*PLACE, *DIGEST)
        .join(small(materialise(suspect, "line-suspects")), DIGEST)
        .filter(F.col("late") | (F.col("first") < F.struct(*PLACE)))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("line_no").alias("gone"))
    )


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_key, kept_text, n_lines, n_removed, one row per row with a doc_id.

    A null or empty text is one empty line, which stays. Rows without a doc_id have no place and
    are left out. Texts without a line to remove stay as they are, line breaks included. Other
    columns are dropped. An empty table gives no row.
    """
    gone = materialise(removals(docs, min_chars), "line-removals")
    split = F.split("text", "\n", -1)
    kept = F.filter(split, lambda _, k: ~F.array_contains("gone", k))
    return (
        keyed_texts(docs)
        .join(gone, ["doc_id", "text_key"], "left")
        .select(
            "doc_id",
            "text_key",
            F.when(F.col("gone").isNull(), F.col("text"))
            .otherwise(F.array_join(kept, "\n"))
            .alias("kept_text"),
            F.size(split).cast("long").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        )
    )


def digests(result: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256."""
    return result.select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
