"""Exact dedup: two passes over a Bloom filter, so only possibly repeated rows shuffle.

Pass one counts 64-bit text hashes by filter slot (8 bytes a row, summed before the
shuffle) and keeps the slots hit at least twice as bitmaps.  Pass two tests every row
against the bitmaps: a row in a slot hit once is alone and passes straight through; the
others meet by the SHA-256 of their whole text.  A shared slot costs work, never a result.

A filter larger than a broadcast is joined with stubs, (row number, slot) of every row, not
with the rows: the stubs that hit become bitmaps of row numbers, 128 times smaller than the
stubs, and the rows are tested against those in broadcasts of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import materialize, text_or_empty

#: Bits of the filter for each row, and the bits one bitmap row holds (4 KB).
BITS_PER_ROW = 16
BITMAP_BITS = 32768
#: The filter is broadcast up to this size (32M rows); of a larger one only stubs are joined, and the
#: bitmaps of row numbers are broadcast in parts of this size (512M rows each).
BROADCAST_BYTES = 64 << 20
#: The stubs of one bitmap of the filter are dealt to so many join keys, as a hot text is one slot.
SALTS = 16


def normalized(text: str = "text") -> Column:
    """The text with each run of ``[\\x20\\x09-\\x0D]`` as one space; null counts as empty.

    Lone spaces, the common case, are left untouched instead of being replaced by themselves.
    """
    return F.regexp_replace(
        text_or_empty(text), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " "
    )


def repeated_slots(hashes: DataFrame, n_bits: int) -> DataFrame:
    """(bitmap_no, bitmap) of the filter slots that at least two rows of ``hashes`` hit."""
    return (
        hashes.select(F.pmod("_h", F.lit(n_bits)).alias("slot"))
        .groupBy("slot")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .groupBy(F.expr(f"slot div {BITMAP_BITS}").alias("bitmap_no"))
        .agg(F.bitmap_construct_agg(F.col("slot") % BITMAP_BITS).alias("bitmap"))
    )


def _bit(bitmap: str, position: Column) -> Column:
    """Whether the bit at ``position`` of a bitmap is set; false without a bitmap."""
    at = position % BITMAP_BITS
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0, F.lit(False))


def _number(position: str) -> Column:
    return F.expr(f"{position} div {BITMAP_BITS}")


def _test_rows(hashed: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``hashed`` plus _maybe, for a filter that one broadcast holds."""
    tested = hashed.join(F.broadcast(bitmaps), _number("_slot") == F.col("bitmap_no"), "left")
    return tested.withColumn("_maybe", _bit("bitmap", F.col("_slot"))).drop("bitmap_no", "bitmap", "_slot")


def _test_stubs(hashed: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``hashed`` plus _maybe, for a filter of any size: no row of ``hashed`` is shuffled.

    The rows are numbered and written once, as their numbers must not change between the two reads.
    """
    stored = materialize(hashed.withColumn("_row", F.monotonically_increasing_id()), "hashed")
    salted = bitmaps.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    stubs = stored.select("_row", "_slot", _number("_slot").alias("bitmap_no"), F.pmod(F.col("_row"), F.lit(SALTS)).cast("int").alias("salt"))
    hits = stubs.join(salted, ["bitmap_no", "salt"]).filter(_bit("bitmap", F.col("_slot"))).select(_number("_row").alias("rows_no"), "_row")
    marks = hits.groupBy("rows_no").agg(F.bitmap_construct_agg(F.col("_row") % BITMAP_BITS).alias("rows_map"))
    marks = materialize(marks, "possible-repeats")
    in_part = max(1, BROADCAST_BYTES * 8 // BITMAP_BITS)
    parts = max(1, -(-marks.count() // in_part))
    tested = stored.withColumn("_maybe", F.lit(False))
    for part in range(parts):
        own = marks.filter(F.pmod(F.xxhash64("rows_no"), F.lit(parts)) == part)
        tested = tested.join(F.broadcast(own), _number("_row") == F.col("rows_no"), "left")
        tested = tested.withColumn("_maybe", F.col("_maybe") | _bit("rows_map", F.col("_row"))).drop("rows_no", "rows_map")
    return tested.drop("_row", "_slot")


def mark_repeats(docs: DataFrame, text: str, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """``columns`` of ``docs`` plus _sha, cut in two frames: rows that are surely alone, and the rest.

    The rest also has _keep (smallest key of the equal texts) and _n (rows with that text).
    A null key counts as the largest; texts whose keys are all null have a null _keep.
    """
    norm = normalized(text)
    n_rows = docs.count()
    n_bits = max(BITMAP_BITS, 1 << (BITS_PER_ROW * max(1, n_rows) - 1).bit_length())
    bitmaps = materialize(repeated_slots(docs.select(F.xxhash64(norm).alias("_h")), n_bits), "bitmaps")
    hashed = docs.withColumn("_norm", norm).withColumn("_slot", F.pmod(F.xxhash64("_norm"), F.lit(n_bits)))
    hashed = hashed.select(*columns, "_slot", F.sha2("_norm", 256).alias("_sha"))
    tested = _test_rows(hashed, bitmaps) if n_bits // 8 <= BROADCAST_BYTES else _test_stubs(hashed, bitmaps)
    alone = tested.filter("not _maybe").drop("_maybe")
    maybe = tested.filter("_maybe").drop("_maybe")
    groups = maybe.groupBy("_sha").agg(F.min(key).alias("_keep"), F.count("*").alias("_n"))
    # written first: its size is known then, so the join is a broadcast of few groups, or one whose large groups may be split
    return alone, maybe.join(materialize(groups, "repeated"), "_sha")


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for every row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised forms are.  Of equal texts the row with the
    smallest key stays; of rows that share that key too, exactly one does.  Null text is
    empty text.  A null key is larger than any other; where all keys of a text are null, one
    of the rows stays and keep_id is null.  Other columns do not matter; an empty table
    gives no rows.
    """
    alone, repeats = mark_repeats(docs, text, key, [key])
    # dealt anew by text and key, so that the join before need not keep a group together
    repeats = repeats.repartition("_sha", key)
    first = F.row_number().over(Window.partitionBy("_sha", key).orderBy(F.lit(1)))
    keeper = F.col(key).eqNullSafe(F.col("_keep"))
    both = alone.select(
        key, F.col(key).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("_sha").alias("text_sha256")
    ).unionByName(
        repeats.select(
            key, F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"), (keeper & (first == 1)).alias("kept"), F.col("_sha").alias("text_sha256")
        )
    )
    return both


def drop_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with their columns; only possible repeats shuffle."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select([F.col(f"`{c}`").alias(a) for c, a in names.items()])
    alone, repeats = mark_repeats(renamed, names[text], names[key], list(names.values()))
    first = F.row_number().over(Window.partitionBy("_sha").orderBy(F.lit(1)))
    # dealt anew once only the smallest keys are left, so that the join before need not keep a group together
    stays = repeats.filter(F.col(names[key]).eqNullSafe(F.col("_keep"))).repartition("_sha")
    stays = stays.withColumn("_r", first).filter("_r = 1")
    out = alone.select(*names.values()).unionByName(stays.select(*names.values()))
    return out.select([F.col(a).alias(c) for c, a in names.items()])
