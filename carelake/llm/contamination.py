"""Benchmark decontamination: a prefix-filtered join of item windows with the documents' shingles.

Every run of ten item words is a window, a set of word shingles with their places in it.  A document
that holds the window holds all of them, so one necessary shingle is enough to find it: the rarest one,
in an order by the number of times the shingles occur in all documents.  Its place in the
window and in the document fixes where the window would have to lie; windows that would begin before the
document or end after it are dropped, and the rest are compared word by word.

One pass reads the texts: their shingles meet the items' shingles (broadcast, in turns of a proven size)
and what matches is written with the words around it, a window's length to each side.  Counts, the
prefix join and the comparison work on that table; no text is shuffled.  All of it are
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import materialize, text_or_empty

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
#: Item shingles (8 bytes each) that one pass over the documents looks for.
TURN_SHINGLES = 2_000_000
#: Windows (about 0.2 KB each) up to which the prefix table is broadcast; Spark decides beyond it.
BROADCAST_WINDOWS = 200_000

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str = "text") -> Column:
    """Words of the text: runs of digits, letters and non-ASCII characters, A-Z in lower case; null has none."""
    t = text_or_empty(text)
    ascii_only = F.octet_length(t) == F.char_length(t)  # there lower() changes A-Z alone, and faster
    folded = F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))
    return F.filter(F.split(folded, _BREAK), lambda w: w != "")


def _shingles(column: str, width: int) -> str:
    """SQL of the hashes of all runs of ``width`` words.

    The words are bound to a lambda variable, so that they are made once even where Spark
    inlines their column.
    """
    parts = ", ".join(f"get(w, i + {k})" for k in range(width))
    runs = f"transform(sequence(0, size(w) - {width}), i -> xxhash64({parts}))"
    return f"transform(array({column}), w -> CASE WHEN size(w) >= {width} THEN {runs} ELSE CAST(array() AS array<bigint>) END)[0]"


def item_windows(items: DataFrame, window: int, item_key: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """(wid, words, len, k) of the distinct windows, k the words of their shingles; and (wid, item) of the items that hold them."""
    w = items.filter(F.col(item_key).isNotNull()).select(F.col(item_key).alias("item"), words(item_text).alias("w"))
    cut = F.expr(f"transform(sequence(0, greatest(size(w) - {window}, 0)), i -> slice(w, i + 1, {window}))")
    held = materialize(w.filter("size(w) > 0").select("item", F.explode(cut).alias("words")).distinct(), "item-windows")
    distinct = held.select("words").distinct().select(F.monotonically_increasing_id().alias("wid"), "words", F.size("words").alias("len"))
    distinct = materialize(distinct.withColumn("k", F.least("len", F.lit(SHINGLE_WORDS))), "windows")
    return distinct, materialize(held.join(distinct.select("wid", "words"), "words").select("wid", "item"), "holders")


def _matches(docs: DataFrame, tokens: DataFrame, widths: list[int], window: int, mark: bool) -> DataFrame:
    """(row, id, n_words, at, h, around): where a shingle of ``tokens`` (h) occurs, with the words about it.

    With ``mark`` every document has one more row, with a null ``at``.
    """
    arrays = ["array(-1L)"] if mark else []
    made = docs.select("row", "id", words("text").alias("w"))
    made = made.select("row", "id", "w", F.concat(*[F.expr(a) for a in arrays], *[F.expr(_shingles("w", k)) for k in widths]).alias("hs"))
    # outer: an inner one makes Spark filter on the size of the array, which computes it twice
    laid = made.select("row", "id", "w", F.size("w").alias("n_words"), F.posexplode_outer("hs").alias("pos", "h"))
    met = laid.join(F.broadcast(tokens), "h")
    at, before = F.lit(None).cast("int"), F.lit(len(arrays))
    for k in widths:  # the arrays lie one after another: the block a place falls into gives its word
        size = F.greatest(F.col("n_words") - (k - 1), F.lit(0))
        at = F.when((F.col("pos") >= before) & (F.col("pos") < before + size), F.col("pos") - before).otherwise(at)
        before = before + size
    first = F.greatest(F.col("at") - (window - 1), F.lit(0))
    met = met.withColumn("at", at).filter(F.col("at").isNotNull() | ((F.col("pos") == 0) & (F.col("h") == -1)) if mark else F.col("at").isNotNull())
    around = F.when(F.col("at").isNotNull(), F.slice("w", first + 1, F.col("at") - first + window))
    return met.select("row", "id", "n_words", "at", "h", around.alias("around"))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(row, key, n_words) of every row of ``docs``; (row, wid, start, stop) of the windows in it; (wid, item) of the windows' items.

    ``start`` and ``stop`` (exclusive) are word numbers from 0 of an occurrence of a window in the whole text.
    An item with fewer words than ``window`` is one window, one without words has none.  Rows of ``items`` with
    a null key take no part; rows that share a key are one item with the windows of all its texts.
    """
    windows, holders = item_windows(items, window, item_key, item_text)
    widths = sorted((r.k for r in windows.select("k").distinct().collect()), reverse=True)
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    per_k = [
        windows.filter(F.col("k") == k).select("wid", "words", "len", F.lit(k).alias("k"), F.posexplode(F.expr(_shingles("words", k))).alias("off", "h"))
        for k in widths
    ]
    kinds = "wid long, words array<string>, len int, k int, off int, h long"
    tokens = docs.sparkSession.createDataFrame([], kinds)
    for one in per_k:
        tokens = tokens.unionByName(one)
    tokens = materialize(tokens, "item-shingles")
    wanted = tokens.select("h").distinct()
    turns = max(1, -(-wanted.count() // TURN_SHINGLES))
    if turns > 1:  # row numbers must be the same in every turn
        given = materialize(given, "numbered")
    mark = docs.sparkSession.range(1).select(F.lit(-1).cast("long").alias("h"))
    found = None
    for turn in range(turns):
        own = wanted.filter(F.pmod(F.hash("h"), F.lit(turns)) == turn)
        one = _matches(given, own.union(mark).distinct() if turn == 0 else own, widths, window, mark=turn == 0)
        one = materialize(one, "shingle-matches")
        found = one if found is None else found.unionByName(one)
    documents = found.filter("at is null").select("row", F.col("id").alias(key), "n_words")
    placed = found.filter("at is not null")

    rarity = placed.groupBy("h").agg(F.count("*").alias("times"))
    rarest = F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "h", "off")).alias("best")
    prefix = tokens.join(rarity, "h", "left").groupBy("wid", "words", "len").agg(rarest)
    prefix = materialize(prefix.filter("best.times > 0").select("wid", "words", "len", "best.h", "best.off"), "prefixes")
    if prefix.count() <= BROADCAST_WINDOWS:
        prefix = F.broadcast(prefix)
    start = F.col("at") - F.col("off")
    inside = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
    first = F.greatest(F.col("at") - (window - 1), F.lit(0))
    equal = F.slice("around", F.when(start >= first, start - first).otherwise(0) + 1, F.col("len")) == F.col("words")
    hits = placed.join(prefix, "h").filter(inside & equal).select("row", "wid", start.alias("start"), (start + F.col("len")).alias("stop"))
    return documents, hits, holders


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row for every row of ``docs``: key, n_words, n_hit, items (those with a window in the text, as sorted strings), spans.

    ``spans`` are the hit parts of the text as (start, stop) word numbers, sorted and disjoint; ``n_hit`` is
    their words.  Null and empty texts have no words and no hits.  Rows that share a key, and rows with a null key,
    are documents of their own; see ``contamination`` for the items.  Without items nothing is hit; an empty
    table gives no rows.  Other columns do not matter.
    """
    documents, hits, holders = contamination(docs, items, window, key, text, item_key, item_text)
    # hits in order of their start: one that begins after all earlier ones have ended opens a span
    in_order = Window.partitionBy("row").orderBy("start", "stop")
    ended = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > ended, F.lit(True)).cast("int")
    numbered = hits.select("row", "start", "stop", opens.alias("opens")).withColumn("span", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    one = numbered.groupBy("row", "span").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    spans = one.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"), F.sum(F.col("stop") - F.col("start")).alias("n_hit"))
    named = hits.groupBy("row").agg(F.collect_set("wid").alias("wids")).select("row", F.explode("wids").alias("wid")).join(holders, "wid")
    named = named.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    found = spans.join(named, "row")
    empty = F.array().cast("array<string>")
    return documents.join(found, "row", "left").select(
        key, F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", empty).alias("items"), "spans"
    )
