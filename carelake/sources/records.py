"""CSV records that may run over several lines, read in parallel, with their rejects.

A line break inside quotes belongs to the field, so a file cannot be cut at any line break.  Here the
files are read as lines, in splits.  For each line two things are known by itself: whether a quoted
field is open after it when it begins outside of quotes, and when it begins inside.  These are
maps of {outside, inside} to itself; chained over the lines of a split, and over the splits of a file,
they say where every line begins.  Lines that are whole records pass on; the others are put together by
the first line of their record.  No file is read by one task.

What is chained are pieces of at most 2^PIECE_BITS lines of a split, and the shuffles have a partition for
every PART_BYTES of the files: what a task sorts or holds does not grow with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from carelake.session import scratch_path

#: Extra columns of ``read_records``: file, raw text of the record, and why it is rejected (null: it is not).
FILE, RAW, REASON = "_file", "_raw", "_reason"
#: A record of more lines than this has an opening quote by mistake: its lines are rejected one by one.
MAX_RECORD_LINES = 10_000
#: Lines of a piece (as a power of two), and bytes of the files for each partition of a shuffle of lines.
PIECE_BITS, PART_BYTES = 15, 32 << 20
NEVER_CLOSED = "quoted field is never closed"


def _open_after(line: str, escape: str) -> tuple[Column, Column]:
    """Whether a quoted field is open after the line, if it begins outside and if it begins inside of quotes."""
    if escape == '"':
        content = r'[^"]*+(?:""[^"]*+)*+'
    else:
        e = "\\\\" if escape == "\\" else escape
        content = rf'[^"{e}]*+(?:{e}["{e}]?+[^"{e}]*+)*+'
    closed = rf'(?:(?:"{content}"[^,]*+|(?!")[^,]*+),)*+'
    outside = rf'\A{closed}"{content}\z'
    inside = rf'\A{content}(?:"[^,]*+,{closed}"{content})?\z'
    return F.col(line).rlike(outside), F.col(line).rlike(inside)


def _lines(spark: SparkSession, path: str, escape: str) -> DataFrame:
    """``no`` numbers the lines of a split as they come; ``block`` is the split's place in the file and a piece of it."""
    open0, open1 = _open_after("value", escape)
    numbered = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("no"), "value", open0.alias("open0"), open1.alias("open1"),
    )
    block = F.struct("start", F.shiftright("no", PIECE_BITS).alias("piece"))
    return numbered.select("file", block.alias("block"), "no", "value", "open0", "open1")


def shuffle_parts(spark: SparkSession, path: str) -> int:
    """Partitions for shuffles of the lines under ``path``: in proportion to the bytes of its files."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def line_facts(spark: SparkSession, path: str, escape: str = "\\") -> tuple[bool, bool]:
    """Whether any record may run over lines, and whether any file is read in more than one split."""
    found = _lines(spark, path, escape).agg(F.bool_or("open0"), F.max("block.start") > 0).first()
    return bool(found[0]), bool(found[1])


def _with_state(df: DataFrame, open0: str, open1: str, window, out: dict[str, Column]) -> DataFrame:
    """``df`` plus whether each row of the window begins inside of quotes, for each named state of the first row.

    A row whose two ends are the same fixes the state; since the last such row only swaps change it.
    """
    until, before = (window.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    swap = F.when(F.col(open0) & ~F.col(open1), 1).otherwise(0)
    df = df.withColumn("_swaps", F.sum(swap).over(until))
    fixes = F.when(F.col(open0) == F.col(open1), F.struct(F.col(open0).alias("state"), F.col("_swaps").alias("swaps")))
    df = df.withColumn("_fixed", F.last(fixes, ignorenulls=True).over(before))
    odd = (F.col("_swaps") - swap - F.coalesce("_fixed.swaps", F.lit(0))) % 2 == 1
    return df.withColumns({name: F.coalesce("_fixed.state", first) != odd for name, first in out.items()}).drop("_swaps", "_fixed")


def records(spark: SparkSession, path: str, escape: str = "\\") -> DataFrame:
    """(file, header, raw, reason): one row for every record; ``header`` marks the first of each file.

    Line breaks inside quotes stay as they are; a carriage return at the end of a record does not.  Blank records are left out.
    The lines of a record that is never closed, or is longer than MAX_RECORD_LINES, come one by one with a reason.
    """
    in_block = Window.partitionBy("file", "block").orderBy("no")
    n = shuffle_parts(spark, path)
    lines = _with_state(_lines(spark, path, escape).repartition(n, "file", "block"), "open0", "open1", in_block, {"in0": F.lit(False), "in1": F.lit(True)})
    where = scratch_path(spark, "csv-lines")
    lines.write.parquet(where)  # numbered once: what follows reads the same numbers
    lines = spark.read.schema(lines.schema).parquet(where)

    def end(state: str) -> Column:
        return F.max_by(F.when(F.col(state), F.col("open1")).otherwise(F.col("open0")), "no")

    blocks = lines.groupBy("file", "block").agg(
        end("in0").alias("open0"), end("in1").alias("open1"), F.min("no").alias("first_no"),
        F.max(F.when(~F.col("in0"), F.col("no"))).alias("start0"), F.max(F.when(~F.col("in1"), F.col("no"))).alias("start1"),
    )
    in_file = Window.partitionBy("file").orderBy("block")
    blocks = _with_state(blocks, "open0", "open1", in_file, {"inside": F.lit(False)})
    start = F.when(F.col("inside"), F.col("start1")).otherwise(F.col("start0"))
    last = F.when(start.isNotNull(), F.struct(F.col("block").alias("block"), start.alias("no")))
    blocks = blocks.withColumn("_last", last).withColumn("carried", F.last("_last", ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1)))
    is_first = F.row_number().over(in_file) == 1
    blocks = blocks.select("file", "block", "inside", "carried", F.when(is_first, F.col("first_no")).alias("header_no"))

    joined = lines.join(blocks, ["file", "block"])
    inside = F.when(F.col("inside"), F.col("in1")).otherwise(F.col("in0"))
    after = F.when(inside, F.col("open1")).otherwise(F.col("open0"))
    header = F.coalesce(F.col("no") == F.col("header_no"), F.lit(False))
    state = joined.select("file", "block", "no", "value", "carried", inside.alias("continues"), after.alias("goes_on"), header.alias("header"))

    whole = state.filter("NOT continues AND NOT goes_on").select("file", "header", F.col("value").alias("raw"), F.lit(None).cast("string").alias("reason"))
    parts = state.filter("continues OR goes_on").repartition(n, "file", "block")
    own = F.last(F.when(~F.col("continues"), F.struct("block", "no")), ignorenulls=True).over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("record", F.coalesce(own, "carried")).repartition(n, "file", "record")
    place = F.struct("block", "no")
    facts = parts.groupBy("file", "record").agg(F.count(F.lit(1)).alias("n"), F.max_by("goes_on", place).alias("never"))
    parts = parts.join(facts.withColumn("bad", F.col("never") | (F.col("n") > MAX_RECORD_LINES)).select("file", "record", "bad"), ["file", "record"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "no", "value"))), lambda x: x["value"]), "\n")
    put_together = parts.filter("NOT bad").groupBy("file", "record").agg(F.max("header").alias("header"), text.alias("raw"))
    put_together = put_together.select("file", "header", "raw", F.lit(None).cast("string").alias("reason"))
    loose = parts.filter("bad").select("file", "header", F.col("value").alias("raw"), F.lit(NEVER_CLOSED).alias("reason"))
    out = whole.unionByName(put_together).unionByName(loose)
    return out.withColumn("raw", F.regexp_replace("raw", r"\r\z", "")).filter(F.trim("raw") != "")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _reason(schema: StructType, raw: str, escape: str) -> Column:
    """Why a record that Spark's parser calls corrupt, or that lacks a declared key, is rejected; null otherwise."""
    texts = F.from_csv(F.col(raw), _ddl(StructType([StructField(f.name, StringType()) for f in schema.fields])), {"escape": escape})
    bad = [F.when(texts[f.name].isNotNull() & F.col(f.name).isNull(), F.lit(f"{f.name}: bad value")) for f in schema.fields]
    missing = [F.when(F.col(f.name).isNull(), F.lit(f"{f.name}: missing")) for f in schema.fields if not f.nullable]
    why = F.concat_ws("; ", *bad)
    corrupt = F.when(F.col("_corrupt").isNotNull(), F.when(why != "", why).otherwise("wrong number of fields"))
    return F.coalesce(corrupt, F.when(F.concat_ws("", *missing) != "", F.concat_ws("; ", *missing)))


def read_records(spark: SparkSession, path: str, schema: StructType, escape: str = "\\") -> DataFrame:
    """Every record of the headered CSV files under ``path``: the declared columns, file, raw text and reason.

    Records may run over lines.  Rejected ones (bad values, a wrong number of fields, a missing non-null
    column, a quote that is never closed) keep what could be read of them.  A header other than the
    declared names fails the read.
    """
    found = records(spark, path, escape)
    names = ",".join(f.name for f in schema.fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "escape": escape}
    corrupt = StructType([*schema.fields, StructField("_corrupt", StringType())])
    header = F.regexp_replace(F.col("raw"), '["﻿]', "")
    checked = F.when(F.col("header") & (header != names), F.raise_error(F.concat(F.lit("header differs from the declared columns: "), "raw")).cast("boolean"))
    rows = found.withColumn("_ok", F.coalesce(checked, F.lit(True))).filter("_ok AND NOT header")
    parsed = rows.withColumn("_row", F.from_csv("raw", _ddl(corrupt), options)).select("_row.*", F.col("file").alias(FILE), F.col("raw").alias(RAW), F.col("reason").alias("_closed"))
    why = F.coalesce("_closed", _reason(schema, RAW, escape))
    return parsed.withColumn(REASON, why).select([f.name for f in schema.fields] + [FILE, RAW, REASON])
