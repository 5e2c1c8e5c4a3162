"""URL filter: a blocked Bloom filter lets possible hits through to an exact hash join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import materialize

#: Bits for each listed key, and the most 32-byte blocks of the filter (32 MB).  A fuller filter
#: lets more false hits through; the join removes them.
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 20
_WORDS = 8


def _place(key: str, blocks: int) -> tuple[int, list[int]]:
    """Block of a key, and the bit it sets in each of the block's eight 32-bit words."""
    h = xxhash.xxh3_128_intdigest(key.encode())
    return (h >> 64) % blocks, [(h >> (5 * k)) & 31 for k in range(_WORDS)]


def bloom_filter(keys: DataFrame, n_keys: int) -> np.ndarray:
    """uint32 array (blocks, 8) of the ``key`` column; built in Spark, at most 32 MB reach the driver."""
    blocks = min(MAX_BLOCKS, max(1, -(-n_keys * BITS_PER_KEY // 256)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key in b["key"]:
                block, bits = _place(key, blocks)
                rows += [(block, word, 1 << bit) for word, bit in enumerate(bits)]
            yield pd.DataFrame(rows, columns=["block", "word", "bits"])

    set_bits = keys.mapInPandas(run, "block long, word int, bits long").groupBy("block", "word").agg(F.bit_or("bits").alias("bits"))
    found = set_bits.toPandas()
    out = np.zeros((blocks, _WORDS), dtype=np.uint32)
    out[found["block"].to_numpy(int), found["word"].to_numpy(int)] = found["bits"].to_numpy(np.uint32)
    return out


def _maybe(key: str, table: np.ndarray) -> bool:
    block, bits = _place(key, len(table))
    words = table[block]
    return all(int(words[k]) >> b & 1 for k, b in enumerate(bits))


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an url; both empty where it is null or has no ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    after = F.when(F.instr(u, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule (null if none fits), verdict.

    ``rules`` has host, path and verdict.  A rule fits its host and all subdomains if the
    path starts with the rule's; the longest rule (host and path together) wins, of equally
    long ones the first by text.  Where none fits the verdict is ``default``.  Each url's keys
    are its host's suffixes with its path's prefixes, of the lengths that occur in the
    list; only urls with a key that the Bloom filter knows reach the join.  Null urls have an empty
    host and path.  Keys may be null or repeat.
    """
    listed = rules.filter("host is not null and path is not null").select(
        F.concat_ws("\n", "host", "path").alias("key"), F.concat("host", "path").alias("rule"), "verdict",
        F.size(F.split("host", "[.]")).alias("labels"), F.length("path").alias("chars"),
    ).dropDuplicates(["key"])
    n_keys = listed.count()
    filled = listed.sparkSession.sparkContext.broadcast(bloom_filter(listed.select("key"), n_keys))
    # At most as many shapes as labels times path lengths.
    shapes = [(r.labels, r.chars) for r in listed.select("labels", "chars").distinct().collect()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = filled.value
        for b in batches:
            hits = []
            for host, path in zip(b["host"], b["path"]):
                parts = host.split(".")
                keys = {".".join(parts[-n:]) + "\n" + path[:m] for n, m in shapes if n <= len(parts) and m <= len(path)}
                hits.append([k for k in keys if _maybe(k, table)])
            yield b.assign(hits=hits)

    host, path = host_and_path(url)
    kind = pages.schema[key].dataType.simpleString()
    given = pages.select(F.col(key).cast("string").alias("k"), host.alias("host"), path.alias("path"))
    tested = given.mapInPandas(run, "k string, host string, path string, hits array<string>")
    # written once: the urls without a hit pass by, only the others are joined and grouped
    tested = materialize(tested.withColumn("row", F.monotonically_increasing_id()), "urls")
    hit = tested.filter(F.size("hits") > 0).select("row", "k", "host", "path", F.explode("hits").alias("key"))
    joined = hit.join(listed.select("key", "rule", "verdict"), "key", "left")
    best = F.min(F.when(F.col("rule").isNotNull(), F.struct((-F.length("rule")).alias("n"), "rule", "verdict")))
    out = joined.groupBy("row", "k", "host", "path").agg(best.alias("best"))
    out = out.select("k", "host", "path", "best.rule", "best.verdict").unionByName(
        tested.filter(F.size("hits") == 0).select("k", "host", "path", *(F.lit(None).cast("string").alias(c) for c in ("rule", "verdict")))
    )
    return out.select(
        F.expr(f"cast(k as {kind})").alias(key), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
