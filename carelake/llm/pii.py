"""Personal data: fixed patterns, and bootstrapped contextual extraction on top.

The matches of the fixed patterns are seeds.  The two words before the word in which a seed
starts are a lexical pattern; words with a digit or inner marks that no seed covers, and short
runs of words of digits, are instances of the pattern they follow.  Patterns and instances
form a graph over the whole corpus: a pattern's confidence for a kind is the mean score of its
distinct instances, an instance's score comes from the trusted patterns it follows, but for
the one that is judged.  In each round the accepted instances are seeds for further patterns.
Trusted patterns give their kind to what follows them, and accepted instances
are marked wherever they occur.

Everything runs in Spark's own expressions.  Places come from ``split`` and
``regexp_extract_all`` by the same expression: gaps and matches alternate, so running sums of
their lengths are the starts in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import materialize, text_or_empty

KINDS = ["email", "ip", "card", "phone"]
#: The contract's expressions.  Possessive quantifiers and the look-behinds keep the time
#: linear and leave the leftmost matches as they are: a run of a class matches from its start or not at all.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A word with a digit, an at sign or marks between letters; every seed starts in such a word.
_INNER = r"[0-9@]|[\p{L}\p{N}][^\x20\x09-\x0D\p{L}\p{N}]++[\p{L}\p{N}]"
TOKEN = rf"(?<![^\x20\x09-\x0D])(?=[^\x20\x09-\x0D]*(?:{_INNER}))[^\x20\x09-\x0D]++"
#: What a text must have for a pattern to be tried at all.
_NEEDS = {"email": "instr(t, '@') > 0", "ip": r"t rlike '[0-9][.][0-9]'", "card": r"t rlike '[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]'", "phone": "instr(t, '+') > 0", "token": f"t rlike r'{_INNER}'"}

#: A pattern counts from so many distinct seeds and such a mean score of its instances.
MIN_SEEDS = 3
MIN_CONFIDENCE = 0.8
#: An instance with such a score is a seed of the next round and is marked wherever it occurs, if it has
#: so many letters and digits: a shorter one is no identifier outside its pattern.
MIN_SCORE = 0.8
MIN_IDENTIFIER = 5
#: The score of an instance that is no seed stays below 1 by this much, so that a pattern has confidence 1
#: only where all its instances are seeds, and no score falls from one round to the next.
DOUBT = 1e-9
#: Row numbers up to this many (8 bytes each) may be broadcast.
BROADCAST_ROWS = 2_000_000


def _luhn(digits: Column) -> Column:
    def weigh(c, i):
        d = F.coalesce(c.cast("int"), F.lit(0))
        return F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    parts = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    octet = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", match.rlike(rf"^{octet}(?:\.{octet}){{3}}$"))
        .when(kind == "card", n.between(16, 19) & F.when(n.between(16, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(8, 15))
        .otherwise(True)
    )


def _matches(kind: str, pattern: str) -> Column:
    """Array of (kind, i, gap, m, tail): gap is the number of code points since the last match,
    tail (of tokens) the last two words among them."""
    gaps, found = F.split(F.col("t"), pattern, -1), F.regexp_extract_all(F.col("t"), F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("m"))

    def entry(x, i):
        words = F.trim(F.regexp_replace(x["gap"], r"[\x20\x09-\x0D]+", " "))
        tail = F.substring_index(words, " ", -2) if kind == "token" else F.lit("")
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), x["m"].alias("m"), tail.alias("tail"))

    none = F.array().cast("array<struct<kind:string,i:int,gap:int,m:string,tail:string>>")
    return F.when(F.expr(_NEEDS[kind]), F.transform(pairs, entry)).otherwise(none)


def find_matches(docs: DataFrame, key: str, text: str, row: Column) -> DataFrame:
    """One row per row of ``docs``: row (a number), key, hits (matches of all kinds and tokens); written once."""
    given = docs.select(row.alias("row"), F.col(key).alias("key"), text_or_empty(text).alias("t"))
    hits = F.concat(*[_matches(k, PATTERNS[k]) for k in KINDS], _matches("token", TOKEN))
    return materialize(given.select("row", "key", hits.alias("hits")), "pii-matches")


def _placed(matches: DataFrame) -> DataFrame:
    """(row, kind, start, stop, m, before, i, next_to) of the valid matches and tokens.

    before (of tokens) are the two words in front, which may be tokens themselves; next_to tells
    whether only white space parts a token from the one before.
    """
    hits = matches.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    order = Window.partitionBy("row", "kind").orderBy("i")
    stop = F.sum((F.col("gap") + F.length("m")).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    filled = lambda c: F.nullif(c, F.lit(""))
    words = F.concat_ws(" ", F.lag("m", 2).over(order), filled(F.lag("tail").over(order)), F.lag("m").over(order), filled(F.col("tail")))
    before = F.when(F.col("kind") == "token", F.lower(F.substring_index(words, " ", -2))).otherwise("")
    placed = hits.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("m")).withColumn("before", before)
    placed = placed.withColumn("next_to", (F.col("tail") == "") & (F.col("i") > 0))
    return placed.filter(_valid(F.col("kind"), F.col("m"))).select("row", "kind", "start", "stop", "m", "before", "i", "next_to")


def _instances(free: DataFrame) -> DataFrame:
    """(row, start, stop, m, before) of tokens outside the seeds, without the marks round them; a run
    of words of digits, however long, is one."""
    digits = F.col("m").rlike(r"^[^\p{L}]*[0-9][^\p{L}]*$")
    along = Window.partitionBy("row").orderBy("i")
    follows = F.col("next_to") & digits & F.lag(digits).over(along) & (F.lag("i").over(along) == F.col("i") - 1)
    runs = free.withColumn("new", F.when(follows, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    whole = F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("start", "m"))), lambda x: x["m"]))
    made = runs.groupBy("row", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min_by("before", "start").alias("before"), whole.alias("m")
    )
    marks = r"^[^\p{L}\p{N}+]+"
    trimmed = F.regexp_extract("m", r"^(.*[\p{L}\p{N}])", 1)
    made = made.withColumn("stop", F.col("stop") - F.length("m") + F.length(trimmed)).withColumn("m", trimmed)
    made = made.withColumn("start", F.col("start") + F.length("m") - F.length(F.regexp_replace("m", marks, "")))
    return made.withColumn("m", F.regexp_replace("m", marks, "")).filter("m <> ''").select("row", "start", "stop", "m", "before")


def score_patterns(seeds: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(before, kind) of the patterns that are trusted and (m, kind) of the instances that are accepted,
    from the pattern-instance graph of the corpus.

    Scores and confidences only grow from round to round: an instance that is accepted stays so.  The rounds
    end when one accepts no instance and trusts no pattern that the round before had not.
    """
    has_words = "before <> ''"
    known = materialize(seeds.select("m", "kind").distinct(), "pii-seeds")
    edges = seeds.filter(has_words).select("before", "m").union(tokens.filter(has_words).select("before", "m")).distinct()
    edges = materialize(edges, "pii-edges")
    sizes = edges.groupBy("before").agg(F.count("*").alias("n"))
    # (m, kind, doubt): the product of 1 - confidence over the trusted patterns, as a logarithm
    heard = known.select("m", "kind").limit(0).withColumn("doubt", F.lit(0.0))
    trusted = known.select(F.col("m").alias("before"), "kind").limit(0).withColumn("confidence", F.lit(0.0))
    n_accepted, n_trusted = 0, 0
    while True:
        fixed = known.withColumn("fixed", F.lit(True)).withColumn("doubt", F.lit(0.0))
        scored = heard.join(known, ["m", "kind"], "left_anti").withColumn("fixed", F.lit(False)).select("m", "kind", "fixed", "doubt")
        # the pattern that is judged does not speak for its own instances
        own = F.coalesce(F.log1p(-F.col("confidence")), F.lit(0.0))
        heard_without = edges.join(fixed.unionByName(scored), "m").join(trusted, ["before", "kind"], "left")
        score = F.greatest(F.lit(0.0), F.least(F.round(1 - F.exp(F.col("doubt") - own), 9), F.lit(1 - DOUBT)))
        judged = heard_without.withColumn("score", F.when(F.col("fixed"), 1.0).otherwise(score))
        counts_as_seed = F.col("fixed") | ((F.col("score") >= MIN_SCORE) & _identifies("m"))
        sums = judged.groupBy("before", "kind").agg(F.sum("score").alias("sum"), F.count_if(counts_as_seed).alias("seeds"))
        sums = sums.filter(F.col("seeds") >= MIN_SEEDS).join(sizes, "before").withColumn("confidence", F.col("sum") / F.col("n"))
        trusted = sums.filter(F.col("confidence") >= MIN_CONFIDENCE).select("before", "kind", "confidence")
        trusted = materialize(trusted, "pii-trusted")
        # confidence 1 means that all instances are seeds
        doubts = edges.join(trusted.filter("confidence < 1"), "before").groupBy("m", "kind").agg(F.sum(F.log1p(-F.col("confidence"))).alias("doubt"))
        heard = materialize(doubts, "pii-heard")
        accepted = heard.filter((1 - F.exp("doubt") >= MIN_SCORE - 1e-9) & _identifies("m")).join(known, ["m", "kind"], "left_anti")
        before, now = (n_accepted, n_trusted), (accepted.count(), trusted.count())
        if now[0] <= before[0] and now[1] <= before[1]:
            break
        n_accepted, n_trusted = now
    best = Window.partitionBy("before").orderBy(F.desc("confidence"), "kind")
    patterns = trusted.withColumn("r", F.row_number().over(best)).filter("r = 1").select("before", "kind")
    best = Window.partitionBy("m").orderBy("doubt", "kind")
    return patterns, accepted.withColumn("r", F.row_number().over(best)).filter("r = 1").select("m", "kind")


def _identifies(m: str) -> Column:
    return F.length(F.regexp_replace(m, r"[^\p{L}\p{N}]", "")) >= MIN_IDENTIFIER


def find_personal_data(
    docs: DataFrame, key: str = "doc_id", text: str = "text", row: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): documents has row and key of every row; spans (row, kind, start, stop, base).

    start and stop count code points, stop is exclusive; base tells the fixed patterns' spans
    from those that context found.  Null text is empty.  Keys may be null or repeat: rows are
    told apart by ``row``, a number that this function gives them where it is not given.
    """
    matches = find_matches(docs, key, text, F.monotonically_increasing_id() if row is None else row)
    placed = materialize(_placed(matches), "pii-spans")
    base = placed.filter("kind <> 'token'")
    in_text = Window.partitionBy("row")
    before = in_text.orderBy("start", F.expr("kind = 'token'")).rowsBetween(Window.unboundedPreceding, 0)
    # from the text's end: a frame that reaches forward would be summed anew for every row
    after = in_text.orderBy(F.desc("start"), F.expr("kind = 'token'")).rowsBetween(Window.unboundedPreceding, 0)
    of_base = lambda c: F.when(F.col("kind") != "token", F.col(c))
    marked = placed.withColumn("covered", F.max(of_base("stop")).over(before)).withColumn("next", F.min(of_base("start")).over(after))
    free = marked.filter("kind = 'token' and coalesce(covered, 0) <= start and (next is null or next >= stop)")
    free = materialize(_instances(free.select("row", "i", "next_to", "start", "stop", "m", "before")), "pii-instances")
    # a seed has the words before the token in which it starts
    till = in_text.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    token = F.max(F.when(F.col("kind") == "token", F.struct("start", "before"))).over(till)
    seeds = placed.withColumn("before", token["before"]).filter("kind <> 'token'")
    patterns, accepted = score_patterns(seeds.select("before", "m", "kind"), free.select("before", "m"))
    found = free.join(patterns, "before", "left").join(accepted.withColumnRenamed("kind", "known_as"), "m", "left")
    found = found.withColumn("kind", F.coalesce("kind", "known_as")).filter("kind is not null")
    found = found.select("row", "kind", "start", "stop", F.lit(False).alias("base"))
    spans = base.select("row", "kind", "start", "stop", F.lit(True).alias("base")).unionByName(found)
    return matches.select("row", "key"), materialize(spans, "pii-found")


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_email, n_ip, n_card, n_phone and base_sha256 of the fixed
    patterns' spans, spans (all of them as kind:start:stop, by kind and start, comma-joined).

    Null text is empty.  Rows whose keys are null or repeat are rows of their own; an empty table
    gives no rows; other columns do not matter.
    """
    rows, spans = find_personal_data(docs, key, text)
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    spans = spans.withColumn("e", F.struct(order.alias("o"), "start", F.concat_ws(":", "kind", "start", "stop").alias("s")))
    by_row = spans.groupBy("row").agg(
        *[F.sum((F.col("base") & (F.col("kind") == k)).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.sort_array(F.collect_list(F.when(F.col("base"), F.col("e")))).alias("b"),
        F.sort_array(F.collect_list("e")).alias("a"),
    )
    joined = lambda c: F.concat_ws(",", F.coalesce(F.col(f"{c}.s"), F.array().cast("array<string>")))
    return rows.join(by_row, "row", "left").select(
        F.col("key").alias(key), *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined("b"), 256).alias("base_sha256"), joined("a").alias("spans"),
    )


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by [EMAIL], [IP], [CARD] or [PHONE].

    Overlapping spans become one, named after the first.  Rows without a span pass
    through unchanged (null text stays null); only those with one are joined to their spans.
    """
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select([F.col(f"`{c}`").alias(a) for c, a in names.items()])
    t = names[text]
    stored = materialize(renamed.withColumn("_row", F.monotonically_increasing_id()), "pii-docs")
    _, spans = find_personal_data(stored, "_row", t, F.col("_row"))
    along = Window.partitionBy("row").orderBy("start", "stop")
    reach = F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("new", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int"))
    islands = islands.withColumn("island", F.sum("new").over(along)).groupBy("row", "island").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min_by("kind", F.struct("start", "stop")).alias("kind")
    )
    cuts = islands.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "kind"))).alias("_cuts"))
    cuts = materialize(cuts.withColumnRenamed("row", "_row"), "pii-cuts")
    ids = cuts.select("_row")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    segment = lambda x, i: F.concat(
        F.substring(F.col(t), F.when(i > 0, F.element_at("_cuts", i)["stop"]).otherwise(0).cast("int") + 1,
                    (x["start"] - F.when(i > 0, F.element_at("_cuts", i)["stop"]).otherwise(0)).cast("int")),
        F.lit("["), F.upper(x["kind"]), F.lit("]"),
    )
    rest = F.substring(F.col(t), F.element_at("_cuts", -1)["stop"].cast("int") + 1, F.length(F.col(t)))
    hit = stored.join(ids, "_row", "left_semi").join(cuts, "_row")
    hit = hit.withColumn(t, F.concat(F.array_join(F.transform("_cuts", segment), ""), rest))
    both = hit.select(*names.values()).unionByName(stored.join(ids, "_row", "left_anti").select(*names.values()))
    return both.select([F.col(a).alias(c) for c, a in names.items()])
