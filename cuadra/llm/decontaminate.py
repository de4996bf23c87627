"""Benchmark decontamination by spaced-seed hashing.  DataFrame functions only.

A seed is a mask over consecutive words; words under its zeros are ignored, so a
substituted word there does not hide a hit.  MASKS leave no overlap out: within
any SPAN places, of which any two may differ, one mask fits whole somewhere.  Hashes of all test windows and
all training windows are joined; a hit puts a document and a test item on a
diagonal (document place less item place).  Around the hits the words of both
are compared along the diagonal: an overlap is a window of WINDOW words (or the
whole item, if shorter) of which LEAST_SHARE are equal.  An item of SHORTEST to
SPAN - 1 words must be there whole, word by word: its first words are its seed.

The test side joins as the planner's statistics say: they broadcast it only if
it is under the session's threshold.  Test windows are distinct before the join,
and the training side holds only an id, a place and a hash, so a passage that
many documents share adds rows in proportion to its occurrences.

Defined results: null and empty texts and items of fewer than SHORTEST words
hit nothing; words beyond a text's ends count as different; words are lower-cased runs of letters and digits; texts are
read whole; repeated documents are judged alike, a repeated id as one document;
repeated items are reported under the smallest item_id; a null id is in no
report and stays in ``clean``; an empty table gives no rows; other columns pass
through ``clean`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table

SPAN, WINDOW, LEAST_SHARE = 11, 13, 0.8
#: Words of the shortest item that is searched.
SHORTEST = 6
#: 1: the word counts; 0: it may differ.  Complete for two substitutions in SPAN
#: words, the most that LEAST_SHARE allows in SPAN to WINDOW.
MASKS = ("1111011", "110001111", "1101100011")
#: Masks of the SQL form: they miss some pairs of substitutions.
SQL_MASKS = ("11011011011", "10110110111", "11101101101")


def _words(text: str) -> Column:
    return F.expr(f"filter(split(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w <> '')")


def _seeds(rows: DataFrame, key: str, masks: tuple[str, ...]) -> DataFrame:
    """(key, at, seed) of every place of ``rows`` (key, words) and mask that fits there."""
    least = min(map(len, masks))
    hashed = rows.where(F.size("words") >= least).select(key, F.expr("transform(words, w -> xxhash64(w))").alias("h"))
    places = [[j for j, c in enumerate(m) if c == "1"] for m in masks]
    one = ", ".join(f"if(i + {m[-1]} < size(h), xxhash64({k}, {', '.join(f'h[i + {j}]' for j in m)}), null)" for k, m in enumerate(places))
    spread = hashed.select(key, F.posexplode(F.expr(f"transform(sequence(0, size(h) - {least}), i -> array({one}))")).alias("at", "seeds"))
    return spread.select(key, "at", F.explode("seeds").alias("seed")).where("seed is not null")


def overlaps(docs: DataFrame, tests: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item, start, n_words, n_equal): each document's verified overlap
    with each test item on each diagonal, at its best window; word places."""
    items = (tests.select(F.col(f"`{item}`").alias("item"), _words(f"`{item_text}`").alias("words"))
             .where("item is not null").groupBy("words").agg(F.min("item").alias("item")))
    items = staged(items, "items")
    own = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).where("id is not null")
    test_seeds = _seeds(items.where(F.size("words") >= SPAN), "item", MASKS)
    masks, short = MASKS, items.where(F.size("words").between(SHORTEST, SPAN - 1))
    if not short.isEmpty():  # the documents' seeds of the run are made only then
        masks = (*MASKS, "1" * SHORTEST)
        run = F.xxhash64(F.lit(len(MASKS)), *[F.xxhash64(F.col("words")[j]) for j in range(SHORTEST)])
        test_seeds = test_seeds.unionByName(short.select("item", F.lit(0).alias("at"), run.alias("seed")))
    test_seeds = test_seeds.distinct().select("item", F.col("at").alias("item_at"), "seed")
    hits = (_seeds(own.select("id", _words("text").alias("words")), "id", masks).join(test_seeds, "seed")
            .select("id", "item", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct())
    hits = staged(hits, "hits")
    read = own.join(hits.select("id").distinct(), "id", "left_semi").select("id", _words("text").alias("words"))
    pairs = hits.join(read, "id").join(items.withColumnRenamed("words", "theirs"), "item")
    # the item laid along the diagonal, then the best window of it
    equal = F.expr("transform(theirs, (w, j) -> if(coalesce(get(words, diagonal + j) = w, false), 1, 0))")
    size = F.least(F.lit(WINDOW), F.size("theirs"))
    laid = pairs.select("id", "item", "diagonal", equal.alias("equal"), size.alias("n_words"))
    best = laid.withColumn("best", F.expr(
        "array_max(transform(sequence(0, size(equal) - n_words), s -> named_struct('n', aggregate(slice(equal, s + 1, n_words), 0, (a, x) -> a + x), 's', -s)))"))
    least = F.when(F.col("n_words") < SPAN, F.col("n_words")).otherwise(F.ceil(F.col("n_words") * LEAST_SHARE))
    return (best.where(F.col("best.n") >= least)
            .select(F.col("id").alias(key), F.col("item").alias(item), (F.col("diagonal") - F.col("best.s")).cast("long").alias("start"),
                    F.col("n_words").cast("long").alias("n_words"), F.col("best.n").cast("long").alias("n_equal")).distinct())


def report(docs: DataFrame, tests: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_items, n_overlaps, items): one row for each contaminated document."""
    return overlaps(docs, tests, key, text).groupBy(key).agg(
        F.countDistinct("item_id").alias("n_items"), F.count("*").alias("n_overlaps"),
        F.array_join(F.array_sort(F.collect_set("item_id")).cast("array<string>"), ",").alias("items"))


def clean(docs: DataFrame, tests: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the contaminated documents."""
    found = staged(overlaps(docs, tests, key, text).select(F.col(key).alias("__bad")).distinct(), "bad")
    return docs.join(found, F.col(f"`{key}`") == F.col("__bad"), "left_anti")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def oracle() -> str:
    """The same rows in DuckDB.  Word windows are compared themselves, not their hashes."""
    masks = [[j for j, c in enumerate(m) if c == "1"] for m in SQL_MASKS]
    seeds = lambda t, k: " UNION ALL ".join(
        f"SELECT {k}, i AS at, {n} AS mask, " + " || ' ' || ".join(f"w[i + {j + 1}]" for j in m) + f" AS seed FROM (SELECT {k}, w, unnest(range(len(w) - {SPAN - 1})) AS i FROM {t} WHERE len(w) >= {SPAN})"
        for n, m in enumerate(masks))
    words = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    return f"""WITH d AS (SELECT doc_id, {words} AS w FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT min(item_id) AS item_id, w FROM (SELECT item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL) GROUP BY w),
hits AS (SELECT DISTINCT doc_id, item_id, x.at - y.at AS g FROM ({seeds('d', 'doc_id')}) x JOIN ({seeds('b', 'item_id')}) y ON x.mask = y.mask AND x.seed = y.seed),
laid AS (SELECT doc_id, item_id, g, least({WINDOW}, len(b.w)) AS n, list_transform(b.w, lambda v, j: CASE WHEN g + j >= 1 AND d.w[greatest(g + j, 1)] = v THEN 1 ELSE 0 END) AS e
  FROM hits JOIN d USING (doc_id) JOIN b USING (item_id)),
best AS (SELECT doc_id, item_id, g, n, list_max(list_transform(range(1, len(e) - n + 2), lambda s: list_sum(e[s:s + n - 1]))) AS m,
  list_transform(range(1, len(e) - n + 2), lambda s: list_sum(e[s:s + n - 1])) AS sums FROM laid),
o AS (SELECT DISTINCT doc_id, item_id, g + list_position(sums, m) - 1 AS start FROM best WHERE m >= ceil(n * {LEAST_SHARE}))
SELECT doc_id, count(DISTINCT item_id) AS n_items, count(*) AS n_overlaps, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS items FROM o GROUP BY doc_id"""
