"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations alone.

A window is ``width`` consecutive words of an item (all its words, if it has fewer). A
document contains a window only if it contains every word of it, so one word is a sufficient
prefix: the rarest by its count in the documents. Where that word stands in a document, the
window could only begin ``offset`` words earlier and must end inside the document (positional
and length bound); the words there are then compared with the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlode.llm.text import ALNUM_WORD, lower_ascii, words_of
from starlode.sources import materialize

WIDTH = 13
#: Prefix words are sent to all executors up to this many (a window of 13 words each, some 30 MB);
#: above, their join shuffles words and places. Results are the same.
BROADCAST_ROWS = 200_000


def _sized(small: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def item_windows(items: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """window (its words, joined by blanks), n, item_id: distinct."""
    words = F.col("words")
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0)))
    return (
        items.select(
            F.col(id_col).cast("string").alias("item_id"),
            words_of(lower_ascii(F.col(text_col)), ALNUM_WORD).alias("words"),
        )
        .where(F.size(words) > 0)
        .select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice(words, F.col("start") + 1, width).alias("parts"))
        .select(F.array_join("parts", " ").alias("window"), F.size("parts").alias("n"), "item_id")
        .distinct()
    )


def _word_stream(docs: DataFrame) -> DataFrame:
    """doc_id, digest, words, pos, word: every word, then an empty one that ends the document."""
    # no array is empty; the outer form spares Spark a filter that cuts every text once more
    each = F.posexplode_outer(F.col("words")).alias("pos", "raw")
    return docs.select("doc_id", "digest", "words", each).withColumn("word", lower_ascii(F.col("raw")))


def _occurs(words: Column, start: Column, n: Column, window: Column) -> Column:
    """Whether the words from ``start`` on are those of the window."""
    return lower_ascii(F.array_join(F.slice(words, start + 1, n), " ")) == window


_HIT = ("doc_id", "digest", "start", "n", "window")


def _hits_in_place(worded: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Occurrences of windows, and the end mark of every document (n = 0), where prefixes are
    few enough to be sent to all executors: a candidate is verified where its document is read."""
    start, is_end = F.col("pos") - F.col("offset"), F.col("n") == 0
    occurs = F.when(start >= 0, _occurs(F.col("words"), start, F.col("n"), F.col("window")))
    return (
        _word_stream(worded)
        .join(F.broadcast(prefixes), F.col("word") == F.col("known"))
        .where(is_end | ((start >= 0) & (start + F.col("n") <= F.size("words") - 1)))
        .where(is_end | occurs)
        .select("doc_id", "digest", start.alias("start"), "n", "window")
    )


def _hits_by_join(worded: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The same for prefixes of any number: words and places are shuffled, not texts, and the
    candidates found go back to the documents they are in."""
    length = (F.size("words") - 1).alias("length")
    stream = _word_stream(worded).select("doc_id", "digest", length, "pos", "word")
    start = F.col("pos") - F.col("offset")
    found = (
        stream.join(prefixes.where("n > 0"), F.col("word") == F.col("known"))
        .where((start >= 0) & (start + F.col("n") <= F.col("length")))
        .groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
        .agg(F.collect_set(F.struct(start.alias("start"), "n", "window")).alias("candidates"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    verified = F.filter("candidates", lambda c: _occurs(F.col("words"), c["start"], c["n"], c["window"]))
    hits = worded.join(found, same).select("doc_id", "digest", F.explode(verified).alias("hit"))
    ends = worded.select("doc_id", "digest", length.alias("start"), F.lit(0).alias("n"), F.lit("").alias("window"))
    return hits.select("doc_id", "digest", "hit.*").unionByName(ends).select(*_HIT)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_ids, digest: one row per distinct id and text.

    ``item_ids`` is sorted as strings. Null and empty texts have no words and no hits; items
    without words have no windows, and a null item id counts as no item. Rows that repeat id
    and text give one row, rows with one id and several texts one row each, told apart by
    ``digest`` (the hash of the text). Null ids are kept. Very long texts are compared whole; an
    empty table of documents gives no rows, one of items no hits. Other columns are not read.
    """
    spark = docs.sparkSession
    windows = materialize(item_windows(items, width, item_id_col, item_text_col), "windows")
    text = F.coalesce(F.col(text_col), F.lit(""))
    worded = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("digest"),
        F.concat(words_of(text, ALNUM_WORD), F.array(F.lit(""))).alias("words"),
    )
    vocabulary = windows.select(F.explode(F.split("window", " ")).alias("word")).distinct()
    vocabulary = materialize(vocabulary.withColumnRenamed("word", "known"), "vocabulary")
    seen = (
        _word_stream(worded)
        .select("word")
        .join(_sized(vocabulary, vocabulary.count()), F.col("word") == F.col("known"))
        .groupBy("known")
        .agg(F.count("*").alias("seen"))
    )
    rarity = materialize(seen, "rarity")
    # a window with a word that no document has cannot occur
    in_order = Window.partitionBy("window").orderBy("seen", "known", "offset")
    prefixes = (
        windows.select("window", "n")
        .distinct()
        .select("window", "n", F.posexplode(F.split("window", " ")).alias("offset", "part"))
        .join(rarity, F.col("part") == F.col("known"))
        .withColumn("place", F.row_number().over(in_order))
        .withColumn("found", F.count("*").over(Window.partitionBy("window")))
        .where((F.col("place") == 1) & (F.col("found") == F.col("n")))
        .select("known", "offset", "n", "window")
    )
    end_mark = spark.range(1).select(
        F.lit("").alias("known"), F.lit(0).alias("offset"), F.lit(0).alias("n"), F.lit("").alias("window")
    )
    prefixes = materialize(prefixes.unionByName(end_mark), "prefixes")
    few = prefixes.count() <= BROADCAST_ROWS
    hits = (_hits_in_place if few else _hits_by_join)(worded, prefixes)
    is_end = F.col("n") == 0
    spans = hits.groupBy("doc_id", "digest").agg(
        F.max(F.when(is_end, F.col("start"))).cast("long").alias("n_words"),
        F.sort_array(F.collect_set(F.when(~is_end, F.struct("start", "n")))).alias("spans"),
        F.collect_set(F.when(~is_end, F.col("window"))).alias("found"),
    )
    spans = materialize(spans, "hits")
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("till"), F.lit(0).cast("long").alias("total")),
        lambda a, s: F.struct(
            F.greatest(a["till"], s["start"] + s["n"]).alias("till"),
            (a["total"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(a["till"], s["start"])))
            .cast("long")
            .alias("total"),
        ),
        lambda a: a["total"],
    )
    named = (
        spans.select("doc_id", "digest", F.explode("found").alias("_window"))
        .join(windows.where(F.col("item_id").isNotNull()), F.col("_window") == F.col("window"))
        .groupBy("doc_id", "digest")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
        .withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    )
    return spans.join(
        named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left"
    ).select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        "digest",
    )


def is_contaminated() -> Column:
    """At least one word in twenty is part of an item's window."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def without_contaminated(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, repeated rows included.

    Null and empty texts are clean; rows with null ids are judged by their text like others.
    """
    bad = contamination(docs, items, width, id_col, text_col).where(is_contaminated())
    bad = bad.select(F.col("doc_id").alias("_bad_id"), F.col("digest").alias("_bad_digest"))
    same = F.col(id_col).eqNullSafe(F.col("_bad_id")) & (
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_bad_digest")
    )
    return docs.join(bad, same, "left_anti")
