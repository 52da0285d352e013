"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window is ten consecutive words of an item, or all words of a shorter one. Its shingles are its runs of four words
(fewer in shorter windows). A document contains a window exactly when it has all the window's shingles in a row, so one
necessary prefix token is enough to find it: the window's rarest shingle, by number of occurrences in the documents.
One pass over the documents keeps the places of the shingles that the benchmark has, compared word by word; rarity,
candidates, bounds and the check of the whole window then work on those narrow rows. A candidate must have room in its
document: the document is as long as the window, and neither end of the window lies outside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.frames import stored

WINDOW = 10
SHINGLE = 4
# What is lower-cased, and what a word is: digits, letters and all beyond ASCII. (A class that lists what
# it holds runs several times faster than one that lists what it lacks.)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]++"
#: Tables of the benchmark's shingles up to this many rows (about 100 MB) are broadcast; larger ones are shuffled.
BROADCAST_SHINGLES = 1_000_000
#: The same for narrow tables of numbers.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _gram(at: Column, size: int) -> Column:
    return F.concat_ws(" ", *(F.get("words", at + k) for k in range(size)))


def _windows(items: DataFrame, item: str, text: str) -> DataFrame:
    """``(window, item, length)``: every distinct window as one text, with each item that has it."""
    split = items.select(F.col(item).alias("item"), words(F.col(text)).alias("words")).where(F.size("words") > 0)
    sized = split.withColumn("length", F.least(F.size("words"), F.lit(WINDOW)))
    starts = sized.select("item", "words", "length", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("start"))
    return starts.select(F.array_join(F.slice("words", F.col("start"), F.col("length")), " ").alias("window"), "item", "length").distinct()


def _shingles(windows: DataFrame) -> DataFrame:
    """``(window_id, k, n_shingles, length, size, gram)``: the shingles of each window, in order."""
    one = windows.select("window", "length").distinct().withColumn("window_id", F.sha2("window", 256)).withColumn("words", F.split("window", " "))
    sized = one.withColumn("size", F.least("length", F.lit(SHINGLE))).withColumn("n_shingles", F.col("length") - F.col("size") + 1)
    at = sized.select("window_id", "length", "size", "n_shingles", "words", F.explode(F.sequence(F.lit(0), F.col("n_shingles") - 1)).alias("k"))
    return at.select("window_id", "k", "n_shingles", "length", "size", F.array_join(F.slice("words", F.col("k") + 1, F.col("size")), " ").alias("gram"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a written table, marked for broadcast if its number of rows is within the bound."""
    return F.broadcast(df) if df.count() <= rows else df


def occurrences(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(id, mark, start, length, window_id)``: every place where a window lies in a document.

    ``mark`` is a hash of the text, so that rows of one id with different texts stay apart.
    """
    shingles = stored(_shingles(_windows(items, item, item_text)), "shingles")
    vocabulary = stored(shingles.select("gram", "size").distinct().withColumn("gram_id", F.xxhash64("gram", "size")), "vocabulary")
    sizes = [r["size"] for r in vocabulary.select("size").distinct().collect()]  # at most SHINGLE of them
    split = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("mark"), words(F.col(text)).alias("words"))
    places = []
    for size in sorted(sizes):
        at = split.where(F.size("words") >= size).select("id", "mark", "words", F.size("words").alias("n"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("pos"))
        grams = at.select("id", "mark", "pos", "n", F.xxhash64(_gram(F.col("pos"), size), F.lit(size)).alias("gram_id"), _gram(F.col("pos"), size).alias("found"))
        known = vocabulary.where(F.col("size") == size)
        met = grams.join(_small(known, BROADCAST_SHINGLES), "gram_id").where("found = gram")
        places.append(met.select("id", "mark", "pos", "size", "gram_id", "n"))
    if not places:
        return docs.sparkSession.createDataFrame([], f"id {docs.schema[key].dataType.simpleString()}, mark long, start int, length int, window_id string")
    found = places[0]
    for more in places[1:]:
        found = found.unionAll(more)
    found = stored(found.distinct(), "places")  # repeated rows have the same places

    rarity = found.groupBy("gram_id").agg(F.count("*").alias("places"))
    coded = shingles.withColumn("gram_id", F.xxhash64("gram", "size")).drop("gram")
    ranked = coded.join(rarity, "gram_id")  # a window with a shingle that no document has can't occur
    prefix = ranked.groupBy("window_id", "n_shingles", "length").agg(F.min(F.struct("places", "gram_id", "k")).alias("rarest"), F.count("*").alias("present"))
    prefix = stored(prefix.where("present = n_shingles").select("window_id", "n_shingles", "length", "rarest.gram_id", "rarest.k"), "prefix")
    candidates = found.join(_small(prefix, BROADCAST_ROWS), "gram_id").where("n >= length and pos >= k and pos - k + length <= n").select("id", "mark", (F.col("pos") - F.col("k")).alias("start"), "length", "n_shingles", "window_id")
    steps = coded.select("window_id", "k", "gram_id")
    wanted = candidates.join(_small(stored(steps, "steps"), BROADCAST_ROWS), "window_id").withColumn("pos", F.col("start") + F.col("k"))
    matched = wanted.alias("w").join(found.alias("f"), (F.col("w.id").eqNullSafe(F.col("f.id"))) & (F.col("w.mark") == F.col("f.mark")) & (F.col("w.pos") == F.col("f.pos")) & (F.col("w.gram_id") == F.col("f.gram_id")), "left_semi")
    whole = matched.groupBy("id", "mark", "start", "length", "n_shingles", "window_id").agg(F.count("*").alias("met"))
    return whole.where("met = n_shingles").select("id", "mark", "start", "length", "window_id")


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``key, n_words, n_hit, n_items, items (array of text), contaminated`` for every row.

    A null, empty or wordless text has no words and no hits; items without words have no windows. Repeated rows get equal
    answers, and equal items count one each. Other columns are not looked at. Empty tables give no rows or no hits.
    """
    found = stored(occurrences(docs, items, key, text, item, item_text), "occurrences")
    spans = found.groupBy("id", "mark").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("stop")))).alias("spans"))  # bounded by the text
    step = lambda acc, s: F.struct((acc["hit"] + F.greatest(s["stop"] - F.greatest(s["start"], acc["stop"]), F.lit(0))).alias("hit"), F.greatest(acc["stop"], s["stop"]).alias("stop"))
    hit = spans.select("id", "mark", F.aggregate("spans", F.struct(F.lit(0).alias("hit"), F.lit(0).alias("stop")), step)["hit"].cast("long").alias("n_hit"))
    of_window = _windows(items, item, item_text).select(F.sha2("window", 256).alias("window_id"), F.col("item").cast("string").alias("item")).distinct()
    named = found.select("id", "mark", "window_id").distinct().join(_small(stored(of_window, "windows"), BROADCAST_ROWS), "window_id")
    named = named.groupBy("id", "mark").agg(F.sort_array(F.collect_set("item")).alias("items"))
    n = named.select(F.col("id").alias("n_id"), F.col("mark").alias("n_mark"), "items")
    hits = stored(hit.join(n, F.col("id").eqNullSafe(F.col("n_id")) & (F.col("mark") == F.col("n_mark"))).drop("n_id", "n_mark"), "hits")
    rows = docs.select(F.col(key), F.xxhash64(text).alias("_mark"), F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("n_words"))
    h = _small(hits, BROADCAST_ROWS // 10).alias("h")
    both = rows.join(h, F.col(key).eqNullSafe(F.col("h.id")) & (F.col("_mark") == F.col("h.mark")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    names = F.coalesce("items", F.array().cast("array<string>"))
    return both.select(key, "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"), names.alias("items"), (n_hit > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of any item lies, unchanged."""
    found = stored(occurrences(docs, items, key, text, item, item_text).select("id", "mark").distinct(), "contaminated")
    h = _small(found, BROADCAST_ROWS)
    return docs.join(h, docs[key].eqNullSafe(h["id"]) & (F.xxhash64(docs[text]) == h["mark"]), "left_anti")
