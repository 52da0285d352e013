"""A mix of sources at target weights, laid out by a low-discrepancy schedule.

Each source is one stream of words: its documents in the order of a hash of their key. The stream is cut into blocks of
equal numbers of words, and a slot of the mix takes one block. Which source a slot takes is told by the van der Corput
sequence: its points, over a grid of a power of two, are mapped through the cumulative weights of the sources. The grid
is a permutation of the times, so the points of a source are the grid values inside its interval, and the time of a value
is its bit reversal; nothing is searched. Slots of a source are ranked by time, and rank ``r`` takes its ``r``-th block,
from the first again after the last. After any number of slots every source has had its share up to a few slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.frames import stored
from tallyforge.llm.running import running
from tallyforge.operators.joins import attach

#: Words in a block: one slot of the mix.
BLOCK_WORDS = 2048
#: Grid values that one row is spread into at a time.
SPREAD = 1 << 16

WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: str | Column) -> Column:
    """Words of a text, parted by ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``sources (source, weight, source_size)`` with ``target``, their words in the mix.

    All targets together are ``share`` times all sizes, dealt by weight; one that is above ``most`` times its source's size
    stops there, and what it leaves is dealt to the others by weight, until none is above. Each round is one aggregate
    over the sources, of which one row reaches the driver.
    """
    cap = F.col("source_size") * F.lit(float(most))
    level, capped = None, 0
    while True:
        over = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum("source_size").alias("size"),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)).alias("taken"),
            F.sum(F.when(~over, F.col("weight"))).alias("weight"),
            F.count(F.when(over, 1)).alias("capped"),
        ).first()
        if level is not None and row["capped"] == capped or not row["weight"] or not row["size"]:
            break
        level, capped = (share * row["size"] - row["taken"]) / row["weight"], row["capped"]
    target = F.lit(0.0) if level is None else F.least(cap, F.col("weight") * F.lit(level))
    return sources.withColumn("target", target)


def _reversed_bits(value: Column, bits: int) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(value), bits, "0")), 2, 10).cast("long")


def schedule(targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: ``source, time, block, words``, with ``time`` their order and ``words`` how many of the block's
    first words are taken.

    A source has as many slots as its whole target fills, passes over its stream included; only the last slot of a pass
    and the last one of all are short. Sources without a word or a target have none.
    """
    sized = targets.where("source_size > 0 and target >= 1").withColumn("take", F.floor("target"))
    blocks, passes = F.ceil(F.col("source_size") / block), F.floor(F.col("take") / F.col("source_size"))
    slots = passes * blocks + F.ceil((F.col("take") - passes * F.col("source_size")) / block)
    placed = running(sized.withColumn("blocks", blocks.cast("long")).withColumn("slots", slots.cast("long")), None, [F.col("source").isNull(), "source"], F.col("slots"), "from")
    placed = stored(placed.drop("row"), "mix-sources")
    total = placed.agg(F.max("from_total")).first()[0]
    if total is None:
        return placed.select("source", F.col("from").alias("time"), F.col("from").alias("block"), F.col("from").alias("words"))
    bits = max((2 * total - 1).bit_length(), 1)  # at least two points for each slot: no interval gets too few
    grid = lambda c: F.expr(f"cast(ceil(({c}) * {1 << bits}D / {total}D) as bigint)")
    low, high = grid("`from`"), grid("`from` + slots")
    parts = placed.select("source", "source_size", "take", "blocks", "slots", low.alias("low"), high.alias("high"))
    parts = parts.withColumn("part", F.explode(F.sequence(F.col("low"), F.col("high") - 1, F.lit(SPREAD).cast("long")))).repartition("source", "part")
    value = F.explode(F.sequence(F.col("part"), F.least(F.col("part") + SPREAD, F.col("high")) - 1))
    points = parts.select("source", "source_size", "take", "blocks", "slots", value.alias("v")).withColumn("time", _reversed_bits(F.col("v"), bits)).drop("v")
    ranked = running(points, "source", ["time"], name="rank").where("rank < slots")
    at, turn = F.col("rank") % F.col("blocks"), F.floor(F.col("rank") / F.col("blocks"))
    words = F.least(F.lit(block), F.col("source_size") - at * block, F.col("take") - turn * F.col("source_size") - at * block)
    return ranked.select("source", "time", at.alias("block"), words.cast("long").alias("words"))


def streams(docs: DataFrame, key: str, source: str, text: str, seed: int | str) -> DataFrame:
    """``key, source, size, row, at, source_size``: where each document begins in the shuffled stream of its source; written."""
    sizes = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"))
    order = F.md5(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(f":{seed}")))
    placed = running(stored(sizes, "mix-sizes"), "source", [order, "key", "size"], F.col("size"))
    return stored(placed.withColumnRenamed("at_total", "source_size"), "mix-streams")


def mix(
    docs: DataFrame, key: str, source: str, text: str = "text", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
    block: int = BLOCK_WORDS, seed: int | str = "mix",
) -> tuple[DataFrame, DataFrame]:
    """The mix as ``(pieces, documents)``.

    ``pieces``: a row per slot and document in it: ``time`` orders the slots, ``first`` and ``taken`` are words of the
    document, ``at`` its place in the slot. ``documents``: every row of ``docs`` with ``size``, ``source_size``, ``target`` and
    ``taken``, the words the mix takes of it, repeats counted.

    Sources are ordered by code point, null last, and weigh ``weights`` in turn. Null and empty texts have no words and are
    taken nowhere; a null source is a source, a null key a key. Rows with one key are documents of their own, ordered by
    size. A document of any length is cut at the blocks' edges. No document is taken more often than ``most``, rounded up,
    says. The order depends on keys and ``seed`` alone, so a repeated run gives the same rows. An empty table gives no
    slot. Columns that are not named are not looked at.
    """
    rows = streams(docs, key, source, text, seed)
    sizes = rows.groupBy("source").agg(F.max("source_size").alias("source_size"))
    ordered = running(sizes, None, [F.col("source").isNull(), "source"], name="place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    targets = stored(source_targets(stored(ordered.select("source", "source_size", weight.alias("weight")), "mix-weights"), share, most), "mix-targets")
    slots = schedule(targets, block)
    ends = F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))
    cut = rows.where("size > 0").select("row", "source", "at", "size", F.explode(ends).alias("b"))
    cut = cut.select("row", "source", "b", "at", F.greatest(F.col("at"), F.col("b") * block).alias("low"), F.least(F.col("at") + F.col("size"), (F.col("b") + 1) * block).alias("high"))
    s = slots.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "time", "words")
    joined = cut.join(s, F.col("source").eqNullSafe(F.col("_s")) & (F.col("b") == F.col("_b")))
    taken = F.least(F.col("high") - F.col("b") * block, F.col("words")) - (F.col("low") - F.col("b") * block)
    pieces = joined.select("time", "source", F.col("b").alias("block"), "row", (F.col("low") - F.col("at")).alias("first"), (F.col("low") - F.col("b") * block).alias("at"), taken.alias("taken")).where("taken > 0")
    per_row = pieces.groupBy("row").agg(F.sum("taken").alias("taken"))
    every = attach(rows.join(per_row, "row", "left"), targets.select("source", "target"), ("source",), "left")
    documents = every.select(F.col("key").alias(key), F.col("source").alias("source"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "row")
    return pieces, documents


def mix_sql(weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix") -> str:
    """DuckDB SQL for ``documents`` of :func:`mix`: what all slots of a source take together is one or more passes over its stream."""
    case = " ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(weights))
    return f"""
    WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
    placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{seed}'), doc_id NULLS FIRST, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM sized),
    src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {case} END AS w FROM sized GROUP BY source),
    lev AS (SELECT ({share} * sum(source_size) OVER () - coalesce(sum({float(most)} * source_size) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS lam
        FROM src WINDOW before AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (SELECT max(lam) AS lam FROM lev),
    t AS (SELECT source, source_size, least({float(most)} * source_size, w * lam) AS target FROM src, level)
    SELECT p.doc_id, p.size, t.source_size, t.target,
      CAST(CASE WHEN t.source_size = 0 THEN 0 ELSE greatest(0, least(p.size, least(floor(t.target), t.source_size) - pos)) + greatest(0, least(p.size, floor(t.target) - t.source_size - pos)) END AS BIGINT) AS taken
    FROM placed p JOIN t ON t.source IS NOT DISTINCT FROM p.source
    """
