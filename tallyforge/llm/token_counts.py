"""Token counts by a two-tier table of pre-token lengths.

First tier: pre-tokens that are frequent, with their numbers of tokens, as a small broadcast table. It is learned from a
bounded sample of the texts, chosen by a hash of their keys, in one task: the table only steers how often the library
is asked, so nothing that is counted depends on it and no pre-token of the corpus is shuffled. Second tier: what the
table lacks is given to the library once per worker and kept there, within a bound.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.frames import grouped, records, worker_value
from tallyforge.llm.word_bpe import KEEP_CHARS, KEEP_WORDS, WordBpe, pieces

#: Pre-tokens in the broadcast table (about 1 MB).
TABLE_WORDS = 16_384
#: Texts the table is learned from, about, and at most twice as many.
SAMPLE_TEXTS = 2_000
#: The counter is cut back to its most frequent half beyond this many pre-tokens.
COUNTED = 200_000


def frequent_pretokens(docs: DataFrame, path: str, keys: list[str], text: str = "text", size: int = TABLE_WORDS) -> dict[str, int]:
    """The lengths in tokens of the ``size`` most frequent pre-tokens of a sample of the texts (ties by the pre-token)."""
    rows = docs.count()
    share = min(1.0, SAMPLE_TEXTS / max(rows, 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen = worker_value(("bpe", path), lambda: WordBpe(path)), Counter()
        for _, texts in grouped(batches, "_text", keep=(("bpe", path),)):
            for t in texts:
                for piece in pieces(t):
                    seen.update(bpe.pretokens(piece))
            if len(seen) > COUNTED:
                seen = Counter(dict(seen.most_common(COUNTED // 2)))
        top = sorted(((w, n) for w, n in seen.items() if len(w) <= KEEP_CHARS), key=lambda x: (-x[1], x[0]))[:size]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string())], ["word"])

    low = F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = docs.where(low).select(F.col(text).alias("_text")).limit(2 * SAMPLE_TEXTS).repartition(1)
    top = sample.mapInArrow(count, "word string").collect()  # at most ``size`` words
    return {w: len(ids) // 4 for w, ids in WordBpe(path).encode([r["word"] for r in top])}


def count_tokens(docs: DataFrame, path: str, keys: list[str], text: str = "text", limit: int = 2048) -> DataFrame:
    """``keys`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` for every row.

    Null and empty texts have no bytes and no tokens. Every input row gives one row, repeated ones too; other columns
    are not looked at. An empty table gives an empty one.
    """
    source = docs.select(*keys, F.col(text).alias("_text"))
    name = uuid.uuid4().hex
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_pretokens(docs, path, keys, text))
    out = source.select(*keys, F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_tokens"), F.lit(False).alias("over_limit")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_value(("bpe", path), lambda: WordBpe(path))
        table = worker_value(("lengths", name), lambda: dict(frequent.value))
        for part, texts in grouped(batches, "_text", keep=(("bpe", path), ("lengths", name))):
            if len(table) > KEEP_WORDS:
                table.clear()
                table.update(frequent.value)
            totals = []
            for t in texts:
                total = 0
                for piece in pieces(t):
                    words = bpe.pretokens(piece)
                    found = list(map(table.get, words))
                    if None in found:
                        new = {w: len(x) // 4 for w, x in bpe.encode({w for w, n in zip(words, found, strict=True) if n is None})}
                        found = [new[w] if n is None else n for w, n in zip(words, found, strict=True)]
                        table.update((w, n) for w, n in new.items() if len(w) <= KEEP_CHARS)
                    total += sum(found)
                totals.append(total)
            n_bytes = [len(t.encode("utf-8")) for t in texts]
            columns = {k: part.column(i) for i, k in enumerate(keys)} | {"n_bytes": n_bytes, "n_tokens": totals, "over_limit": [n > limit for n in totals]}
            schema = pa.schema([part.schema.field(k) for k in keys] + [("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
            yield records(columns, schema)

    return source.mapInArrow(count, out)
