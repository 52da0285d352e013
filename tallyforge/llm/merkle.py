"""Merkle manifest of a table, kept as a postorder append log.

Leaves of a source are ranked by their key. Aligned builders, each over ``FAN ** TIER`` consecutive leaves, append every
node in the moment it is complete: a node follows its children, so a builder's log is the postorder of its subtree. The
place of node ``index`` of a level follows from the sizes of the subtrees before it (:func:`position`), so siblings are
addressed without a search and without an index. The tops of the builders are the leaves of the next tier, until a
source has one node left; the sources' nodes, ordered by source, are a tree of the same kind. Proofs are extracted from
the top tier down: each builder's log gives its leaves their siblings, and hands what lies above to the builders below.

A builder holds at most ``FAN ** TIER`` leaves, whatever the size of a source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.frames import stored
from tallyforge.llm.running import running

FAN, TIER = 16, 3
CHUNK = FAN**TIER

ABOVE = "array<struct<before:string,after:string>>"


def position(level: int, index, n: int, height: int):
    """Where node ``index`` of ``level`` stands in the postorder log of ``n`` leaves under ``height`` levels.

    The node ends with leaf ``e``. Every level has ``ceil(e / FAN ** m)`` nodes that begin up to there; all but the
    ``height - level`` ancestors of the node are complete.
    """
    e = np.minimum(n, (np.asarray(index, np.int64) + 1) * FAN**level)
    return sum(-(-e // FAN**m) for m in range(height + 1)) - 1 - (height - level)


def levels_over(n: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    height = 0
    while n > 1:
        n, height = -(-n // FAN), height + 1
    return height


def append_log(leaves: list[bytes], height: int) -> list[bytes]:
    """The digests of all nodes in the order in which they are complete."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(height + 1)]

    def append(level: int, digest: bytes) -> None:
        log.append(digest)
        open_runs[level].append(digest)
        if level < height and len(open_runs[level]) == FAN:
            close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        append(level + 1, node(run))

    for leaf in leaves:
        append(0, leaf)
    for level in range(height):
        if open_runs[level]:
            close(level)
    return log


def node(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join([c.hex() for c in children]).encode()).digest()


def leaf_digest(columns: list[str | Column]) -> Column:
    """Hex digest of a row: each value as its UTF-8 byte count, ``:`` and the value, or ``-`` if it is null."""
    texts = [(F.col(f"`{c}`") if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _chunks(leaves: DataFrame) -> DataFrame:
    """``leaves (grp, key, digest, other, i, n)`` as one row per builder: its keys and its log; written.

    ``first`` is the place of the builder's first entry in the log of its group at this tier.
    """
    kinds = {f.name: f.dataType.simpleString() for f in leaves.schema.fields}
    schema = f"grp {kinds['grp']}, block long, n long, height int, first long, keys array<{kinds['key']}>, others array<binary>, log binary, top binary"

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        n, block = table.column("n")[0].as_py(), table.column("block")[0].as_py()
        height = min(TIER, levels_over(n))
        log = append_log(table.column("digest").to_pylist(), height)
        first = int(position(0, block * CHUNK, n, levels_over(n)))
        one = {"grp": table.column("grp").slice(0, 1), "block": [block], "n": [n], "height": [height], "first": [first],
               "keys": [table.column("key").to_pylist()], "others": [table.column("other").to_pylist()], "log": [b"".join(log)], "top": [log[-1]]}
        types = {"block": pa.int64(), "n": pa.int64(), "height": pa.int32(), "first": pa.int64(), "keys": pa.list_(table.schema.field("key").type),
                 "others": pa.list_(pa.binary()), "log": pa.binary(), "top": pa.binary()}
        return pa.table({k: v if k == "grp" else pa.array(v, types[k]) for k, v in one.items()})

    dealt = leaves.withColumn("block", F.floor(F.col("i") / CHUNK))
    return stored(dealt.groupBy("grp", "block").applyInArrow(build, schema), "merkle-log")


def build_tiers(leaves: DataFrame) -> list[DataFrame]:
    """The builders' logs, tier by tier, until every group has one node."""
    tiers = [_chunks(leaves)]
    while True:
        left = tiers[-1].where(F.col("n") > CHUNK)
        if left.isEmpty():
            return tiers
        above = left.select("grp", F.col("block").alias("key"), F.col("top").alias("digest"), F.lit(None).cast("binary").alias("other"),
                            F.col("block").alias("i"), F.ceil(F.col("n") / CHUNK).alias("n"))
        tiers.append(_chunks(above))


def tops(tiers: list[DataFrame]) -> DataFrame:
    """``grp, top``: the last node of each group."""
    parts = [t.where(F.col("n") <= CHUNK).select("grp", "top") for t in tiers]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _levels(log: bytes, m: int, height: int) -> list[list[str]]:
    """The hex digests of each level below the top, by the places of their nodes in the log."""
    entries = np.frombuffer(log, np.uint8).reshape(-1, 32)
    found = []
    for level in range(height):
        raw = entries[position(level, np.arange(-(-m // FAN**level)), m, height)].tobytes().hex()
        found.append([raw[64 * j : 64 * j + 64] for j in range(len(raw) // 64)])
    return found


def _paths(m: int, levels: list[list[str]]) -> Iterator[tuple[int, list[tuple[str, str]]]]:
    """For each run of leaves: the number of its first one, and before and after of every level above the leaves."""
    for start in range(0, m, FAN):
        path, j = [], start // FAN
        for nodes in levels[1:]:
            run = j // FAN * FAN
            path.append(("".join(nodes[run:j]), "".join(nodes[j + 1 : run + FAN])))
            j //= FAN
        yield start, path


def _handed_down(chunks: DataFrame) -> DataFrame:
    """For every leaf of these builders what lies above it: ``grp, key, above`` and the group's ``subroot, root``."""
    kinds = {f.name: f.dataType.simpleString() for f in chunks.schema.fields}
    out = f"grp {kinds['grp']}, key {kinds['keys'][6:-1]}, above {ABOVE}, subroot string, root string"

    def hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                levels, held = _levels(row["log"], len(row["keys"]), row["height"]), row["above"]
                above = []
                for start, path in _paths(len(row["keys"]), levels):
                    upper = [{"before": b, "after": a} for b, a in path] + held
                    nodes = levels[0][start : start + FAN] if levels else []
                    for s in range(min(FAN, len(row["keys"]) - start)):
                        own = [{"before": "".join(nodes[:s]), "after": "".join(nodes[s + 1 :])}] if levels else []
                        above.append(own + upper)
                n = len(above)
                field = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
                grp = pa.array([row["grp"]] * n, batch.schema.field("grp").type)
                keys = batch.column(batch.schema.get_field_index("keys"))[k].values
                yield pa.RecordBatch.from_arrays([grp, keys, pa.array(above, field), pa.array([row["subroot"]] * n, pa.string()), pa.array([row["root"]] * n, pa.string())],
                                                 ["grp", "key", "above", "subroot", "root"])

    return chunks.mapInArrow(hand, out)


def _with_above(chunks: DataFrame, by_group: DataFrame, by_block: DataFrame | None) -> DataFrame:
    """Builders with the nodes above them: of their group where they are its last tier, else of their own top."""
    g = by_group.select(F.col("grp").alias("_g"), "above", "subroot", "root")
    alone = chunks.where(F.col("n") <= CHUNK).join(g, F.col("grp").eqNullSafe(F.col("_g"))).drop("_g")
    if by_block is None:
        return alone
    b = by_block.select(F.col("grp").alias("_g"), F.col("key").alias("_b"), "above", "subroot", "root")
    under = chunks.where(F.col("n") > CHUNK).join(b, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b"))).drop("_g", "_b")
    return alone.unionByName(under)


def _down(tiers: list[DataFrame], by_group: DataFrame) -> DataFrame:
    """The builders of the lowest tier with everything above them."""
    by_block = None
    for tier in reversed(tiers[1:]):
        by_block = stored(_handed_down(_with_above(tier, by_group, by_block)), "merkle-above")
    return _with_above(tiers[0], by_group, by_block)


def manifest(docs: DataFrame, key: str, group: str, columns: list[str], changed: dict[str, Column] | None = None, is_changed: Column | None = None) -> DataFrame:
    """A row per row of ``docs``: its key, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, the digest of its siblings from
    the leaf's own run up to the root, ``position``, its place in the log of its source's builders, and ``folded_root`` with
    ``verified``.

    ``folded_root`` is made from the leaf and its siblings; where ``is_changed`` holds, the leaf is that of the row with
    the columns of ``changed``, as if it had been altered after the manifest was made. Leaves of a source ascend by
    ``key``, null first; rows with one key ascend by their digest, and equal rows are leaves of their own. A null group
    is a group and comes first. A missing value and an empty text have different digests. A single leaf is its source's
    node, and a single source's node the root; then a proof is that of no siblings. An empty table gives no row. Columns
    that are not named are not looked at.
    """
    digest = lambda cols: F.unhex(leaf_digest(cols))
    other = F.lit(None).cast("binary")
    if changed and is_changed is not None:
        other = F.when(is_changed, digest([changed.get(c, F.col(f"`{c}`")) for c in columns]))
    leaves = stored(docs.select(F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("key"), digest(columns).alias("digest"), other.alias("other")), "merkle-leaves")
    ranked = running(leaves, "grp", ["key", "digest"], name="i").withColumnRenamed("i_total", "n").drop("row")
    tiers = build_tiers(ranked)
    sources = running(tops(tiers).select(F.col("grp").alias("key"), F.col("top").alias("digest")), None, ["key"], name="i").withColumnRenamed("i_total", "n")
    upper = build_tiers(sources.select(F.lit(0).alias("grp"), "key", "digest", F.lit(None).cast("binary").alias("other"), "i", "n"))
    root = tops(upper).select("grp", F.array().cast(ABOVE).alias("above"), F.lit("").alias("subroot"), F.lower(F.hex("top")).alias("root"))
    by_source = stored(_handed_down(_down(upper, root)), "merkle-sources").select(F.col("key").alias("_k"), "above", "root")
    last = tops(tiers).select("grp", F.lower(F.hex("top")).alias("subroot"))
    by_group = last.join(by_source, F.col("grp").eqNullSafe(F.col("_k"))).select("grp", "above", "subroot", "root")
    kind = docs.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, position long"
    return _down(tiers, by_group).mapInArrow(_prove, out)


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sha = hashlib.sha256
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            m, height, root = len(row["keys"]), row["height"], row["root"]
            levels = _levels(row["log"], m, height)
            own = levels[0] if levels else [row["top"].hex()]
            held = [(x["before"], x["after"]) for x in row["above"]]
            proofs, folded = [], []
            for start, path in _paths(m, levels):
                path = path + held
                rest = "".join([b + a for b, a in path])
                nodes = own[start : start + FAN]
                steps = [(b.encode(), a.encode()) for b, a in path]
                for s, leaf in enumerate(nodes):
                    before, after = ("".join(nodes[:s]), "".join(nodes[s + 1 :])) if levels else ("", "")
                    proofs.append(sha((before + after + rest).encode()).hexdigest())
                    other = row["others"][start + s]
                    digest = (leaf if other is None else other.hex()).encode()
                    if levels:
                        digest = sha(before.encode() + digest + after.encode()).hexdigest().encode()
                    for b, a in steps:
                        digest = sha(b + digest + a).hexdigest().encode()
                    folded.append(digest.decode())
            keys = batch.column(batch.schema.get_field_index("keys"))[k].values
            places = row["first"] + position(0, np.arange(m), m, height)
            columns = [keys, pa.array(own), pa.array([row["subroot"]] * m), pa.array([root] * m), pa.array(proofs), pa.array(folded), pa.array([f == root for f in folded]), pa.array(places)]
            names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "position"]
            yield pa.RecordBatch.from_arrays(columns, names)


def manifest_sql() -> str:
    """DuckDB SQL of :func:`manifest` over the table ``documents``, with the texts in lower case where 5 divides the checksum of the id."""
    part = lambda v: f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || {v} END"
    head = " || ".join(map(part, ("doc_id", "source", "lang", "n_chars")))
    body, lowered = part("text"), part("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    return f"""
    WITH RECURSIVE coded AS (
        SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
            lambda r, b: list_reduce(list_prepend(xor(r, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT) AS crc FROM documents),
    valued AS (SELECT *, {head} AS head, {body} AS body, {lowered} AS lowered FROM coded),
    hashed AS (SELECT doc_id, source, sha256(head || body) AS leaf, CASE WHEN crc % 5 = 0 THEN sha256(head || lowered) END AS altered FROM valued),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, row_number() OVER () AS rk FROM hashed),
    tree AS (
        SELECT source, 0 AS level, i AS idx, leaf AS h FROM leaves
        UNION ALL
        SELECT source, level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER (PARTITION BY source) AS c FROM tree) WHERE c > 1 GROUP BY source, level, idx // 16),
    subs AS (SELECT source, subroot, top, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM (SELECT source, arg_max(h, level) AS subroot, max(level) AS top FROM tree GROUP BY source)),
    upper AS (
        SELECT 0 AS level, place AS idx, subroot AS h FROM subs
        UNION ALL
        SELECT level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER () AS c FROM upper) WHERE c > 1 GROUP BY level, idx // 16),
    whole AS (SELECT arg_max(h, level) AS root, max(level) AS top FROM upper),
    placed AS (SELECT l.*, s.subroot, s.top, s.place FROM leaves l JOIN subs s ON s.source IS NOT DISTINCT FROM l.source),
    steps AS (
        SELECT rk, t.level AS step, string_agg(h, '' ORDER BY idx) FILTER (idx < i // CAST(pow(16, t.level) AS BIGINT)) AS b, string_agg(h, '' ORDER BY idx) FILTER (idx > i // CAST(pow(16, t.level) AS BIGINT)) AS a
        FROM placed p JOIN tree t ON t.source IS NOT DISTINCT FROM p.source AND t.level < p.top AND t.idx // 16 = p.i // CAST(pow(16, t.level + 1) AS BIGINT) GROUP BY rk, t.level
        UNION ALL
        SELECT rk, p.top + u.level, string_agg(h, '' ORDER BY idx) FILTER (idx < place // CAST(pow(16, u.level) AS BIGINT)), string_agg(h, '' ORDER BY idx) FILTER (idx > place // CAST(pow(16, u.level) AS BIGINT))
        FROM placed p, whole w, upper u WHERE u.level < w.top AND u.idx // 16 = p.place // CAST(pow(16, u.level + 1) AS BIGINT) GROUP BY rk, p.top, u.level),
    proofs AS (SELECT rk, sha256(string_agg(coalesce(b, '') || coalesce(a, ''), '' ORDER BY step)) AS proof FROM steps GROUP BY rk),
    folds AS (
        SELECT rk, 0 AS step, coalesce(altered, leaf) AS h FROM placed
        UNION ALL
        SELECT f.rk, f.step + 1, sha256(coalesce(b, '') || h || coalesce(a, '')) FROM folds f JOIN steps s ON s.rk = f.rk AND s.step = f.step),
    folded AS (SELECT rk, arg_max(h, step) AS h FROM folds GROUP BY rk)
    SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified,
        CAST(list_sum(list_transform(range(0, p.top + 1), lambda m: ceil((i + 1) / pow(16, m)))) - 1 - p.top AS BIGINT) AS position
    FROM placed p JOIN folded f ON f.rk = p.rk LEFT JOIN proofs q ON q.rk = p.rk, whole
    """
