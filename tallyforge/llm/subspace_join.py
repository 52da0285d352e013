"""Vectors of one label with a high cosine, by a subspace pigeonhole join.

For unit vectors a cosine of at least ``c`` is a squared distance of at most ``2 - 2c``. Rotated at random and split into
blocks of equal dimension, two such vectors have a group of blocks in which their squared distance is within that group's
share of the budget, however the budget is shared out. Equal shares for single blocks would ask for a join per block, and
at 64 dimensions a block's radius is as large as the spread of a coordinate: each join would compare most pairs of a label
and a grid would send a vector to dozens of cells. So the whole budget goes to one group, the :data:`LEADING` blocks and
the length of what is left, and the other blocks get nothing: no pair has to be looked for there, one join sees every pair
once, and its bound leaves out all but a few of the pairs that are not near. These are checked exactly.

A label is cut into slices of bounded size that are written once. Two slices meet in a task, and in one turn a slice goes
to one task only, so a turn moves each vector once whatever the number of slices; its files go before the next turn. Where
the radius is small against the spread of a coordinate, the slices are cut along the first coordinate into cells, and a
vector visits the cell below if it is within the radius of it. A task gives out numbers of links and a spanning forest of
them, both linear in its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.components import components
from tallyforge.llm.frames import release, scratch, stored
from tallyforge.session import remove_path

COSINE = 0.93
BLOCKS = 8
#: Blocks that hold the budget.
LEADING = 3
#: Width of a cell, in radii.
CELL = 3.0
#: A label is cut into cells only beyond so many vectors, and only where a cell is at most ``WIDE`` spreads of a coordinate.
PER_GRID = 2_000
WIDE = 2.0
#: Rows of a slice, and numbers in it: a larger cell is dealt into slices, and a task compares two of them.
CELL_ROWS = 65_536
CELL_VALUES = 4 << 20
#: Numbers in a row of packed vectors.
PIECE_VALUES = 64 << 10
#: Rows compared with twice as many at a time.
STEP = 256
#: Added to bounds against the rounding of single precision, and per dimension.
SLACK, SLACK_D = 1e-5, 2.4e-7
#: Turns whose vectors are sent to tasks at a time, or as many as send no more than ``MOVED_ROWS`` vectors.
TURNS = 2
MOVED_ROWS = 500_000
BROADCAST_ROWS = 1_000_000
#: Vectors of several rows that are broadcast at most.
BROADCAST_VECTORS = 50_000
#: What a task compares at a time: two slices of a cell, or one with itself.
PAIR = ("label", "d", "block", "cell", "i", "j")
SLICE = ("label", "d", "block", "cell", "slice")
#: Rows of packed vectors are large: few of them at a time in a reader, a writer and a batch.
PACKED = {"spark.sql.parquet.columnarReaderBatchSize": "16", "spark.sql.execution.arrow.maxBytesPerBatch": "4m", "parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "8", "parquet.page.size.row.check.min": "1"}


@lru_cache(maxsize=4)
def rotation(d: int, seed: int = 11) -> np.ndarray:
    """A fixed random rotation of ``d`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def bounds(d: int, blocks: int = BLOCKS) -> list[tuple[int, int]]:
    """First and last coordinate of each block; fewer blocks than asked for when there are fewer dimensions."""
    edges = np.linspace(0, d, min(blocks, d) + 1).astype(int)
    return [(int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def radius(cosine: float) -> float:
    """The distance that is the whole budget."""
    return float(np.sqrt(max(2 - 2 * cosine, 0) + SLACK))


def _matrix(column: pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row.

    Rows link when their labels are equal and not null and the cosine of their vectors, in double precision, is at least
    ``cosine``. A vector that is null, empty, zero or has a null or non-finite component links with nothing, and so does a
    row without a key; vectors of different dimension do not link. Equal vectors of a label are one node with as many
    copies; repeated rows are copies like any other. Other columns are not looked at; an empty table gives an empty one.
    """
    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    good = F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0), F.lit(False))
    good = good & F.col("id").isNotNull() & F.col("label").isNotNull()
    with scratch() as keep:
        nodes = rows.where(good).groupBy("label", "vector").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
        nodes = stored(nodes.withColumn("d", F.size("vector")), "vectors")
        narrow = (CELL * radius(cosine) * F.sqrt("d") <= WIDE) & (F.col("n") > PER_GRID)
        shapes = nodes.groupBy("label", "d").agg(F.count("*").alias("n"))
        sides = stored(shapes.select("label", "d", F.when(narrow, 1).otherwise(0).alias("grid")), "grids")
        placed = nodes.join(F.broadcast(sides) if sides.count() <= BROADCAST_ROWS else sides, ["label", "d"])
        repeated = keep(stored(nodes.where("copies > 1").select("label", "vector", "node", "copies"), "repeated"))
        n = nodes.count()
        with _settings(vectors.sparkSession, PACKED):
            packed = stored(slices(placed, cosine, kind), "slices")
            remove_path(nodes.sparkSession, nodes.tallyforge_path)  # from here on only the slices are read
            sums, links = _met(packed, n, cosine, kind)
        sums, roots = keep(sums), keep(stored(components(links).select(F.col("id").alias("node"), "root"), "roots"))
        n = repeated.count()
    # a vector of one row is its own node; only those of several rows are looked up by the vector
    named = rows.where(good)
    if n:
        named = named.join(F.broadcast(repeated) if n <= BROADCAST_VECTORS else repeated, ["label", "vector"], "left")
    else:
        named = named.withColumns({"node": F.lit(None).cast(kind), "copies": F.lit(None).cast("long")})
    named = named.select("id", F.coalesce("node", "id").alias("node"), F.coalesce("copies", F.lit(1)).alias("copies"))
    found = named.join(sums, "node", "left").join(roots, "node", "left")
    linked = found.select("id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    alone = rows.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionAll(alone).select(F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _cells(placed: DataFrame, cosine: float, kind: str) -> DataFrame:
    """The rows of every cell, at home or visiting. Without a grid a label is one cell."""
    types = {f.name: f.dataType.simpleString() for f in placed.schema}
    width = CELL * radius(cosine)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, vector, node, copies, d = (batch.column(batch.schema.get_field_index(c)) for c in ("label", "vector", "node", "copies", "d"))
            for dim in np.unique(d.to_numpy()):
                at = np.flatnonzero(d.to_numpy() == dim)
                x = _matrix(vector.take(pa.array(at))).astype(float)
                where = x @ rotation(int(dim))[:, 0] / np.sqrt(np.einsum("ij,ij->i", x, x)) / width
                home = np.floor(where).astype(np.int64)
                below = np.flatnonzero(where - home <= 1 / CELL)  # a pair of two cells is met in the lower one
                take = pa.array(np.concatenate((at, at[below])))
                cell, own = np.concatenate((home, home[below] - 1)), np.arange(len(take)) < len(at)
                columns = [label.take(take), pa.array(np.full(len(take), dim, np.int32)), pa.array(cell), pa.array(own), node.take(take), copies.take(take), vector.take(take)]
                yield pa.RecordBatch.from_arrays(columns, ["label", "d", "cell", "home", "node", "copies", "vector"])

    whole = placed.where("grid = 0").select("label", F.col("d").cast("int").alias("d"), F.lit(0).cast("long").alias("cell"), F.lit(True).alias("home"), "node", "copies", "vector")
    cut = placed.where("grid > 0")
    if not cut.isEmpty():
        cut = cut.mapInArrow(place, f"label {types['label']}, d int, cell long, home boolean, node {kind}, copies long, vector {types['vector']}")
        whole = whole.unionAll(cut)
    return whole.select("label", "d", F.lit(0).alias("block"), "cell", "home", "node", "copies", "vector")


def slices(placed: DataFrame, cosine: float, kind: str) -> DataFrame:
    """The cells cut into ``parts`` slices of about as many rows, each as a few rows of packed vectors (``rows``)."""
    cells = _cells(placed, cosine, kind)
    bucket = list(SLICE[:-1])
    size = F.ceil(F.greatest(F.count("*") / CELL_ROWS, F.count("*") * F.col("d") / CELL_VALUES)).cast("int")
    parts = stored(cells.groupBy(*bucket).agg(size.alias("parts"), F.max("home").alias("lived")).where("lived").drop("lived"), "parts")
    cells = cells.join(F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts, bucket)
    cells = cells.withColumn("slice", F.pmod(F.xxhash64("vector", F.lit(1)), "parts").cast("int")).repartition(*SLICE).sortWithinPartitions(*SLICE)
    types = {f.name: f.dataType.simpleString() for f in cells.schema}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now, n = None, 0
        for batch in batches:
            names, columns = _names(batch, SLICE), batch.select(["home", "node", "copies", "vector"])
            most = {d: max(1, PIECE_VALUES // d) for d in set(batch.column(batch.schema.get_field_index("d")).to_pylist())}
            labels, parts = batch.column(batch.schema.get_field_index("label")), batch.column(batch.schema.get_field_index("parts"))
            start = 0
            for i, name in enumerate([*names, None]):
                if i > start and (name != names[start] or n + i - start >= most[name[1]]):
                    if held and now[0] != names[start]:
                        yield _piece(now, held)
                        held, n = [], 0
                    held.append(columns.slice(start, i - start))
                    now = names[start], labels.slice(start, 1), parts.slice(start, 1)
                    n += i - start
                    start = i
                    if n >= most[now[0][1]]:
                        yield _piece(now, held)
                        held, n = [], 0
        if held:
            yield _piece(now, held)

    return cells.mapInArrow(pack, f"label {types['label']}, d int, block int, cell long, slice int, parts int, rows binary")


def _names(batch: pa.RecordBatch, columns: tuple[str, ...]) -> list[tuple]:
    return list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns), strict=True))


def _piece(name: tuple, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    (_, d, block, cell, part), label, parts = name
    table = pa.Table.from_batches(held).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    columns = [label, pa.array([d], pa.int32()), pa.array([block], pa.int32()), pa.array([cell], pa.int64()), pa.array([part], pa.int32()), parts, pa.array([sink.getvalue().to_pybytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, [*SLICE, "parts", "rows"])


def in_pairs(packed: DataFrame, first: int = 0, last: int | None = None) -> DataFrame:
    """The slices of every cell under the pairs ``i <= j`` of slices that a task compares, in the turns from ``first`` to before ``last``.

    In turn ``t`` slice ``s`` meets the slice that makes ``s + other`` equal ``t`` modulo their number: it has one partner a
    turn, itself included, and meets each in one turn.
    """
    end = F.col("parts") if last is None else F.least(F.lit(last), F.col("parts"))
    turns = packed.where(F.col("parts") > first).withColumn("turn", F.explode(F.sequence(F.lit(first), end - 1)))
    other = F.pmod(F.col("turn") - F.col("slice"), "parts")
    return turns.withColumns({"i": F.least("slice", other), "j": F.greatest("slice", other)}).select(*PAIR, "slice", "rows")


def dealt_cells(placed: DataFrame, cosine: float, kind: str) -> DataFrame:
    """All slices of every cell under all pairs that they meet in."""
    return in_pairs(slices(placed, cosine, kind))


def _met(packed: DataFrame, n: int, cosine: float, kind: str) -> tuple[DataFrame, DataFrame]:
    """``(node, linked)``, numbers of linked copies, and ``(a, b)``, links that connect what is connected.

    What the turns give out is added up whenever it has become more than the vectors.
    """
    last = packed.agg(F.max("parts")).first()[0] or 0
    step = max(TURNS, MOVED_ROWS // max(n, 1))
    sums, links, met, rows = None, None, [], 0
    for first in range(0, max(last, 1), step):
        pairs = in_pairs(packed, first, first + step).repartition(*PAIR).sortWithinPartitions(*PAIR)
        met.append(stored(pairs.mapInArrow(_comparer(cosine, STEP), f"node {kind}, other {kind}, n long"), "links"))
        rows += met[-1].count()
        if rows > n or first + step >= last:
            found = met[0]
            for more in met[1:]:
                found = found.unionAll(more)
            own, joined = found.where("other is null").select("node", "n"), found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
            steps = [x for x in (sums, links, *met) if x is not None]
            sums = stored((own if sums is None else own.unionAll(sums.select("node", F.col("linked").alias("n")))).groupBy("node").agg(F.sum("n").alias("linked")), "sums")
            links = joined if links is None else joined.unionAll(links)
            if first + step >= last:
                break
            with scratch() as keep:
                links = keep(stored(components(links).toDF("a", "b"), "links"))
            for x in steps:
                remove_path(x.sparkSession, x.tallyforge_path)
            met, rows = [], 0
    return sums, links


def _comparer(cosine: float, step: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, pa.Buffer]] = []
        now = None
        for batch in batches:
            rows, part = batch.column(batch.schema.get_field_index("rows")), batch.column(batch.schema.get_field_index("slice"))
            for k, name in enumerate(_names(batch, PAIR)):
                if name != now and held:
                    yield from _links(now, held, cosine, step)
                    held = []
                now = name
                held.append((part[k].as_py(), rows[k].as_buffer()))
        if held:
            yield from _links(now, held, cosine, step)
        release()

    return compare


def _links(name: tuple, held: list[tuple[int, pa.Buffer]], cosine: float, step: int) -> Iterator[pa.RecordBatch]:
    """What links the rows of two slices, or of one."""
    _, d, _, _, i, j = name
    sides, ends = [], [0]
    for part in (i, j) if i < j else (i,):
        tables = [pa.ipc.open_stream(rows).read_all() for k, rows in held if k == part]
        for home in (True, False):  # rows at home first
            own = [t if t.column("home").unique().to_pylist() == [home] else t.filter(pc.equal(t.column("home"), home)) for t in tables]
            sides += own
            ends.append(ends[-1] + sum(t.num_rows for t in own))
    held.clear()
    del tables, own
    ranges = [range(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    # rows of one slice meet each other, those of two slices each other's; of two visitors none is at home here
    meet = [(ranges[0], ranges[0]), (ranges[0], ranges[1])] if i == j else [(ranges[0], ranges[2]), (ranges[0], ranges[3]), (ranges[2], ranges[1])]
    if not any(len(a) and len(b) for a, b in meet):
        return
    table = pa.concat_tables(sides).select(["node", "copies", "vector"])
    del sides
    cell = Compared(_matrix(table.column("vector")), table.column("copies").to_numpy(), cosine, step)
    node = table.column("node").combine_chunks()
    del table
    for mine, others in meet:
        cell.compare(mine, others)
    counted, root = np.flatnonzero(cell.n), cell.roots()
    joined = np.flatnonzero(root != np.arange(len(root)))
    take = lambda rows: node.take(pa.array(rows))
    yield pa.RecordBatch.from_arrays([take(counted), pa.nulls(len(counted), node.type), pa.array(cell.n[counted])], ["node", "other", "n"])
    yield pa.RecordBatch.from_arrays([take(joined), take(root[joined]), pa.array(np.zeros(len(joined), np.int64))], ["node", "other", "n"])


class Compared:
    """Numbers of links of rows, and a forest of them, over the pairs compared so far."""

    #: Links that wait before they are put into the forest.
    WAIT = 200_000

    def __init__(self, x: np.ndarray, copies: np.ndarray, cosine: float, step: int = STEP) -> None:
        self.x, self.copies, self.cosine, self.step = x, copies, cosine, step
        d = x.shape[1]
        q, lead = rotation(d), bounds(d)[: LEADING][-1][1]
        self.size, self.short = np.empty(len(x)), np.empty((len(x), lead + 1), np.float32)
        for at in range(0, len(x), 4096):
            some = x[at : at + 4096].astype(float)
            self.size[at : at + 4096] = np.sqrt(np.einsum("ij,ij->i", some, some))
            y = (some / self.size[at : at + 4096, None]) @ q
            self.short[at : at + 4096, :lead] = y[:, :lead]
            self.short[at : at + 4096, lead] = np.sqrt(np.einsum("ij,ij->i", y[:, lead:], y[:, lead:]))
        self.slack = SLACK + SLACK_D * d
        self.n, self.root = np.zeros(len(x), np.int64), np.arange(len(x))
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0
        self.product, self.near = np.empty(2 * step * step, np.float32), np.zeros(2 * step * step + 8, bool)

    def compare(self, mine: range, others: range) -> None:
        """Every row of ``mine`` with every one of ``others``; a range with itself, each pair once."""
        same, step = mine == others, self.step
        for a in range(mine.start, mine.stop, step):
            rows = range(a, min(a + step, mine.stop))
            for b in range(a if same else others.start, others.stop, 2 * step):
                self._tile(rows, range(b, min(b + 2 * step, others.stop)), same and b == a)

    def _tile(self, rows: range, cols: range, same: bool) -> None:
        shape, total = (len(rows), len(cols)), len(rows) * len(cols)
        product, near = self.product[:total].reshape(shape), self.near[:total]
        np.matmul(self.short[rows.start : rows.stop], self.short[cols.start : cols.stop].T, out=product)
        np.greater_equal(product, np.float32(self.cosine - self.slack), out=near.reshape(shape))
        self.near[total : total + 8] = False
        words = np.flatnonzero(self.near[: -(-total // 8) * 8].view(np.uint64))
        if not len(words):
            return
        if 32 * len(words) > total:
            self._dense(rows, cols, same)
            return
        at = (8 * words[:, None] + np.arange(8)).ravel()
        at = at[self.near[at]]
        a, b = rows.start + at // len(cols), cols.start + at % len(cols)
        if same:
            a, b = a[a < b], b[a < b]
        good = self._exact(a, b)
        a, b = a[good], b[good]
        if len(a):
            np.add.at(self.n, a, self.copies[b])
            np.add.at(self.n, b, self.copies[a])
            self.waiting.append((a, b))
            self.held += len(a)
            if self.held >= self.WAIT:
                self.roots()

    def _exact(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), bool)
        for k in range(0, len(a), 8192):
            i, j = a[k : k + 8192], b[k : k + 8192]
            out[k : k + 8192] = np.einsum("ij,ij->i", self.x[i].astype(float), self.x[j].astype(float)) / (self.size[i] * self.size[j]) >= self.cosine
        return out

    def _dense(self, rows: range, cols: range, same: bool) -> None:
        """Many near pairs: all cosines at once in single precision, those that it can't tell exactly."""
        one, two = ((self.x[r.start : r.stop] / self.size[r.start : r.stop, None]).astype(np.float32) for r in (rows, cols))
        cosines = one @ two.T
        links = cosines >= np.float32(self.cosine + self.slack)
        a, b = np.nonzero((cosines >= np.float32(self.cosine - self.slack)) & ~links)
        links[a, b] = self._exact(rows.start + a, cols.start + b)
        if same:  # the columns begin with the rows
            links &= np.arange(len(cols)) > np.arange(len(rows))[:, None]
        weight = links.astype(float)
        self.n[rows.start : rows.stop] += (weight @ self.copies[cols.start : cols.stop].astype(float)).astype(np.int64)
        self.n[cols.start : cols.stop] += (self.copies[rows.start : rows.stop].astype(float) @ weight).astype(np.int64)
        root = self.roots()
        while (apart := links & (root[rows.start : rows.stop, None] != root[cols.start : cols.stop])).any():
            a, b = np.flatnonzero(apart.any(axis=1)), np.flatnonzero(apart.any(axis=0))
            self.waiting.append((rows.start + np.concatenate((a, apart[:, b].argmax(axis=0))), cols.start + np.concatenate((apart[a].argmax(axis=1), b))))
            root = self.roots()

    def roots(self) -> np.ndarray:
        """The smallest row that each one is connected with."""
        if self.waiting:
            a, b = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
            root = self.root
            while len(a):
                least = np.minimum(root[a], root[b])
                np.minimum.at(root, root[a], least)
                np.minimum.at(root, root[b], least)
                while (root != root[root]).any():
                    root = root[root]
                apart = root[a] != root[b]
                a, b = a[apart], b[apart]
            self.root, self.waiting, self.held = root, [], 0
        return self.root
