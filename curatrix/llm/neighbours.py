"""Nearest neighbours by cosine: vantage-point trees in shards, pruned by the triangle inequality.

Vectors are set to length one, where the chord ``sqrt(2 - 2 cos)`` is a metric that orders as
the cosine does. A first tree, laid over a bounded sample, deals every vector to a leaf; leaves
of more than ``SHARD`` vectors are dealt on to shards by a hash. In each shard a tree splits
its vectors at the median distance from a vantage point, and keeps the least and the largest
distance on either side. A side whose nearest possible distance, times ``factor``, is beyond
the worst neighbour found is left out; leaves are compared by matrix products. Factor one
leaves out only what can't hold a neighbour, so its answer is exact; larger ones leave out more.

Each query first searches the shard it would be dealt to. What it found bounds the search:
blocks of queries then go to those leaves alone that the same test doesn't rule out. Blocks
travel, not pairs, and only neighbours better than those known come back. A shard's vectors
are sent once for each ``BLOCKS_A_TASK`` blocks of queries, so a task's work has a bound too.

Of equal vectors the ``k + 1`` smallest ids are searched: none after them can be among k nearest.
Only leaves' bounds and sampled vectors reach the driver, both of bounded size.

Defined results: scores are cosines in double precision of the vectors as stored; ties go to the
smaller id; null ids, and vectors that are null, empty, zero or hold null or non-finite numbers
take no part; queries see only vectors of their own number of components; repeated rows count
once; rows that share an id are never each other's neighbours, and a query id with several
vectors gets the nearest to any of them; fewer candidates than k are all returned; empty tables
give no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.llm.common import materialize, table

K, FACTOR, QUERY_STEP = 5, 4.0, 50
#: Vectors of a shard and of a tree's leaf; queries of a block; blocks that a task searches a shard for.
SHARD, LEAF, BLOCK, BLOCKS_A_TASK = 16_384, 64, 1024, 64
#: The sample that the first tree is laid over, and its leaves, at most.
SAMPLE, MAX_LEAVES = 20_000, 1024
#: More than rounding can move a distance near zero.
SLACK, ROUNDING = 1e-7, 1e-9
FAR = 3.0


@dataclass
class Node:
    """A vantage point with the distances to it on either side, or, without sides, a leaf's rows."""

    rows: np.ndarray
    vantage: np.ndarray | None = None
    bounds: tuple[tuple[float, float], ...] = ()
    sides: tuple[Node, ...] = ()


def chord(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosines))


def vantage_tree(units: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> Node:
    """A tree over these rows. The vantage point is the row farthest from the mean; rows that lie
    on the median go inside, and rows that can't be told apart stay a leaf."""
    if len(rows) <= leaf:
        return Node(rows)
    own = units[rows]
    vantage = own[np.argmin(own @ own.mean(axis=0))]
    distance = chord(own @ vantage)
    inside = distance <= np.median(distance)
    if inside.all():
        inside = distance < distance.max()
        if not inside.any():
            return Node(rows)
    halves = (inside, ~inside)
    return Node(rows[:0], vantage, tuple((float(distance[h].min()), float(distance[h].max())) for h in halves), tuple(vantage_tree(units, rows[h], leaf) for h in halves))


def away(distance: np.ndarray, bounds: tuple[float, float]) -> np.ndarray:
    """The least distance that a point within bounds of the vantage point can have."""
    return np.maximum(0.0, np.maximum(bounds[0] - distance, distance - bounds[1]))


@dataclass
class Search:
    """The k nearest of each query so far: distances ascending, cosines and ids beside them."""

    units: np.ndarray
    vectors: np.ndarray
    ids: np.ndarray
    queries: np.ndarray
    query_ids: np.ndarray
    worst: np.ndarray
    factor: float = FACTOR
    k: int = K
    compared: int = 0
    scores: np.ndarray = field(init=False)
    found: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = len(self.queries)
        self.scores, self.found = np.full((n, self.k), -np.inf), np.zeros((n, self.k), np.int64)
        norms = np.sqrt(np.einsum("nd,nd->n", self.queries, self.queries))
        self.norms, self.lengths = norms, np.sqrt(np.einsum("nd,nd->n", self.vectors, self.vectors))
        self.query_units = self.queries / norms[:, None]

    def over(self, tree: Node) -> None:
        """Each query first sees the leaf on its own sides, which bounds the rest; then each leaf
        is visited once, by all queries that it may still hold something for."""
        home = np.zeros(len(self.queries), np.int64)
        todo = [(tree, np.arange(len(self.queries)))]
        while todo:
            node, alive = todo.pop()
            if not node.sides:
                home[alive] = id(node)
                self._leaf(node.rows, alive)
                continue
            least = self._least(node, alive)
            nearer = least[0] <= least[1]
            todo += [(n, alive[m]) for n, m in zip(node.sides, (nearer, ~nearer), strict=True) if m.any()]
        todo = [(tree, np.arange(len(self.queries)))]
        while todo:
            node, alive = todo.pop()
            if not node.sides:
                self._leaf(node.rows, alive[home[alive] != id(node)])
                continue
            least = self._least(node, alive)
            for side, n in enumerate(node.sides):
                near = alive[least[side] * self.factor <= self.worst[alive] + SLACK]
                if len(near):
                    todo.append((n, near))

    def _least(self, node: Node, alive: np.ndarray) -> list[np.ndarray]:
        distance = chord(self.query_units[alive] @ node.vantage)
        return [away(distance, b) for b in node.bounds]

    def _leaf(self, rows: np.ndarray, alive: np.ndarray) -> None:
        """A matrix product finds the pairs that may be among the nearest. Their scores are then
        summed pair by pair in one order, so that equal vectors score alike wherever they lie."""
        if not len(alive):
            return
        self.compared += len(rows) * len(alive)
        about = (self.queries[alive] @ self.vectors[rows].T) / (self.norms[alive][:, None] * self.lengths[rows])
        own = self.query_ids[alive][:, None] == self.ids[rows]
        q, n = np.nonzero((about >= self.scores[alive, -1][:, None] - ROUNDING) & ~own)
        if not len(q):
            return
        q, n = alive[q], rows[n]
        score = np.einsum("pd,pd->p", self.queries[q], self.vectors[n]) / (self.norms[q] * self.lengths[n])
        changed = np.unique(q)
        q = np.concatenate([q, np.repeat(changed, self.k)])
        score = np.concatenate([score, self.scores[changed].ravel()])
        ids = np.concatenate([self.ids[n], self.found[changed].ravel()])
        order = np.lexsort((ids, -score, q))
        kept = (np.searchsorted(q[order], changed)[:, None] + np.arange(self.k)).ravel()  # k at least for each
        self.scores[changed] = score[order][kept].reshape(-1, self.k)
        self.found[changed] = ids[order][kept].reshape(-1, self.k)
        last = self.scores[changed, -1]
        full = np.isfinite(last)
        self.worst[changed[full]] = np.minimum(self.worst[changed[full]], chord(last[full]))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v (doubles) and two hashes of it, once for each id and vector that takes part."""
    v = F.transform(vector_col, lambda x: x.cast("double"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(whole)
    # Zeros of either sign are one vector.
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    return rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), F.size("v").alias("dim")).dropDuplicates(["id", "h1", "h2"])


@dataclass
class Leaves:
    """The first tree of the vectors of one number of components, its leaves' numbers and bounds."""

    tree: Node
    first: int
    shards: dict[int, int] = field(default_factory=dict)

    def deal(self, units: np.ndarray) -> np.ndarray:
        out = np.empty(len(units), np.int64)
        todo = [(self.tree, np.arange(len(units)))]
        while todo:
            node, at = todo.pop()
            if not node.sides:
                out[at] = self.first + int(node.rows[0])
            elif len(at):
                inside = chord(units[at] @ node.vantage) <= node.bounds[0][1]
                todo += [(node.sides[0], at[inside]), (node.sides[1], at[~inside])]
        return out

    def leaves(self) -> list[Node]:
        out, todo = [], [self.tree]
        while todo:
            node = todo.pop()
            todo += node.sides
            if not node.sides:
                out.append(node)
        return out


def first_tree(units: np.ndarray, n_rows: int, shard: int, first: int) -> tuple[Leaves, int]:
    """A tree with about a leaf for each ``shard`` rows, at most MAX_LEAVES, and the next free number."""
    wanted = min(MAX_LEAVES, max(1, -(-n_rows // shard)))
    out = Leaves(vantage_tree(units, np.arange(len(units)), -(-len(units) // wanted)), first)
    leaves = out.leaves()
    for number, node in enumerate(leaves):
        node.rows = np.array([number])
    return out, first + len(leaves)


def _units(batch: pa.RecordBatch, column: str = "v") -> np.ndarray:
    values = batch.column(column)
    flat = values.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return flat / np.sqrt(np.einsum("nd,nd->n", flat, flat))[:, None]


def _dealt(trees: dict[int, Leaves]):
    """Rows with the leaf that each would be dealt to; a batch may hold several sizes of vectors."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                leaf = trees[int(dim)].deal(_units(part))
                yield part.append_column("leaf", pa.array(leaf))

    return deal


#: A row is a vector of a shard (``query`` false) or a block of queries for it: vectors one after
#: another, with ids and the worst distance that each would still take.
UNIT = "shard long, part int, query boolean, dim int, ids binary, vectors binary, worst binary"
NEAR = "query_id long, vec_id long, score double, dim int, h1 long, h2 long"


def _searched(factor: float, k: int):
    """Rows sorted by shard, vectors before queries: a tree for each shard, then its blocks one by one."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, packed, tree = None, [], None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if (row["shard"], row["part"]) != shard:
                    shard, packed, tree = (row["shard"], row["part"]), [], None
                if not row["query"]:
                    packed.append((np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dim"])))
                    continue
                if not packed:
                    continue
                if tree is None:
                    ids, vectors = (np.concatenate([p[i] for p in packed]) for i in (0, 1))
                    units = vectors / np.sqrt(np.einsum("nd,nd->n", vectors, vectors))[:, None]
                    tree = vantage_tree(units, np.arange(len(units)))
                about = np.frombuffer(row["ids"], "<i8").reshape(3, -1)
                queries = np.frombuffer(row["vectors"], "<f8").reshape(-1, row["dim"])
                s = Search(units, vectors, ids, queries, about[0], np.frombuffer(row["worst"], "<f8").copy(), factor, k)
                limit = s.worst + SLACK
                s.over(tree)
                got = np.isfinite(s.scores) & (chord(np.where(np.isfinite(s.scores), s.scores, 0.0)) <= limit[:, None])
                q = np.nonzero(got)[0]
                columns = [about[0][q], s.found[got], s.scores[got], np.full(len(q), row["dim"], np.int32), about[1][q], about[2][q]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score", "dim", "h1", "h2"])

    return search


def _packed(ids: list[np.ndarray], vectors: np.ndarray) -> tuple[bytes, bytes]:
    return np.stack(ids).astype("<i8").tobytes(), vectors.astype("<f8").tobytes()


def _blocks(queries: bool, trees: dict[int, Leaves], factor: float):
    """Vectors, or queries, of one shard after another packed into blocks. Queries with a
    distance already go to all other leaves that may hold something nearer."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, dims = batch.column("leaf").to_numpy(), batch.column("dim").to_numpy()
            shard = batch.column("shard").to_numpy() if "shard" in batch.schema.names else leaf
            for key, dim in sorted(set(zip(shard.tolist(), dims.tolist(), strict=True))):
                part = batch.filter(pa.array((shard == key) & (dims == dim)))
                for low in range(0, part.num_rows, BLOCK):
                    yield from _rows_of(part.slice(low, BLOCK), key, int(dim), queries, trees[int(dim)], factor)

    return pack


def _rows_of(part: pa.RecordBatch, shard: int, dim: int, queries: bool, leaves: Leaves, factor: float) -> Iterator[pa.RecordBatch]:
    vectors = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dim)
    ids = [part.column(c).to_numpy() for c in (("id", "h1", "h2") if queries else ("id",))]
    worst = part.column("worst").to_numpy() if "worst" in part.schema.names else np.full(part.num_rows, FAR)
    targets = [(shard, np.arange(part.num_rows))]
    if "worst" in part.schema.names:
        targets = _open_leaves(leaves, vectors, worst, int(part.column("leaf")[0].as_py()), factor)
    for target, at in targets:
        a, b = _packed([x[at] for x in ids], vectors[at])
        yield pa.RecordBatch.from_arrays([pa.array([target], pa.int64()), pa.array([0], pa.int32()), pa.array([queries]), pa.array([dim], pa.int32()), pa.array([a]), pa.array([b]), pa.array([worst[at].astype("<f8").tobytes()])], ["shard", "part", "query", "dim", "ids", "vectors", "worst"])


def _open_leaves(leaves: Leaves, vectors: np.ndarray, worst: np.ndarray, home: int, factor: float) -> list[tuple[int, np.ndarray]]:
    """(leaf, queries) of all leaves but home that may hold something nearer than ``worst``."""
    units = vectors / np.sqrt(np.einsum("nd,nd->n", vectors, vectors))[:, None]
    out, todo = [], [(leaves.tree, np.arange(len(units)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if not node.sides:
            if (number := leaves.first + int(node.rows[0])) != home:
                out.append((number, at))
            continue
        distance = chord(units[at] @ node.vantage)
        # The sample's own bounds don't hold for all rows: inside reaches from 0 to the cut, outside from it on.
        cut = node.bounds[0][1]
        for side, bounds in zip(node.sides, ((0.0, cut), (cut, FAR)), strict=True):
            todo.append((side, at[away(distance, bounds) * factor <= worst[at] + SLACK]))
    return sorted(out, key=lambda x: x[0])


def nearest_neighbours(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, factor: float = FACTOR, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every row that ``is_query`` (a condition on ``id``) names."""
    spark = vectors.sparkSession
    rows = materialize(usable(vectors, id_col, vector_col), "vectors")
    among = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    points = materialize(rows.withColumn("n", among).where(F.col("n") <= k + 1), "points")
    sizes = {r["dim"]: r["n"] for r in points.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row for each number of components
    trees, free = {}, 0
    for dim, n in sorted(sizes.items()):
        # The smallest hashes are a sample that follows neither ids nor files.
        sample = points.where((F.col("dim") == dim) & (F.col("n") == 1)).orderBy("h1", "h2").limit(min(SAMPLE, max(1, 4_000_000 // dim))).select("v").toArrow()
        units = np.concatenate([_units(b) for b in sample.to_batches() if b.num_rows])
        trees[dim], free = first_tree(units, n, shard, free)
    if not trees:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    schema = "id long, v array<double>, h1 long, h2 long, dim int, leaf long"
    points = materialize(points.drop("n").mapInArrow(_dealt(trees), schema), "dealt")
    asked = materialize(rows.where(is_query).mapInArrow(_dealt(trees), schema), "queries")
    # One number for each leaf; a leaf of too many vectors has several shards, each a tree of its own.
    spread = {r["leaf"]: -(-r["n"] // (2 * shard)) for r in points.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    per = F.create_map(*[F.lit(x) for leaf in range(free) for x in (leaf, spread.get(leaf, 1))]) if max(spread.values()) > 1 else None
    split = (lambda leaf: F.element_at(per, leaf.cast("int"))) if per is not None else (lambda leaf: F.lit(1))
    width = max(spread.values())
    number = lambda leaf, at: leaf * width + at
    points = points.withColumn("shard", number(F.col("leaf"), F.pmod(F.xxhash64("h2"), split(F.col("leaf"))).cast("long")))
    packed = materialize(points.repartition("shard").sortWithinPartitions("shard").mapInArrow(_blocks(False, trees, factor), UNIT), "shards")
    # A leaf's queries are packed by several tasks when they are many.
    salts = max(1, -(-asked.count() // (BLOCK * BLOCKS_A_TASK)))
    salt = F.pmod(F.xxhash64("id"), F.lit(salts))

    def packed_queries(queries: DataFrame) -> DataFrame:
        return queries.repartition("leaf", salt).sortWithinPartitions("leaf").mapInArrow(_blocks(True, trees, factor), UNIT)

    def search(blocks: DataFrame) -> DataFrame:
        """Blocks hold leaves in ``shard``: each goes to all shards of its leaf."""
        blocks = materialize(blocks.withColumn("shard", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), split(F.col("shard")).cast("long") - 1), lambda i: number(F.col("shard"), i)))), "asked")
        most = blocks.groupBy("shard").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        parts = max(1, -(-most // BLOCKS_A_TASK))
        dealt_blocks = blocks.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int"))
        wanted = dealt_blocks.select("shard", "part").distinct()
        sent = packed.drop("part").join(wanted, "shard").select(dealt_blocks.columns)
        both = sent.unionByName(dealt_blocks).repartition("shard", "part").sortWithinPartitions("shard", "part", "query")
        return materialize(both.mapInArrow(_searched(factor, k), NEAR), "near")

    keys = ["query_id", "dim", "h1", "h2"]
    home = search(packed_queries(asked))
    last = home.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id"))).where(F.col("__n") == k)
    worst = last.select("query_id", "h1", "h2", F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))).alias("worst"))
    bounded = asked.join(worst.withColumnRenamed("query_id", "id"), ["id", "h1", "h2"], "left").withColumn("worst", F.coalesce("worst", F.lit(FAR)))
    others = search(packed_queries(bounded))
    # A query id with several vectors keeps the best score of each neighbour.
    found = home.unionByName(others).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % QUERY_STEP == 0)
