"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Each set has a SimHash fingerprint, of two times 64 bits here. Fingerprints are routed to shards,
a shard's are in a BK-tree (``simhash.BKForest``), and what is found within the radius is checked exactly.
At 0.8 about 19 of the bits differ, and more than ``RADIUS`` once in ten million pairs. Within so wide a
radius the blocks of a fingerprint that agree part nothing, so not these name the shards, but shingles
that the sets share, in one order of all shingles: frequent ones last, then by hash.

- Sets of up to ``SMALL`` shingles meet by one of the first n - ceil(0.8 n) + 1 of each
  (prefix filter; nothing is lost).
- Larger sets meet by the first shingle of each of ``BANDS`` parts of the hash space; a pair
  at 0.8 differs in all of them once in 10^11.

Each set asks its shard's tree for those within the radius that are not joined yet (``tree_groups``); sets of
up to ``FEW`` shingles ask for all, as bits are coarse there. Those whose sizes allow 0.8 are linked. Groups so linked are gathered, and within
a group the exact similarity is taken of all pairs that are not joined already.

Where more than ``CROWD`` sets meet in one place, the frequent shingles are found and all sets
described again. Equal sets are collapsed first. Shards and groups join each member to one other, so n copies
leave n links and not n^2. A group of different near copies is gathered in one task.

Defined results: words and case are those of ``shingle_hashes``; texts of fewer words than a
shingle are one shingle; null and empty texts are copies of each other; texts of any length
are compared whole; shingles of equal frequency go by hash; of a group
the row of the smallest id stays, of equal ids that of the smaller hash; repeated rows are rows of
their own, of which one stays; rows are told apart by numbers, so null ids and columns of any name
do no harm; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import by_texts, mark, materialize, may_hold, numbered, partitions_for, release, without_rows
from curatrix.llm.components import components
from curatrix.llm.simhash import BKForest, apart

#: Similarity as a fraction, and words of a shingle.
NEAR, WORDS = (4, 5), 5
BANDS, SMALL, RADIUS = 16, 80, 40
#: Sets of so few shingles are found at any distance, as bits are coarse there.
FEW = 32
#: Shingles that a task meets in LOCAL of CHUNK texts count as frequent; the FREQUENT most
#: frequent go last. Which ones do decides the order of meeting, never the result.
CHUNK, LOCAL, FREQUENT = 2048, 8, 1 << 17
#: Bytes whose words are hashed together.
BLOCK = 1 << 18
#: Sets that meet in one place from which on frequent shingles are looked for.
CROWD = 8192
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_BASE = 0xD1342543DE82EF95
# Bounds of classes of sizes; sizes that allow 0.8 are of one class or of neighbours.
_CLASSES = np.multiply.accumulate(np.full(96, NEAR[1] / NEAR[0]))
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
# A 64-bit value for each byte; capital letters have those of small ones.
_LETTERS = np.random.default_rng(64).integers(1, 1 << 63, 256, np.uint64)
_LETTERS[65:91] = _LETTERS[97:123]


class Shingler:
    """Hashes of five-word shingles. A word's hash is a polynomial of its bytes modulo 2^64,
    taken for all words of a batch at once from running sums."""

    def __init__(self) -> None:
        self.powers = np.empty((2, 0), np.uint64)

    def _powers(self, n: int) -> np.ndarray:
        if self.powers.shape[1] < n:
            size = max(n, BLOCK)
            self.powers = np.stack([np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, np.uint64(base))]) for base in (_BASE, _INVERSE)])
        return self.powers

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words, and how many each text has."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
        if not len(data):
            return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
        inside = np.r_[False, ~_SPACE[data], False]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        h, word = np.empty(len(start), np.uint64), 0
        while word < len(start):  # blocks of words keep the sums short
            base = start[word]
            last = max(word + 1, int(np.searchsorted(end, base + BLOCK, "right")))
            block = data[base : end[last - 1]]
            up, down = self._powers(len(block))
            sums = np.r_[np.uint64(0), np.cumsum(_LETTERS[block] * up[: len(block)])]
            at = start[word:last] - base
            h[word:last] = (sums[end[word:last] - base] - sums[at]) * down[at]
            word = last
        h = (h ^ (end - start).astype(np.uint64)) * _MIX[1]
        h ^= h >> np.uint64(29)
        bounds = np.cumsum([len(x) + 1 for x in raw])
        return h, np.diff(np.searchsorted(start, np.r_[0, bounds]))

    def sets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, bounds): the sorted distinct shingle hashes of text i lie between
        bounds[i] and bounds[i + 1]."""
        codes, sizes = self.codes(texts)
        runs = np.where(sizes > 0, np.maximum(sizes - WORDS + 1, 1), 0)
        owner = np.repeat(np.arange(len(texts)), runs)
        first = np.r_[0, np.cumsum(sizes)[:-1]] if len(sizes) else sizes
        at = np.repeat(first, runs) + np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
        length = np.minimum(sizes, WORDS)[owner]
        h = length.astype(np.uint64)
        for j in range(WORDS):
            inside = j < length
            if inside.all():
                h = (h ^ codes[at + j]) * _MIX[0]
                h ^= h >> np.uint64(29)
            else:
                x = (h[inside] ^ codes[at[inside] + j]) * _MIX[0]
                h[inside] = x ^ (x >> np.uint64(29))
        h *= _MIX[1]
        h ^= h >> np.uint64(32)
        ends = np.cumsum(runs).tolist()
        for a, b in zip([0, *ends], ends):
            h[a:b].sort()
        new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])] if len(h) else np.empty(0, bool)
        return h[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))

    def __call__(self, text: str) -> np.ndarray:
        return self.sets([text])[0]


def set_key(hashes: np.ndarray) -> int:
    h = xxhash.xxh64_intdigest(hashes.tobytes())
    return h - (1 << 64) if h >> 63 else h


def prefix_size(n: int) -> int:
    return n - -(-n * NEAR[0] // NEAR[1]) + 1 if n else 0


def fingerprints_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """SimHash of each set: the bits that over half of its hashes have."""
    n, out = np.diff(bounds), np.zeros(len(bounds) - 1, np.uint64)
    filled, mask = np.flatnonzero(n), np.uint64(0x0001000100010001)
    if len(filled):
        # Lanes of 16 bits count four bits at once; parts of a set keep below 65536.
        cuts = np.concatenate([np.arange(a, b, 65535) for a, b in zip(bounds[:-1][filled].tolist(), bounds[1:][filled].tolist())])
        of = np.searchsorted(cuts, bounds[:-1][filled])
        for lane in range(16):
            sums = np.add.reduceat((hashes >> np.uint64(lane)) & mask, cuts)
            for k in range(4):
                counts = np.add.reduceat((sums >> np.uint64(16 * k)) & np.uint64(0xFFFF), of)
                out[filled] |= (2 * counts > n[filled].astype(np.uint64)).astype(np.uint64) << np.uint64(16 * k + lane)
    return out.view(np.int64)


def places_of(hashes: np.ndarray, bounds: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, owner) where sets meet others: prefix shingles of small sets, first shingles of
    the bands of others; sizes between meet both ways. frequent: sorted hashes that go last."""
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    if len(frequent) and len(hashes):
        late = frequent[np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)] == hashes
        hashes = hashes[np.lexsort((late, owner))]
    rank = np.arange(len(hashes)) - bounds[:-1][owner]
    small = n[owner] <= SMALL
    head = small & (rank < np.array([prefix_size(x) for x in n.tolist()], np.int64)[owner])
    large = np.flatnonzero(NEAR[1] * n[owner] > NEAR[0] * SMALL)
    # Bands are cut by bits that the order does not depend on.
    band = ((hashes[large] * _MIX[2]) >> np.uint64(60)).astype(np.int64)
    _, first = np.unique(owner[large] * BANDS + band, return_index=True)
    large = large[first]
    return np.concatenate([hashes[head], hashes[large] ^ _MIX[1]]), np.concatenate([owner[head], owner[large]])


def tree_groups(shard: np.ndarray, n: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """The group of each set, by a member, among those of its shard: all that BK-trees of the shards' fingerprints
    link. ``shard`` is sorted; n: shingles of the sets; fps: rows of two fingerprints. All shards
    ask at once, one member each a round; subtrees of members joined are not entered again. A shard has one
    tree for each class of sizes, and a set asks those whose sizes allow 0.8."""
    sized = np.searchsorted(_CLASSES, n, "right")
    order = np.lexsort((sized, shard))  # keeps shards in their places
    back = np.argsort(order)
    n, fps, tree = n[order], fps[order], _ids(shard) * (len(_CLASSES) + 2) + sized[order]
    forest, label, waiting = BKForest(fps, tree), np.arange(len(n)), np.ones(len(n), bool)
    radius = np.where(NEAR[0] * n <= NEAR[1] * FEW, forest.bits, RADIUS)
    below = np.zeros(len(n), np.int64)  # members of a subtree that wait

    def counted(nodes: np.ndarray, step: int) -> None:
        while len(nodes):
            np.add.at(below, nodes, step)
            nodes = forest.parent[nodes]
            nodes = nodes[nodes >= 0]

    def taken(nodes: np.ndarray, of: np.ndarray) -> None:
        waiting[nodes] = False
        counted(nodes, -1)
        np.subtract.at(left, of, 1)

    counted(label, 1)
    roots = np.flatnonzero(forest.parent < 0)
    trees, first = tree[roots], _runs(shard)[:-1] if len(shard) else label
    left = np.diff(np.r_[first, len(n)])  # members of a shard that wait
    queue, head, tail, seek = np.empty(len(n), np.int64), first.copy(), first.copy(), first.copy()
    live = np.flatnonzero(left > 1)
    while len(live):
        idle = live[head[live] == tail[live]]  # a group is complete: the next one's first member
        at = idle
        while len(at := at[~waiting[seek[at]]]):
            seek[at] += 1
        queue[tail[idle]] = seek[idle]
        tail[idle] += 1
        taken(seek[idle], idle)
        asking = queue[head[live]]
        head[live] += 1
        near = (tree[asking] + np.array([[-1], [0], [1]])).ravel()
        at = np.minimum(np.searchsorted(trees, near), len(trees) - 1)
        known = np.flatnonzero((trees[at] == near) & (below[roots[at]] > 0))
        who = known % len(asking)
        q, node = forest.query(fps[asking[who]], roots[at[known]], radius[asking[who]], below > 0)
        q = who[q]
        a = asking[q]
        fit = waiting[node] & (NEAR[0] * np.maximum(n[a], n[node]) <= NEAR[1] * np.minimum(n[a], n[node]))
        fit &= (np.minimum(n[a], n[node]) <= FEW) | (apart(fps[a], fps[node]) <= RADIUS)
        hit = np.flatnonzero(fit)[np.argsort(q[fit], kind="stable")]
        q, node = q[hit], node[hit]
        label[node] = label[asking[q]]
        taken(node, live[q])
        queue[tail[live[q]] + np.arange(len(q)) - np.searchsorted(q, q)] = node
        tail[live] += np.bincount(q, minlength=len(live))
        live = live[left[live] > 0]
    return order[label][back]


def _ids(values: np.ndarray) -> np.ndarray:
    """Numbers of the runs of equal values."""
    return np.repeat(np.arange(len(b := np.diff(_runs(values)))), b) if len(values) else np.empty(0, np.int64)


def reached(count: int, alike) -> np.ndarray:
    """Component of each of count members; ``alike(i, open)`` tells which of ``open`` i joins.
    Members joined are compared with those still open only."""
    label, waiting = np.arange(count), np.arange(count)
    while len(waiting):
        root, queue = waiting[0], [waiting[0]]
        waiting = waiting[1:]
        while queue and len(waiting):
            near = alike(queue.pop(), waiting)
            label[waiting[near]] = root
            queue += waiting[near].tolist()
            waiting = waiting[~near]
    return label


def exact_groups(sets: list[np.ndarray]) -> np.ndarray:
    """Components of the sets by exact similarity."""
    sizes = np.array([len(s) for s in sets])
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]

    def alike(i: int, open_: np.ndarray) -> np.ndarray:
        if len(open_) * 8 < len(sets):  # few are left: one by one
            common = np.array([len(np.intersect1d(sets[i], sets[k], assume_unique=True)) for k in open_])
        else:
            lo, hi = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
            n = hi - lo
            common = np.bincount(owner[np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())], minlength=len(sets))[open_]
        return NEAR[1] * common >= NEAR[0] * (sizes[open_] + sizes[i] - common)

    return reached(len(sets), alike)


def _by_runs(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.Table]:
    """The batches, cut so that rows of equal keys stay together."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(values, values[-1]))
        if kept and (cut or kept[-1].column(key)[-1].as_py() != values[0]):
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        kept.append(batch.slice(cut))
    if kept:
        yield pa.Table.from_batches(kept)


def _runs(values: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values."""
    return np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1, len(values)]


def locally_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, n) of those that LOCAL of CHUNK texts, all different, hold."""
    shingles, held, seen = Shingler(), [], set()

    def flush():
        values, n = np.unique(np.concatenate(held), return_counts=True)
        often = n >= LOCAL
        return pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(n[often])], names=["shingle", "n"])

    for batch in by_texts(batches):
        hashes, bounds = shingles.sets(batch.column(0).to_pylist())
        for s in np.split(hashes, bounds[1:-1]):
            if (key := set_key(s)) not in seen:
                seen.add(key)
                held.append(s)
        if len(held) >= CHUNK:
            yield flush()
            held, seen = [], set()
    if held:
        yield flush()


def frequent_shingles(rows: DataFrame) -> np.ndarray:
    """Sorted; FREQUENT at most."""
    counted = rows.select("text").mapInArrow(locally_frequent, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle").toArrow()
    return np.sort(top.column(0).to_numpy().astype(np.int64).view(np.uint64))


def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (place, key), sorted: those of places with several keys, once each."""
    for table in _by_runs(batches):
        place, key = (table.column(i).to_numpy() for i in (0, 1))
        new = np.r_[True, (place[1:] != place[:-1]) | (key[1:] != key[:-1])]
        place, key = place[new], key[new]
        many = np.repeat(np.diff(b := _runs(place)) > 1, np.diff(b))
        yield pa.RecordBatch.from_arrays([pa.array(place[many]), pa.array(key[many])], names=["place", "key"])


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (place, key, n, fp, fp2), by place -> links between keys of a place, found in its BK-tree."""
    for table in _by_runs(batches):
        place, key, n = (table.column(i).to_numpy() for i in range(3))
        fps = np.stack([table.column(i).to_numpy() for i in (3, 4)], 1).view(np.uint64)
        label = tree_groups(place, n.astype(np.int64), fps)
        joined = np.flatnonzero(label != np.arange(len(label)))
        pairs = np.unique(np.stack([key[joined], key[label[joined]]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (component, key, text), by component -> (key, least key of its exact group)."""
    shingles = Shingler()
    for table in _by_runs(batches):
        component, key, texts = table.column(0).to_numpy(), table.column(1).to_numpy(), table.column(2)
        out: tuple[list, list] = ([], [])
        bounds = _runs(component)
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            label = exact_groups([shingles(t.as_py()) for t in texts.slice(lo, hi - lo)])
            least = np.full(hi - lo, np.iinfo(np.int64).max)
            np.minimum.at(least, label, key[lo:hi])
            out[0].append(key[lo:hi])
            out[1].append(least[label])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["key", "group"])


SETS = "row long, key long, n int, fp long, fp2 long, places array<long>"


def near_copy_groups(rows: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """rows (row, text), read several times -> (row, key, group): key is equal for equal shingle sets, group for
    all that are near copies of each other, directly or by way of others. ``only`` (row, materialised): those rows
    alone; what describes them meets it, not their texts, which are longer."""
    rows = rows.select("row", F.coalesce("text", F.lit("")).alias("text"))
    asked = rows if only is None else may_hold(rows, only).where("__may").select("row", "text")
    parts = partitions_for(rows)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, frequent = Shingler(), share.value if share else np.empty(0, np.uint64)
        for batch in by_texts(batches):
            hashes, bounds = shingles.sets(batch.column(1).to_pylist())
            n = np.diff(bounds)
            keys = [set_key(s) for s in np.split(hashes, bounds[1:-1])]
            again = hashes * _MIX[2]
            again ^= again >> np.uint64(31)
            places, owner = places_of(hashes, bounds, frequent)
            order = np.argsort(owner, kind="stable")
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[order], np.arange(len(n) + 1)).astype(np.int32)), pa.array(places[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(n.astype(np.int32)), pa.array(fingerprints_of(hashes, bounds)), pa.array(fingerprints_of(again, bounds)), lists], names=["row", "key", "n", "fp", "fp2", "places"])

    def described_sets() -> DataFrame:
        sets = asked.mapInArrow(describe, SETS)
        return materialize(sets if only is None else sets.join(only.hint("merge"), "row", "left_semi"), "shingle-sets")

    share = None
    sets = described_sets()
    met = sets.dropDuplicates(["key"]).select(F.explode("places").alias("place")).groupBy("place").agg(F.count("*").alias("n"))
    if not met.where(F.col("n") > CROWD).isEmpty():
        # Any order of shingles gives the same groups; this one parts the crowds.
        share = rows.sparkSession.sparkContext.broadcast(frequent_shingles(asked))
        sets = described_sets()
    heads = sets.select(F.explode("places").alias("place"), "key")
    often = materialize(heads.repartition(parts, "place").sortWithinPartitions("place", "key").mapInArrow(shared, "place long, key long"), "shared-shingles")
    one = sets.groupBy("key").agg(F.min("row").alias("row"))
    meeting = often.select("key").distinct().join(one, "key")
    described = sets.join(meeting.select("row").hint("merge"), "row", "left_semi").select("key", "n", "fp", "fp2")
    known = often.join(described.hint("merge"), "key").select("place", "key", "n", "fp", "fp2")
    # Joins of what grows with the input are sorted at every size, not broadcast at small ones.
    links = known.repartition(parts, "place").sortWithinPartitions("place").mapInArrow(meet, "a long, b long")
    linked = components(links)
    members = linked.select(F.col("node").alias("key"), "component").unionByName(linked.select(F.col("component").alias("key"), "component").distinct())
    wanted = materialize(members.join(one, "key"), "near-members")
    texts = may_hold(rows, wanted).where("__may").join(wanted.hint("merge"), "row").select("component", "key", "text")
    groups = materialize(texts.repartition(parts, "component").sortWithinPartitions("component").mapInArrow(settle, "key long, group long"), "near-groups")
    return sets.select("row", "key").join(groups.hint("merge"), "key", "left").select("row", "key", F.coalesce("group", "key").alias("group"))


def keep_representatives(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies stays, all its columns kept: that of the smallest
    doc_id, then of the smallest hashes of its text and of the whole row. Rows are told apart
    by themselves and not by their ids: unlike texts that share an id both stay, and of
    repeated rows one. Rows without an id come last in their group."""
    rows = numbered(docs.withColumn("__null", F.col("doc_id").isNull()), "__row")
    whole = F.xxhash64(*[F.col(c).cast("string") if t not in ("binary",) else F.col(c) for c, t in docs.dtypes if not t.startswith(("map", "struct", "array", "variant"))])
    ranked = rows.select(F.col("__row").alias("row"), F.struct("__null", "doc_id", F.xxhash64("text").alias("t"), whole.alias("w"), F.col("__row").alias("row")).alias("place"))
    begun = mark()
    groups = materialize(near_copy_groups(rows.select(F.col("__row").alias("row"), "text")).join(ranked, "row"), "near-ranked")
    best = groups.groupBy("group").agg(F.min("place").alias("best"), F.count("*").alias("n")).where("n > 1").select("group", F.col("best.row").alias("best"))
    gone = materialize(groups.join(best, "group").where("row <> best").select(F.col("row").alias("__row")), "near-gone")
    release(docs.sparkSession, begun)
    return without_rows(rows, gone, "__row").select(docs.columns)
