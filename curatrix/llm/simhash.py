"""SimHash near-duplicates, found in BK-trees.

A text's fingerprint has a bit where over half of its word-shingle hashes have it. Equal
fingerprints are collapsed first. Fingerprints within the radius agree on some of their
blocks (pigeonhole), so each is sent to one shard for every choice of agreeing blocks.
A shard's BK-tree keys children by their integer Hamming distance to the parent; a query
follows only edges within the radius of its own distance. Shards of more than
``max_tree`` fingerprints are parted once more, by interleaved blocks of which a pair within
the radius agrees on one; what is still larger becomes several trees that all of the shard's
fingerprints query, so no tree outgrows a task and no pair is lost. Within a shard, links are reduced to one
edge to the least linked fingerprint, so a group of n copies leaves n edges and not n^2.

Shard trees travel by shuffle beside their queries and not by broadcast: a tree is of
bounded size, all trees together are not.

Defined results: null and empty texts have fingerprint zero and link like any other;
repeated rows appear once each; texts of any length are read whole; bits that exactly half
of the hashes have (ties) are 0; rows without an id link like others but never name a
component unless all of it lacks ids; an empty table gives no rows; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import canonical, documents, materialize
from curatrix.llm.components import components

RADIUS, SHINGLE, SEED = 4, 4, 42
#: Fingerprints in one BK-tree at most.
MAX_TREE = 4096
#: A shard should hold about this many fingerprints.
SHARD_FILL = 1024


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``size`` words, repeats included; fewer words are one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    starts = [0, *ends[: len(words) - size]]
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[size - 1 :], strict=True)], np.uint64)


def fingerprint(text: str, size: int = SHINGLE) -> int:
    hashes = shingle_hashes(text, size)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 65536):
        chunk = hashes[part : part + 65536]
        counts += np.unpackbits(chunk.view(np.uint8).reshape(len(chunk), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, fp: the fingerprint's bits as a signed long."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size) for t in texts], dtype="int64")

    return canonical(docs).select("doc_id", fp("text").alias("fp"))


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints, each one number or a row of several."""
    d = np.bitwise_count(a ^ b)
    return d.astype(np.int64) if d.ndim == 1 else sum(d.T[1:], d.T[0].astype(np.int64))


class BKForest:
    """BK-trees over many shards at once, in arrays; ``shard`` is sorted. Fingerprints are
    numbers of 64 bits or rows of several."""

    def __init__(self, fps: np.ndarray, shard: np.ndarray) -> None:
        n = len(fps)
        self.fps, self.bits = fps, 64 * (fps.shape[1] if fps.ndim > 1 else 1)
        first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if n else np.empty(0, int)
        self.root = np.repeat(first, np.diff(np.r_[first, n])) if n else np.empty(0, int)
        parent, edge = np.full(n, -1), np.zeros(n, int)
        active = np.setdiff1d(np.arange(n), first, assume_unique=True)
        node = self.root[active]
        while len(active):
            # All walk one level; of those that meet at a free edge the first takes it.
            d = apart(fps[active], fps[node])
            key = node * (self.bits + 1) + d
            _, where, inverse = np.unique(key, return_index=True, return_inverse=True)
            child = active[where]
            parent[child], edge[child] = node[where], d[where]
            stay = np.ones(len(active), bool)
            stay[where] = False
            active, node = active[stay], child[inverse][stay]
        linked = np.flatnonzero(parent >= 0)
        keys = parent[linked] * (self.bits + 1) + edge[linked]
        order = np.argsort(keys, kind="stable")
        self.keys, self.children, self.parent = keys[order], linked[order], parent
        self.inner = np.zeros(n, bool)
        self.inner[parent[linked]] = True

    def query(self, points: np.ndarray, roots: np.ndarray, radius: int | np.ndarray, live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(index of the point, index of the node) of all pairs within the radius, one for all
        or one a point. Subtrees whose root is not ``live`` are left out."""
        q, node, hits = np.arange(len(points)), roots, []
        each = np.broadcast_to(radius, len(points))
        while len(q):
            d, within = apart(points.take(q, 0), self.fps.take(node, 0)), each[q]
            near = np.flatnonzero(d <= within)
            hits.append((q[near], node[near]))
            on = np.flatnonzero(self.inner[node])
            q, node, d, within = q[on], node[on], d[on], within[on]
            lo = np.searchsorted(self.keys, node * (self.bits + 1) + np.maximum(d - within, 0), "left")
            hi = np.searchsorted(self.keys, node * (self.bits + 1) + np.minimum(d + within, self.bits), "right")
            n = hi - lo
            q = np.repeat(q, n)
            node = self.children[np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())] if n.sum() else q
            if live is not None and len(q):
                on = np.flatnonzero(live[node])
                q, node = q[on], node[on]
        if not hits:
            return q, q
        return np.concatenate([a for a, _ in hits]), np.concatenate([b for _, b in hits])


def shard_links(fps: np.ndarray, shard: np.ndarray, built: np.ndarray, radius: int, step: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Links of each fingerprint to the least fingerprint of its shard that it reaches over
    nodes of the tree (``built``). fps are in the order of ``shard``."""
    order = np.lexsort((fps, ~built, shard))
    fps, shard, built = fps[order], shard[order], built[order]
    nodes = np.flatnonzero(built)
    if not len(nodes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bits = fps.view(np.uint64)  # counting the bits of a signed number would count its absolute value's
    tree = BKForest(bits[nodes], shard[nodes])
    at = np.searchsorted(shard[nodes], shard)
    known = (at < len(nodes)) & (shard[nodes][np.minimum(at, len(nodes) - 1)] == shard)
    asking = np.flatnonzero(known)
    pairs = []
    for k in range(0, len(asking), step):
        part = asking[k : k + step]
        q, node = tree.query(bits[part], at[part], radius)
        q, node = part[q], nodes[node]
        other = q != node
        q, node = q[other], node[other]
        if len(q):
            # A point's links to one node of each group already joined are enough.
            pairs.append((q, node))
            if sum(len(a) for a, _ in pairs) > 2_000_000:
                pairs = [_reduced(pairs, len(fps))]
    if not pairs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = _reduced(pairs, len(fps))
    return fps[a], fps[b]


def _reduced(pairs: list[tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the pairs, by repeated least-label steps."""
    a, b = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
    label = np.arange(n)
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            break
        label = least
    out = np.flatnonzero(label != np.arange(n))
    return out, label[out]


def block_choices(n: int, radius: int = RADIUS) -> tuple[int, int]:
    """(blocks, agreeing blocks) so that n fingerprints fill shards to about SHARD_FILL."""
    for blocks in range(radius + 1, 2 * radius + 2):
        agree = blocks - radius
        if n >> (64 * agree // blocks) <= SHARD_FILL:
            break
    return blocks, agree


def near_links(fps: DataFrame, radius: int = RADIUS, max_tree: int = MAX_TREE) -> DataFrame:
    """Distinct fingerprints (column fp) -> links (a, b) whose components are those of all
    pairs within the radius."""
    blocks, agree = block_choices(fps.count(), radius)
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    tables = [sum(masks[i] for i in chosen) for chosen in itertools.combinations(range(blocks), agree)]
    signed = [m - (1 << 64) if m >> 63 else m for m in tables]
    shards = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])
    placed = fps.select("fp", F.explode(shards).alias("shard"))
    def sized(shards: DataFrame) -> DataFrame:
        """With the number of fingerprints; shards of one fingerprint can't hold a link."""
        return shards.join(shards.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1"), "shard").select("shard", "fp", "n")

    first = sized(placed)
    over = first.where(F.col("n") > max_tree)
    spread = [sum(1 << bit for bit in range(j, 64, radius + 1)) for j in range(radius + 1)]
    parts = F.array(*[F.xxhash64("shard", F.lit(j), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))) for j, m in enumerate(spread)])
    asked = first.where(F.col("n") <= max_tree).unionByName(sized(over.select("fp", F.explode(parts).alias("shard"))))
    asked = asked.withColumn("trees", F.ceil(F.col("n") / F.lit(max_tree)).cast("int"))
    routed = asked.select("fp", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("tree"), "trees", "shard").select("fp", F.xxhash64("shard", "tree").alias("tree_id"), (F.pmod(F.xxhash64("fp"), F.col("trees")) == F.col("tree")).alias("built"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []

        def done(parts):
            fp, tree, built = (np.concatenate([p[i] for p in parts]) for i in range(3))
            a, b = shard_links(fp, tree, built.astype(bool), radius)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            fp, tree, built = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(3))
            cut = np.searchsorted(tree, tree[-1]) if len(tree) else 0  # the last tree may go on
            if cut:
                yield done([*kept, (fp[:cut], tree[:cut], built[:cut])])
                kept = []
            kept.append((fp[cut:], tree[cut:], built[cut:]))
        if kept and sum(len(p[0]) for p in kept):
            yield done(kept)

    return routed.repartition("tree_id").sortWithinPartitions("tree_id").mapInArrow(link, "a long, b long").distinct()


def simhash_components(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (the smallest doc_id reachable)."""
    prints = materialize(fingerprints(docs, size), "fingerprints")
    by_fp = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    reached = components(near_links(by_fp.select("fp"), radius))
    grouped = by_fp.join(reached.select(F.col("node").alias("fp"), "component"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    roots = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    # Components of one fingerprint need no second look.
    classes = materialize(grouped.join(roots, "component").select("fp", "component_id"), "classes")
    return prints.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))
