"""Importance resampling to a target distribution over hashed n-grams, by inverted postings.

A document's features are its words and pairs of neighbours; crc32 deals them to buckets.
Tasks read documents in blocks of bounded size and write each block's postings (bucket,
document, count) inverted: by ranges of buckets, and in a range by bucket. The postings are
shuffled by range of buckets and salt, and meet there what both corpora hold in these buckets;
so each bucket's gain is computed where its postings are. What leaves is one contribution a
document and range, and these are added up by document. A salt holds a bounded number of
blocks, so that a bucket which every document holds is spread over as many tasks as all others.

Weights are the floored means of gains; scores add a Gumbel number drawn from the id, so that
the highest scores are a sample without replacement. Places in the order of scores come from
ranges, each numbered for itself (``ordered.ranked``).

Defined results: text is lower-cased on A-Z; words are runs of ASCII letters and digits and of
anything beyond ASCII; null and empty texts have no features and weight 0; a null id draws as
an empty one; texts of any length are read whole, one to a block at least; repeated rows are
rows of their own in counts and in the draw; ties of score go to the smaller id (null first),
equal ids in any order; an empty target gives gains against none; an empty table gives no rows;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import canonical, documents, materialize, table
from curatrix.operators.ordered import ranked

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Buckets in a range; text bytes and documents of a block; blocks of a salt.
RANGE, BLOCK_BYTES, BLOCK_DOCS, BLOCKS_A_SALT = 500, 1 << 20, 1 << 16, 64
#: Bytes of postings that a task reads at once.
ROW_GROUP = 8 << 20
#: Words up to this many bytes are hashed together, longer ones one by one.
LONG_WORD = 64
_ALL = np.uint32(0xFFFFFFFF)


@functools.cache
def _crc_table() -> np.ndarray:
    """What each byte does to a crc32 (the reflected polynomial of zlib)."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


@functools.cache
def _behind() -> np.ndarray:
    """[n, i, b]: what byte b at place i of a crc32 comes to when n more bytes follow."""
    table = _crc_table()
    out = np.empty((LONG_WORD + 1, 4, 256), np.uint32)
    out[0] = [np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)]
    for n in range(LONG_WORD):
        out[n + 1] = table[out[n] & 0xFF] ^ (out[n] >> 8)
    return out


def _followed(crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The part of each crc32 in that of a text with ``sizes`` more bytes."""
    moved = _behind()
    out = moved[sizes, 0, crc & 0xFF]
    for i in range(1, 4):
        out = out ^ moved[sizes, i, (crc >> np.uint32(8 * i)) & 0xFF]
    return out


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """By byte: lower-cased on A-Z; whether it belongs to a word."""
    low = np.frombuffer(bytes(range(256)).lower(), np.uint8)
    word = np.array([b >= 0x80 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" for b in low.tolist()])
    return low, word


def _word_crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The crc32 of each word; short words byte by byte together, from the longest down."""
    table, out = _crc_table(), np.empty(len(starts), np.uint32)
    order = np.argsort(-np.minimum(sizes, LONG_WORD + 1), kind="stable")
    n_long = int((sizes > LONG_WORD).sum())
    for i in order[:n_long]:
        out[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]])
    order = order[n_long:]
    first, length = starts[order], sizes[order]
    crc = np.full(len(order), _ALL)
    for at in range(int(length[0]) if len(length) else 0):
        n = int(np.searchsorted(-length, -at, "left"))  # words of more than ``at`` bytes come first
        crc[:n] = table[(crc[:n] ^ data[first[:n] + at]) & 0xFF] ^ (crc[:n] >> 8)
    out[order] = crc ^ _ALL
    return out


def hashed_features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket) of every word and pair of neighbouring words, and words a text."""
    raw = pc.cast(pc.fill_null(texts, ""), pa.large_binary())
    bounds = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    low, is_word = _letters()
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside, data = is_word[data], low[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = bounds[bounds < len(data)]
    opens[edges] = inside[edges]
    edges = bounds[bounds > 0] - 1
    closes[edges] = inside[edges]
    starts = np.flatnonzero(opens)
    sizes = np.flatnonzero(closes) + 1 - starts
    text = np.searchsorted(bounds, starts, "right") - 1
    crc = _word_crcs(data, starts, sizes)
    pair = np.flatnonzero(text[1:] == text[:-1])
    # The crc32 of "a b" from those of "a" and "b": "a" with its blank, moved behind by b's bytes.
    lead = _followed(crc[pair], np.ones(len(pair), np.int64)) ^ np.uint32(zlib.crc32(b" "))
    second = pair + 1
    pairs = _followed(lead, np.minimum(sizes[second], LONG_WORD)) ^ crc[second]
    for i in np.flatnonzero(sizes[second] > LONG_WORD):
        word = second[i]
        pairs[i] = zlib.crc32(data[starts[word] : starts[word] + sizes[word]], int(lead[i]))
    bucket = np.concatenate([crc, pairs]) % np.uint32(buckets)
    return np.concatenate([text, text[pair]]), bucket.astype(np.int64), np.bincount(text, minlength=len(raw))


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Slices of bounded text bytes and rows; one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        low = 0
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = min(max(int(np.searchsorted(ends, before + most, "right")), low + 1), low + BLOCK_DOCS)
            yield batch.slice(low, high - low)
            low += high - low


#: range -1 describes a block's documents: ids (8 bytes each, with a byte for null in ``sizes``),
#: words and features. Other rows hold a range's postings: how many a bucket has, then their
#: documents (numbers in the block) and counts; ``held`` is what the block holds of each bucket.
POSTINGS = "block string, range int, n_docs int, sizes binary, docs binary, counts binary, held array<long>"


def _inverted(buckets: int, block_bytes: int):
    ranges = -(-buckets // RANGE)

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(_blocks(batches, block_bytes)):
            n = batch.num_rows
            text, bucket, words = hashed_features(batch.column("text"), buckets)
            ids = batch.column("doc_id")
            sized = np.bincount(text, minlength=n)
            key, count = np.unique(bucket * n + text, return_counts=True)
            bucket, doc = key // n, (key % n).astype("<u2")
            held = np.bincount(bucket, count, minlength=ranges * RANGE).astype(np.int64)
            sizes = np.bincount(bucket, minlength=ranges * RANGE).astype("<u4")
            ends = np.searchsorted(bucket, np.arange(0, ranges + 1) * RANGE)
            count = count.astype("<u1" if not count.size or count.max() < 256 else "<u4")
            about = (ids.is_null().to_numpy(zero_copy_only=False).astype("<u1"), pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype("<i8"), np.stack([words, sized]).astype("<i8"))
            rows = [(-1, *about, [])] + [(r, sizes[r * RANGE : (r + 1) * RANGE], doc[a:b], count[a:b], held[r * RANGE : (r + 1) * RANGE]) for r, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True))]
            yield pa.RecordBatch.from_arrays([
                pa.array([f"{part}-{number}"] * len(rows)), pa.array([r[0] for r in rows], pa.int32()), pa.array([n] * len(rows), pa.int32()),
                *[pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in (1, 2, 3)], pa.array([r[4] for r in rows], pa.list_(pa.int64())),
            ], ["block", "range", "n_docs", "sizes", "docs", "counts", "held"])

    return invert


def _held(postings: DataFrame, name: str) -> DataFrame:
    """How many features a corpus holds in each bucket."""
    return postings.where("range >= 0").select("range", F.posexplode("held").alias("place", "n")).groupBy("range", "place").agg(F.sum("n").alias(name))


def _contributions(own_total: int, target_total: int, buckets: int):
    """Sums of gains a document of a block, from one range's postings and what both corpora hold there."""

    def contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                s, t = (np.array(row[name], np.float64) for name in ("own", "target"))
                gains = np.floor(1000 * np.log((t + 1) * (own_total + buckets) / ((s + 1) * (target_total + buckets))))
                docs, sizes = np.frombuffer(row["docs"], "<u2"), np.frombuffer(row["sizes"], "<u4")
                counts = np.frombuffer(row["counts"], "<u1" if len(row["counts"]) == len(docs) else "<u4")
                sums = np.bincount(docs, np.repeat(gains, sizes) * counts, minlength=row["n_docs"]).astype("<i8")
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]]), pa.array([sums.tobytes()], pa.binary())], ["block", "sums"])

    return contribute


def _reduced(group: pa.Table) -> pa.Table:
    """A block's documents with all their contributions: a row for each range, and one that describes them."""
    head = group.filter(pc.is_valid(group.column("docs"))).to_pylist()[0]
    words, features = np.frombuffer(head["counts"], "<i8").reshape(2, -1)
    total = np.zeros(len(words), np.int64)
    for part in group.column("sums").to_pylist():
        if part is not None:
            total += np.frombuffer(part, "<i8")
    ids = pa.array(np.frombuffer(head["docs"], "<i8"), mask=np.frombuffer(head["sizes"], "<u1").astype(bool))
    return pa.table([ids, pa.array(words), pa.array(features), pa.array(total // np.maximum(features, 1))], ["doc_id", "n_words", "n_features", "weight"])


def importance_weights(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_words, n_features and weight (the floored mean gain) of each row of docs."""
    invert = _inverted(buckets, BLOCK_BYTES)
    postings = materialize(canonical(docs, id_col, text_col).mapInArrow(invert, POSTINGS), "postings", ROW_GROUP)
    wanted = target.select(F.lit(0).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(invert, POSTINGS)
    both = _held(postings, "own").join(_held(wanted, "target"), ["range", "place"], "full")
    both = materialize(both.select("range", "place", F.coalesce("own", F.lit(0)).alias("own"), F.coalesce("target", F.lit(0)).alias("target")), "held")
    own_total, target_total = both.agg(F.coalesce(F.sum("own"), F.lit(0)), F.coalesce(F.sum("target"), F.lit(0))).first()
    n_blocks = postings.where("range = -1").count()
    salts = max(1, -(-n_blocks // BLOCKS_A_SALT))
    # A row for each range, of as many numbers as a range has buckets, and each of its salts.
    held = both.groupBy("range").agg(F.array_sort(F.collect_list(F.struct("place", "own", "target"))).alias("h"))
    held = held.select("range", F.col("h.own").alias("own"), F.col("h.target").alias("target"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    dealt = postings.where("range >= 0").select("block", "range", "n_docs", "sizes", "docs", "counts", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"))
    met = dealt.join(held.hint("shuffle_hash"), ["range", "salt"]).select("block", "n_docs", "sizes", "docs", "counts", "own", "target")
    sums = met.mapInArrow(_contributions(own_total, target_total, buckets), "block string, sums binary")
    heads = postings.where("range = -1").select("block", "sizes", "docs", "counts", F.lit(None).cast("binary").alias("sums"))
    none = F.lit(None).cast("binary")
    parts = sums.select("block", none.alias("sizes"), none.alias("docs"), none.alias("counts"), "sums").unionByName(heads)
    return parts.groupBy("block").applyInArrow(_reduced, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """The weights with score, rank and drawn: of the documents with ``min_words`` words, that
    percentage with the highest scores, ranked from 1; others have no rank."""
    weights = importance_weights(docs, target, id_col, text_col, buckets)
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    score = F.col("weight") + F.floor(-1000.0 * F.log(-F.log(uniform))).cast("long")
    scored = materialize(weights.withColumn("score", score).withColumn("eligible", F.col("n_words") >= min_words), "scored")
    drawn = scored.where("eligible").count() * percent // 100
    placed = ranked(scored, [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first()], "place")
    rank = F.when(F.col("eligible") & (F.col("place") <= drawn), F.col("place"))
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"), rank.isNotNull().alias("drawn"))


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    found = resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
