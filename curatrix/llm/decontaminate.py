"""Benchmark decontamination in DataFrame operations only.

A document is contaminated by an item when some window of the item's number of words has
weighted (multiset) Jaccard similarity of 0.8 or more with it on word shingles. Windows
that share no shingle with an item have similarity 0, so item-sized windows are laid only
where a document's shingle is one of an item's, at each alignment that it gives. Windows
get SimHash fingerprints; a multi-index over eight byte blocks finds every item within the
radius (23 differing bits leave at most two in some block, and all bytes within two bits of
the item's are probed), among items of the window's own size; the exact similarity of shingle
multisets then decides.

Text is lower-cased on A-Z; words are runs of anything but ASCII white space; shingles are
five words, for items of fewer words the whole item. The benchmark side is broadcast only
while its counted rows stay within ``MAX_BROADCAST_ROWS``; beyond, the same joins shuffle.

Defined results: null and empty texts are clean; items without words match nothing; equal
texts get equal results whatever their ids; repeated rows appear once each; texts of any
length are read whole; items that tie in similarity are all listed; empty tables give no
rows or no matches; other columns, whatever their names, are ignored. Near the end of a text
windows are cut at the end.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import UPPER, WORD_SPLIT, documents, materialize, table

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 23
#: Rows of the benchmark side (shingles, probes) up to which a join broadcasts it: under 64 MB.
MAX_BROADCAST_ROWS = 400_000
#: 16 bits a lane count the shingles of a window.
MAX_COUNTED = 65_535


def _words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, UPPER.lower()), WORD_SPLIT), lambda w: w != "")


def _shingles(words: Column, k: Column) -> Column:
    """Shingle strings in order, repeats included; fewer words than k are one shingle."""
    at = F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0)))
    return F.transform(at, lambda i: F.array_join(F.slice(words, i + 1, k), " "))


def _numbered(shingles: Column) -> Column:
    """Repeats told apart by how often they came before: a multiset as a set."""
    numbered = F.transform(shingles, lambda x, i: F.concat(x, F.lit("\n"), F.size(F.filter(F.slice(shingles, 1, i), lambda y: y == x)).cast("string")))
    return F.when(F.size(F.array_distinct(shingles)) == F.size(shingles), F.transform(shingles, lambda x: F.concat(x, F.lit("\n0")))).otherwise(numbered)


def _fingerprint(hashes: Column) -> Column:
    """Bits set in over half the hashes; sixteen sums count four bits each."""
    mask = 0x0001000100010001
    half = F.size(hashes)
    bits = []
    for lane in range(16):
        total = F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a + F.shiftrightunsigned(h, lane).bitwiseAND(F.lit(mask)))
        for k in range(4):
            count = F.shiftrightunsigned(total, 16 * k).bitwiseAND(F.lit(0xFFFF))
            value = 1 << (16 * k + lane)
            bits.append(F.when(2 * count > half, F.lit(value - (1 << 64) if value >> 63 else value)).otherwise(F.lit(0).cast("long")))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _block(fp: Column, b: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * b).bitwiseAND(F.lit(0xFF))


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """One row per distinct item with words: its shingles and fingerprint."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _words(F.coalesce("text", F.lit(""))).alias("words")).distinct().where(F.size("words") > 0)
    items = items.withColumn("n", F.size("words")).withColumn("k", F.least("n", F.lit(SHINGLE)))
    items = items.withColumn("shingles", _shingles(F.col("words"), F.col("k")))
    items = items.withColumn("fp", _fingerprint(F.transform("shingles", lambda s: F.xxhash64(s))))
    return materialize(items.select(F.xxhash64("item_id", "words").alias("item_key"), "item_id", "words", "n", "k", "shingles", _numbered(F.col("shingles")).alias("item_set"), "fp"), "items")


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(k1, k2, item_id, similarity) for each distinct text, by its hashes, and item it holds."""
    items = benchmark_items(benchmark)
    n_items, n_shingles = items.agg(F.count("*"), F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()
    # Five at most: the shingle lengths of short items and of all others.
    ks = sorted(r["k"] for r in items.select("k").distinct().collect())
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(*text_key(F.col("text")), _words(F.col("text")).alias("words"))
    texts = texts.withColumn("n", F.size("words"))
    windows = None
    for k in ks:
        grams = items.where(F.col("k") == k).select("words", F.posexplode("shingles").alias("at", "s"), F.col("n").alias("item_n"))
        keyed = grams.select(F.xxhash64(*[F.element_at("words", F.col("at") + j + 1) for j in range(k)]).alias("h"), "at", "item_n").distinct()
        placed = texts.where(F.col("n") >= k).select("*", F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("i"))
        placed = placed.withColumn("h", F.xxhash64(*[F.element_at("words", F.col("i") + j + 1) for j in range(k)]))
        start = F.greatest(F.col("i") - F.col("at"), F.lit(0))
        if n_shingles <= MAX_BROADCAST_ROWS:
            hits = placed.join(F.broadcast(keyed), "h").withColumn("start", start)
        else:  # places travel without their text, which only the places that hit look up
            where = placed.select("k1", "k2", "i", "h").join(keyed, "h").select("k1", "k2", start.alias("start"), "item_n").distinct()
            hits = texts.dropDuplicates(["k1", "k2"]).join(where, ["k1", "k2"])
        size = F.least("item_n", F.col("n") - F.col("start"))
        hits = hits.select("k1", "k2", F.lit(k).alias("k"), "item_n", (F.col("start") == 0).alias("first"), F.slice("words", F.col("start") + 1, size).alias("window"))
        windows = hits if windows is None else windows.unionByName(hits)
    if windows is None:
        return docs.sparkSession.createDataFrame([], "k1 long, k2 long, item_id long, similarity double")
    # Equal windows of equal texts once; where else in the text they lie no longer matters.
    windows = windows.distinct().withColumn("shingles", _shingles(F.col("window"), F.col("k"))).drop("window")
    windows = windows.withColumn("fp", _fingerprint(F.transform("shingles", lambda s: F.xxhash64(s))))
    windows = materialize(windows.withColumn("wid", F.monotonically_increasing_id()), "windows")
    # Probes: every byte within two bits of each of an item's eight. A window meets items of its own size alone.
    masks = [0, *[1 << i for i in range(8)], *[(1 << i) | (1 << j) for i, j in itertools.combinations(range(8), 2)]]
    blocks = F.array(*[F.struct(F.lit(b).alias("b"), _block(F.col("fp"), b).alias("v")) for b in range(8)])
    probes = items.select("item_key", F.col("n").alias("item_n"), "k", F.col("fp").alias("item_fp"), F.explode(blocks).alias("p")).select("item_key", "item_n", "k", "item_fp", F.col("p.b").alias("b"), F.explode(F.array(*[F.col("p.v").bitwiseXOR(F.lit(m)) for m in masks])).alias("v"))
    differing = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first = reduce(lambda rest, b: F.when(F.bit_count(_block(differing, b)) <= 2, F.lit(b)).otherwise(rest), range(7, -1, -1), F.lit(8))
    # Fingerprints alone travel; shingles are looked up for what lies within the radius.
    asked = windows.select("wid", "item_n", "k", "fp", F.explode(blocks).alias("p")).select("wid", "item_n", "k", "fp", F.col("p.b").alias("b"), F.col("p.v").alias("v"))
    near = asked.join(_sized(probes, n_items * 8 * len(masks)), ["item_n", "k", "b", "v"]).where((F.bit_count(differing) <= RADIUS) & (F.col("b") == first)).select("wid", "item_key")
    if (n_shingles or 0) > MAX_COUNTED:  # windows too long for the counters are verified without a fingerprint
        long_items = items.where(F.size("shingles") > MAX_COUNTED).select("item_key", "k", F.col("n").alias("item_n"))
        near = near.unionByName(windows.where(F.size("shingles") > MAX_COUNTED).join(long_items, ["item_n", "k"]).select("wid", "item_key"))
    pairs = near.join(windows.select("wid", "k1", "k2", "first", "shingles"), "wid")
    pairs = pairs.join(_sized(items.select("item_key", "item_id", "item_set", F.col("shingles").alias("item_shingles")), n_shingles), "item_key").where(_laid_by_item())
    pairs = pairs.withColumn("window_set", _numbered(F.col("shingles")))
    shared = F.size(F.array_intersect("window_set", "item_set"))
    alike = shared / (F.size("window_set") + F.size("item_set") - shared)
    return pairs.select("k1", "k2", "item_id", alike.alias("similarity")).where(F.col("similarity") >= similarity).groupBy("k1", "k2", "item_id").agg(F.max("similarity").alias("similarity"))


def _laid_by_item() -> Column:
    """Whether a shingle of this very item gives the window its place: one that stands at the same
    place in both, or, where the text's beginning cut the alignment, at a later one in the item."""
    item = F.col("item_shingles")
    at_start = F.exists(F.transform("shingles", lambda x, i: F.array_contains(F.slice(item, i + 1, F.size(item)), x)), lambda x: x)
    aligned = F.exists(F.zip_with("shingles", item, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda x: x)
    return F.when(F.col("first"), at_start).otherwise(aligned)


def text_key(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that stand for a text."""
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")


def benchmark_overlap(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (ascending), best_similarity (0 if clean)."""
    found = contaminated_texts(docs, benchmark, similarity).groupBy("k1", "k2").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("item_id")).alias("ids"), F.max("similarity").alias("best"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.coalesce("text", F.lit(""))))
    return keyed.join(found, ["k1", "k2"], "left").select("doc_id", F.col("n").isNotNull().alias("contaminated"), F.coalesce("n", F.lit(0)).alias("n_items"), F.coalesce("ids", F.array().cast("array<long>")).alias("item_ids"), F.coalesce("best", F.lit(0.0)).alias("best_similarity"))


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    found = benchmark_overlap(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "n_items", F.array_join("item_ids", ",").alias("item_ids"), "best_similarity")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The clean documents, all columns kept."""
    found = contaminated_texts(docs, benchmark, similarity).select("k1", "k2").distinct()
    k1, k2 = text_key(F.coalesce(docs["text"], F.lit("")))
    return docs.join(found, (k1 == found["k1"]) & (k2 == found["k2"]), "left_anti")


#: The same result without fingerprints: every window at a shared shingle, compared exactly.
ORACLE = r"""
WITH items AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
ig AS (SELECT item_id, w, len(w) AS n, least(len(w), 5) AS k FROM items WHERE len(w) > 0),
igrams AS (
  SELECT item_id, n, k, i AS pos, array_to_string(w[i + 1 : i + k], ' ') AS s FROM ig, LATERAL (SELECT unnest(range(0, n - k + 1)) AS i)),
icount AS (SELECT item_id, s, count(*) AS c FROM igrams GROUP BY ALL),
d AS (
  SELECT DISTINCT coalesce(text, '') AS text FROM documents),
dw AS (
  SELECT text, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
dgrams AS (
  SELECT text, k, i AS pos, array_to_string(w[i + 1 : i + k], ' ') AS s
  FROM dw, (SELECT DISTINCT k FROM ig) ks, LATERAL (SELECT unnest(range(0, len(w) - k + 1)) AS i)),
spots AS (
  SELECT DISTINCT g.text, i.item_id, i.k, i.n, greatest(g.pos - i.pos, 0) AS start
  FROM dgrams g JOIN igrams i ON g.s = i.s AND g.k = i.k),
wgrams AS (
  SELECT p.text, p.item_id, p.start, g.s, count(*) AS c
  FROM spots p JOIN dgrams g ON g.text = p.text AND g.k = p.k AND g.pos >= p.start AND g.pos <= p.start + p.n - p.k
  GROUP BY ALL),
sims AS (
  SELECT g.text, g.item_id, g.start, sum(least(g.c, coalesce(i.c, 0))) AS shared_n, sum(g.c) AS a
  FROM wgrams g LEFT JOIN icount i ON i.item_id = g.item_id AND i.s = g.s GROUP BY ALL),
hits AS (
  SELECT text, item_id, max(CAST(shared_n AS DOUBLE) / CAST(a + t.b - shared_n AS DOUBLE)) AS sim
  FROM sims JOIN (SELECT item_id, sum(c) AS b FROM icount GROUP BY ALL) t USING (item_id) GROUP BY ALL),
per AS (
  SELECT text, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS ids, max(sim) AS best
  FROM hits WHERE sim >= 0.8 GROUP BY ALL)
SELECT doc_id, p.n IS NOT NULL AS contaminated, coalesce(p.n, 0) AS n_items, coalesce(p.ids, '') AS item_ids, coalesce(p.best, 0.0) AS best_similarity
FROM documents o LEFT JOIN per p ON p.text = coalesce(o.text, '')
"""
