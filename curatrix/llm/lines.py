"""Line dedup with a log-template tree.

A line's tokens lead it down a tree of fixed depth: token count, then its leading tokens.
At a leaf, lines join the first template that agrees with at least ``similarity`` of their
tokens, or start one; places that differ become wild. Tokens with digits are wild from the
start, so numbers, dates, addresses and ids never split a template. Lines are taken at a
leaf in the order of their masked text, so templates don't depend on the order of rows.

A template recurs if lines of at least ``min_docs`` documents that are no near copies of each
other (``near_copies``: five-word shingles, similarity 0.8) have it beside other lines; one of
``LONG`` tokens without digits or more if lines of two such documents do. Recurring lines are
boilerplate and are dropped from every document; near copies of whole documents are left to
near-dedup, which keeps one, and count as one here.

Groups of near copies are formed among the different texts that hold candidate lines.

Documents stay, even without lines. Defined results: null and empty texts, and blank lines,
stay as they are; a document's repeated lines count once; repeated rows get equal results
and count as one document; texts and lines of any length are read whole; ties (lines that
two templates fit) go to the template that came first in the order of masked texts; an empty
table gives no rows; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatrix.llm.common import by_texts, documents, mark, materialize, may_hold, numbered, partitions_for, release
from curatrix.llm.near_copies import near_copy_groups

SIMILARITY, LEADING, MIN_DOCS = 0.8, 3, 4
#: Chance does not repeat lines of so many tokens: two documents are enough.
LONG, MIN_LONG = 20, 2
WILD = "<*>"
#: Flags that prefilter leaves.
SLOTS = 1 << 20
#: Tasks that the lines of one template are dealt over when the recurring ones are picked.
SALTS = 16
_DIGIT = re.compile(r"[0-9]")


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def masked_tokens(line: str) -> list[str]:
    """The line's tokens, those with digits as wild."""
    tokens = line.split()
    return [WILD if _DIGIT.search(t) else t for t in tokens] if _DIGIT.search(line) else tokens


def line_hash(masked: str) -> int:
    return _signed(xxhash.xxh64_intdigest(masked.encode("utf-8", "surrogatepass")))


def leaf_of(tokens: list[str], leading: int = LEADING) -> int:
    """The leaf: token count and leading tokens."""
    return line_hash(f"{len(tokens)} " + " ".join(tokens[:leading]))


class Leaf:
    """Templates of one leaf; tokens as rows of 64-bit codes, 0 for wild.

    A template that a line joins differs from it in few places. So of any few places more,
    one agrees, and the templates that agree at the line's rarest such places are enough to
    look at; they are found by place and code."""

    def __init__(self, width: int, similarity: float) -> None:
        self.width, self.similarity = width, similarity
        self.probes = width - math.ceil(similarity * width) + 1
        self.templates = np.zeros((8, width), np.uint64)
        self.by_code: dict[tuple[int, int], list[int]] = {}
        self.wild: list[list[int]] = [[] for _ in range(width)]
        self.n = 0

    def _near(self, codes: np.ndarray) -> np.ndarray:
        """Templates that may agree, ascending."""
        if self.n <= 64:
            return np.arange(self.n)
        solid = [(j, int(c)) for j, c in enumerate(codes.tolist()) if c]
        if len(solid) < self.probes:
            return np.arange(self.n)
        sized = sorted((len(self.by_code.get(k, ())) + len(self.wild[k[0]]), k) for k in solid)[: self.probes]
        found = {t for _, k in sized for t in (*self.by_code.get(k, ()), *self.wild[k[0]])}
        return np.array(sorted(found), np.int64)

    def add(self, codes: np.ndarray) -> int:
        """The index of the template that the line joins, the first that agrees."""
        near = self._near(codes)
        if len(near):
            known = self.templates[near]
            agree = ((known == codes) | (known == 0) | (codes == 0)).sum(1)
            exact = ((known == codes) & (codes != 0)).sum(1)
            fit = np.flatnonzero((agree >= self.similarity * self.width) & ((exact > 0) | (agree == self.width)))
            if len(fit):
                k = int(near[fit[0]])
                for j in np.flatnonzero((self.templates[k] != codes) & (self.templates[k] != 0)).tolist():
                    self.by_code[j, int(self.templates[k, j])].remove(k)
                    self.wild[j].append(k)
                    self.templates[k, j] = 0
                return k
        if self.n == len(self.templates):
            self.templates = np.concatenate([self.templates, np.zeros_like(self.templates)])
        self.templates[self.n] = codes
        for j, c in enumerate(codes.tolist()):
            if c:
                self.by_code.setdefault((j, c), []).append(self.n)
            else:
                self.wild[j].append(self.n)
        self.n += 1
        return self.n - 1


def _codes(tokens: list[str]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([0 if t == WILD else digest(t.encode("utf-8", "surrogatepass")) or 1 for t in tokens], np.uint64)


def cluster_leaf(masked: list[str], similarity: float = SIMILARITY) -> list[int]:
    """Template indexes of a leaf's distinct masked lines, given in sorted order."""
    first = masked[0].split(" ")
    leaf = Leaf(len(first), similarity)
    return [leaf.add(_codes(m.split(" "))) for m in masked]


def _doc_lines(text: str, leading: int) -> dict[int, tuple[int, str, int]]:
    """The text's different lines: hash -> (leaf, masked line, tokens that aren't wild)."""
    out: dict[int, tuple[int, str, int]] = {}
    for raw in text.split("\n"):
        tokens = masked_tokens(raw)
        if tokens:
            masked = " ".join(tokens)
            h = line_hash(masked)
            if h not in out:
                out[h] = (leaf_of(tokens, leading), masked, len(tokens) - tokens.count(WILD))
    return out


def _with_templates(named: DataFrame, templates: DataFrame) -> DataFrame:
    """The rows of those templates; as one may hold a large share of all, dealt over SALTS tasks."""
    salted = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return named.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted.hint("merge"), ["template", "salt"], "left_semi").drop("salt")


def recurring_lines(rows: DataFrame, similarity: float = SIMILARITY, leading: int = LEADING, min_docs: int = MIN_DOCS) -> DataFrame:
    """rows (row, text) -> (row, line) of every line to drop, line by the hash of its masked text."""

    def occurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_texts(batches, 1024):
            row_of, hashes, solids, leaves, wholes = [], [], [], [], []
            for row, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                lines = _doc_lines(text, leading)
                n = len(lines)
                row_of += [row] * n
                wholes += [line_hash(text)] * n if n else []
                hashes += lines
                leaves += [v[0] for v in lines.values()]
                # Lines that are all of their document have no surroundings.
                solids += [v[2] for v in lines.values()] if n > 1 else [-1] * n
            columns = [pa.array(row_of, pa.int64()), pa.array(hashes, pa.int64()), pa.array(solids, pa.int32()), pa.array(leaves, pa.int64()), pa.array(wholes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "line", "solid", "leaf", "whole"])

    rows = rows.select("row", "text")
    occurrences = materialize(rows.mapInArrow(occurring, "row long, line long, solid int, leaf long, whole long"), "lines")
    # Lines of a leaf that one document has can't recur. Of the others' leaves, only those with
    # several masked lines need their texts together. SLOTS flags, whatever the size of the
    # input, keep most other texts from being sent at all.
    busy = occurrences.groupBy("leaf").agg(F.min("line").alias("low"), F.max("line").alias("high"), F.min("row").alias("first"), F.max("row").alias("last")).where("first < last")
    busy = materialize(busy.select("leaf", (F.col("low") < F.col("high")).alias("several")), "leaves")
    live = materialize(may_hold(occurrences, busy, "leaf").where("__may").drop("__may"), "live-lines")
    shared = busy.where("several").select("leaf")
    flags = np.zeros(SLOTS, bool)
    flags[[r[0] for r in shared.select(F.col("leaf").bitwiseAND(F.lit(SLOTS - 1)).alias("slot")).distinct().collect()]] = True
    share = rows.sparkSession.sparkContext.broadcast(np.packbits(flags))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(share.value).astype(bool)
        for batch in by_texts(batches, 1024):
            seen: dict[int, tuple[int, str, int]] = {}
            for text in batch[1].to_pylist():
                for h, where in _doc_lines(text, leading).items():
                    if flags[where[0] & (SLOTS - 1)]:
                        seen.setdefault(h, where)
            yield pa.RecordBatch.from_arrays([pa.array([v[0] for v in seen.values()], pa.int64()), pa.array(list(seen), pa.int64()), pa.array([v[1] for v in seen.values()], pa.string())], names=["leaf", "line", "masked"])

    readers = may_hold(occurrences, shared, "leaf").where("__may").select("row")
    texts = may_hold(rows, readers).where("__may").select("row", "text").mapInArrow(wanted, "leaf long, line long, masked string")

    def cluster(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, str]] = []

        def done(group):
            distinct = list({line: (line, masked) for _, line, masked in group}.values())
            k = cluster_leaf([m for _, m in distinct], similarity)
            names = [_signed(xxhash.xxh64_intdigest(f"{group[0][0]}:{i}".encode())) for i in k]
            return [line for line, _ in distinct], names

        for batch in batches:
            lines, names = [], []
            for item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != item[0]:
                    a, b = done(held)
                    lines += a
                    names += b
                    held = []
                if not held or held[-1][1] != item[1]:
                    held.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.int64()), pa.array(names, pa.int64())], names=["line", "template"])
        if held:
            lines, names = done(held)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.int64()), pa.array(names, pa.int64())], names=["line", "template"])

    parts = partitions_for(rows)
    together = texts.join(shared, "leaf", "left_semi").select("leaf", "line", "masked").dropDuplicates(["leaf", "line"])
    templates = together.repartition(parts, "leaf").sortWithinPartitions("leaf", "masked").mapInArrow(cluster, "line long, template long")
    templates = materialize(templates.where("template is not null"), "templates")
    named = materialize(live.drop("leaf").join(templates.hint("merge"), "line", "left").select("row", "line", "solid", "whole", F.coalesce("template", "line").alias("template")), "named-lines")

    def recur(beside: DataFrame, group: str) -> DataFrame:
        """Templates that enough different values of ``group`` hold beside other lines."""
        once = beside.where("solid >= 0").groupBy("template", group).agg(F.min("solid").alias("solid"))
        counted = once.groupBy("template").agg(F.count("*").alias("rests"), F.min("solid").alias("solid"))
        enough = F.when(F.col("solid") >= LONG, F.least(F.lit(MIN_LONG), F.lit(min_docs))).otherwise(F.lit(min_docs))
        return counted.where(F.col("rests") >= enough).select("template")

    # Equal texts are near copies: what recurs in too few different texts needs no closer look.
    several = named.groupBy("template").agg(F.min("whole").alias("low"), F.max("whole").alias("high")).where("low < high").select("template")
    shared = materialize(_with_templates(named, several), "shared-lines")
    lines = materialize(_with_templates(shared, recur(shared, "whole")), "candidate-lines")
    # Surroundings: groups of near copies among the documents that hold such lines.
    first = materialize(lines.where("solid >= 0").groupBy("whole").agg(F.min("row").alias("row")), "holders").select("row")
    groups = near_copy_groups(rows, first).join(lines.select("row", "whole").distinct(), "row").select("whole", "group")
    recurring = recur(lines.join(groups.hint("merge"), "whole"), "group")
    return _with_templates(lines, recurring).select("row", "line")


def drop_lines(text: str, lines: set[int]) -> tuple[str, int, int]:
    """The text without those lines; lines dropped, lines there were."""
    kept, all_lines = [], text.split("\n")
    for raw in all_lines:
        tokens = masked_tokens(raw)
        if not tokens or line_hash(" ".join(tokens)) not in lines:
            kept.append(raw)
    return "\n".join(kept), len(all_lines) - len(kept), len(all_lines)


def dedup_lines(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All columns of docs with recurring lines dropped from the text, and the struct
    ``__lines`` (n_lines, n_dropped)."""
    rows = numbered(docs.select(F.struct("*").alias("__doc")))
    begun = mark()
    drop = recurring_lines(rows.select("row", F.coalesce(F.col("__doc")[text_col], F.lit("")).alias("text")), **options)
    lists = drop.groupBy("row").agg(F.collect_set("line").alias("lines"))

    columns, at = docs.columns, docs.columns.index(text_col)

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_texts(batches):
            fields = batch.column(0).flatten()
            out = []
            for t, h in zip(fields[at].to_pylist(), batch.column(1).to_pylist(), strict=True):
                out.append((t, 0, (t or "").count("\n") + 1) if t is None or not h else drop_lines(t, set(h)))
            fields[at] = pa.array([o[0] for o in out], fields[at].type)
            counts = pa.StructArray.from_arrays([pa.array([o[2] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32())], names=["n_lines", "n_dropped"])
            yield pa.RecordBatch.from_arrays([*fields, counts], names=[*columns, "__lines"])

    schema = T.StructType([*docs.schema.fields, T.StructField("__lines", T.StructType([T.StructField("n_lines", T.IntegerType()), T.StructField("n_dropped", T.IntegerType())]))])
    lists = materialize(lists, "lists")
    release(docs.sparkSession, begun)
    marked = may_hold(rows, lists)
    joined = marked.where("__may").join(lists.hint("merge"), "row", "left").unionByName(marked.where("not __may").withColumn("lines", F.lit(None).cast("array<long>")))
    return joined.select("__doc", "lines").mapInArrow(rebuild, schema)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", F.col("__lines.n_lines").cast("long").alias("n_lines"), F.col("__lines.n_dropped").cast("long").alias("n_dropped"), "text")
