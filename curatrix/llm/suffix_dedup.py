"""Suffix-array dedup: bytes under a LENGTH-byte string that also starts earlier are removed.

Every string of LENGTH bytes contains an anchor, a place whose GRAM-byte hash is least among
its neighbours; equal strings hold equal anchors at equal places, so only suffixes around
anchors that occur more than once can match. Those are shuffled by their gram and sorted by
deep-shallow sorting, rightwards from the anchor and, reversed, leftwards; neighbours'
common prefixes give, for each depth, the classes of equal continuations. A window that
starts j bytes before its anchor equals another exactly if both classes (j bytes to the
left, LENGTH - j to the right) are equal, and the earliest member of a class stays.

Documents are dealt once into buckets by id and text; later steps read the same exchange.
Between steps travel packed arrays, one a pair of buckets. Equal contexts of a document
bucket are collapsed before they are sent, and others before sorting, so copies cost a
comparison each. Runs of a short period repeat themselves: their later windows are removed
where they stand, and no context is made of them.

Order is by doc_id, then by start; rows that share an id come in the order of a hash of
their texts, null ids first; of repeated rows (equal id and text) the first keeps its bytes.
Defined results: null and empty texts have nothing to remove and the hash of no bytes; texts
of any length are read whole; ties (equal strings at one place of equal order) can't occur;
an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import canonical, documents, partitions_for
from curatrix.llm.suffix_sort import deep_shallow, neighbour_lcp

LENGTH, GRAM = 100, 24
WINDOW = LENGTH - GRAM + 1
LEFT = LENGTH - GRAM
#: Stored bytes of documents in one bucket, about.
BUCKET_BYTES = 5 << 20
NULL_ID = -(1 << 63)

# A document is (doc, th, nth): its id, 32 bits of its text's hash, and its place among the
# different texts that share both. A location with gap 0 is a run to remove, from pos to h.
DOC = [("doc", "<i8"), ("th", "<u4"), ("nth", "u1")]
LOC = np.dtype([("h", "<u8"), *DOC, ("pos", "<u4"), ("gap", "u1")])
CTX = np.dtype([("h", "<u8"), *DOC, ("pos", "<u4"), ("left", "u1"), ("right", "u1")])
RUN = np.dtype([*DOC, ("start", "<u4"), ("end", "<u4")])
#: Anchors whose neighbours are looked at together.
STEP = 1 << 14
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
BLOBS = "bucket int, blob binary"


def _slide(f, a: np.ndarray, width: int) -> np.ndarray:
    """f over each run of ``width`` values."""
    step, cur = 1, a
    while step * 2 <= width:
        cur = f(cur[:-step], cur[step:])
        step *= 2
    n = len(a) - width + 1
    return cur[:n] if step == width else f(cur[:n], cur[width - step : width - step + n])


def periodic(data: bytes, h: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of bytes whose LENGTH-byte windows all start a period earlier too, for the
    periods that successive equal anchors show."""
    gaps = np.diff(at)[h[1:] == h[:-1]]
    raw, out = np.frombuffer(data, np.uint8), []
    for period in np.flatnonzero(np.bincount(gaps, minlength=1) > 3).tolist() if len(gaps) else []:
        equal = np.r_[False, raw[period:] == raw[:-period], False]
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= LENGTH:
                out.append((a + period, b + period))
    return out


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(hashes, places, bytes to the right in their windows) of the anchors of at least
    LENGTH bytes, without those whose windows all lie in periodic runs, and these runs."""
    n8 = len(data) - 7
    words = np.empty(n8, np.uint64)
    for r in range(8):
        count = (n8 - r + 7) // 8
        if count > 0:
            words[r::8] = np.frombuffer(data, "<u8", count, r)
    n = len(data) - GRAM + 1
    h = words[:n] * _MIX[0]
    h ^= h >> np.uint64(29)
    h += words[8 : 8 + n]
    h *= _MIX[1]
    h ^= h >> np.uint64(32)
    h += words[16 : 16 + n]
    h *= _MIX[2]
    h ^= h >> np.uint64(31)
    least = _slide(np.minimum, h, WINDOW)
    edge = np.zeros(WINDOW - 1, np.uint64)
    at = np.flatnonzero(_slide(np.maximum, np.concatenate([edge, least, edge]), WINDOW) == h)
    runs = periodic(data, h[at], at)
    for a, b in runs:
        at = at[(at - LEFT < a) | (at + LENGTH > b)]
    # A window belongs to the last place of its least hash, so to this anchor until one that
    # is no larger enters: the bytes to the right that such windows have.
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([h, np.full(WINDOW, ~np.uint64(0))]), WINDOW - 1)
    gap = np.empty(len(at), np.int64)
    for k in range(0, len(at), STEP):
        part = at[k : k + STEP]
        ahead = view[part + 1] <= h[part][:, None]
        gap[k : k + STEP] = np.where(ahead.any(1), ahead.argmax(1) + 1, WINDOW)
    return h[at], at, np.minimum(gap + GRAM - 1, LENGTH), runs


def _texts(table: pa.Table) -> list[tuple[tuple[int, int, int], bytes, list]]:
    """((doc, th, nth), bytes, ids of the equal rows) of a bucket's different documents."""
    ids = table.column("doc_id").to_pylist()
    keys = [NULL_ID if x is None else x for x in ids]
    rows = sorted(zip(keys, table.column("th").to_pylist(), table.column("text").cast(pa.binary()).to_pylist(), ids, strict=True), key=lambda r: (*r[:3], r[3] is not None))
    out: list[tuple[tuple[int, int, int], bytes, list]] = []
    for key, th, data, doc_id in rows:
        if out and out[-1][0][:2] == (key, th):
            if out[-1][1] == data:
                out[-1][2].append(doc_id)
                continue
            out.append(((key, th, out[-1][0][2] + 1), data, [doc_id]))
        else:
            out.append(((key, th, 0), data, [doc_id]))
    return out


def _places(records: np.ndarray, first: str) -> tuple[np.ndarray, dict[tuple[int, int, int], slice]]:
    """The records by document, and where each document's are."""
    records = records[np.lexsort((records[first], records["nth"], records["th"], records["doc"]))]
    keys = records[["doc", "th", "nth"]]
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, int)
    ends = np.r_[cut[1:], len(keys)]
    return records, {tuple(keys[a].tolist()): slice(a, b) for a, b in zip(cut.tolist(), ends.tolist())}


def _blobs(records: np.ndarray, bucket: np.ndarray, extra: np.ndarray | None = None, tag: bytes = b"") -> pa.Table:
    """Records (and rows of bytes beside them) packed by bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, records = bucket[order], records[order]
    extra = extra[order] if extra is not None else None
    cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else np.zeros(1, int)
    parts = [tag + records[a:b].tobytes() + (extra[a:b].tobytes() if extra is not None else b"") for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return pa.table({"bucket": pa.array(bucket[cut[:-1]].astype(np.int32)), "blob": pa.array(parts, pa.binary())})


def _unpacked(table: pa.Table, kind: np.dtype) -> np.ndarray:
    blobs = [b for b in table.column("blob").to_pylist() if b]
    return np.concatenate([np.frombuffer(b, kind) for b in blobs]) if blobs else np.empty(0, kind)


def _bucket_of_hash(h: np.ndarray, n: int) -> np.ndarray:
    return (h % np.uint64(n)).astype(np.int64)


def locate(table: pa.Table, n_grams: int) -> pa.Table:
    """A document bucket -> its anchors, packed by gram bucket."""
    out = []
    for doc, data, _ in _texts(table):
        if len(data) >= LENGTH:
            h, at, gap, runs = anchors(data)
            loc = np.zeros(len(h) + len(runs), LOC)
            loc["doc"], loc["th"], loc["nth"] = doc
            loc["h"][: len(h)], loc["pos"][: len(h)], loc["gap"][: len(h)] = h, at, gap
            for i, (a, b) in enumerate(runs, len(h)):
                loc["pos"][i], loc["h"][i] = a, b
            out.append(loc)
    records = np.concatenate(out) if out else np.empty(0, LOC)
    return _blobs(records, _bucket_of_hash(records["h"], n_grams))


def repeated(table: pa.Table, doc_bucket) -> pa.Table:
    """A gram bucket -> the anchors whose gram occurs again, packed by document bucket."""
    records = _unpacked(table, LOC)
    run = records["gap"] == 0
    h = np.sort(records["h"][~run])
    twice = np.unique(h[1:][h[1:] == h[:-1]])
    at = np.searchsorted(twice, records["h"])
    again = (at < len(twice)) & (twice[np.minimum(at, len(twice) - 1)] == records["h"]) if len(twice) else np.zeros(len(records), bool)
    kept = records[run | again]
    return _blobs(kept, doc_bucket(kept["doc"], kept["th"]))


def _context_keys(head: np.ndarray, body: np.ndarray) -> np.ndarray:
    whole = np.ascontiguousarray(np.concatenate([head["h"].copy().view(np.uint8).reshape(len(head), 8), head["left"][:, None], head["right"][:, None], body], 1))
    return whole.view([("b", f"V{whole.shape[1]}")]).ravel()


def contexts(texts: pa.Table, found: pa.Table, n_grams: int) -> pa.Table:
    """A document bucket and its repeated anchors -> their contexts (tag C) and the runs known
    to go already (tag R), packed by gram bucket."""
    records, where = _places(_unpacked(found, LOC), "pos")
    heads, bodies, runs, kept_at = [], [], [], {}
    for doc, data, _ in _texts(texts):
        own = records[where.get(doc, slice(0, 0))]
        for r in own[own["gap"] == 0]:
            runs.append((*doc, int(r["pos"]), int(r["h"])))
        own = own[own["gap"] > 0]
        padded = np.frombuffer(bytes(LEFT) + data + bytes(LENGTH), np.uint8)
        view = np.lib.stride_tricks.sliding_window_view(padded, LEFT + LENGTH)
        for k in range(0, len(own), STEP):
            part = own[k : k + STEP]
            pos = part["pos"].astype(np.int64)
            head = np.empty(len(part), CTX)
            for name in ("h", "doc", "th", "nth", "pos"):
                head[name] = part[name]
            head["left"], head["right"] = np.minimum(pos, LEFT), np.minimum(part["gap"], len(data) - pos)
            body = np.where(np.arange(LEFT + LENGTH) < LEFT + head["right"][:, None].astype(np.int64), view[pos], 0).astype(np.uint8)
            # Texts and anchors come in order, so the first of equal contexts is the earliest.
            fresh = np.ones(len(part), bool)
            for i, key in enumerate(_context_keys(head, body)):
                if kept_at.setdefault(hash(key.tobytes()), (len(heads), i)) != (len(heads), i):
                    of, j = kept_at[hash(key.tobytes())]
                    other_head, other_body = (head, body) if of == len(heads) else (heads[of][1], bodies[of])
                    if other_head["h"][j] == head["h"][i] and (other_head["left"][j], other_head["right"][j]) == (head["left"][i], head["right"][i]) and (other_body[j] == body[i]).all():
                        fresh[i] = False
                        if int(head["left"][i]) + int(head["right"][i]) >= LENGTH:
                            runs.append((*doc, int(pos[i] - head["left"][i]), int(pos[i]) + min(int(head["right"][i]), LENGTH)))
            heads.append((fresh, head))
            bodies.append(body)
    out = []
    if heads:
        head = np.concatenate([h[f] for f, h in heads])
        body = np.concatenate([b[f] for (f, _), b in zip(heads, bodies, strict=True)])
        out.append(_blobs(head, _bucket_of_hash(head["h"], n_grams), body, b"C"))
    if runs:
        gone = np.array(runs, RUN)
        out.append(_blobs(gone, _bucket_of_hash(gone["start"].astype(np.uint64), n_grams), None, b"R"))
    return pa.concat_tables(out) if out else _blobs(np.empty(0, CTX), np.empty(0, int))


def _split_contexts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heads and bodies of the contexts, and the runs."""
    each = CTX.itemsize + LEFT + LENGTH
    heads, bodies, runs = [np.empty(0, CTX)], [np.empty((0, LEFT + LENGTH), np.uint8)], [np.empty(0, RUN)]
    for blob in table.column("blob").to_pylist():
        if blob[:1] == b"R":
            runs.append(np.frombuffer(blob, RUN, offset=1))
        elif blob:
            n = len(blob) // each
            heads.append(np.frombuffer(blob, CTX, n, 1))
            bodies.append(np.frombuffer(blob, np.uint8, n * (LEFT + LENGTH), 1 + n * CTX.itemsize).reshape(n, LEFT + LENGTH))
    return np.concatenate(heads), np.concatenate(bodies), np.concatenate(runs)


def earlier_windows(head: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each context: whether it has windows that start earlier elsewhere, and the bytes
    before and after the anchor that those cover."""
    n = len(head)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((head["pos"], head["nth"], head["th"], head["doc"]))] = np.arange(n)
    left, right = head["left"].astype(np.int64), head["right"].astype(np.int64)
    # Equal contexts: all windows of the later ones are the first one's.
    key = _context_keys(head, body)
    by = np.argsort(key, kind="stable")
    fresh = np.r_[True, key[by][1:] != key[by][:-1]]
    cls = np.empty(n, np.int64)
    cls[by] = np.cumsum(fresh) - 1
    first = np.full(cls.max() + 1, n)
    np.minimum.at(first, cls, rank)
    by_rank = np.argsort(rank)
    leaders = by_rank[first]
    later = rank != first[cls]
    has, lo, hi = later & (left + right >= LENGTH), np.where(later, left, 0), np.where(later, np.minimum(right, LENGTH), 0)
    # Windows of a leader against the leaders of other contexts of its gram.
    _, gram = np.unique(head["h"][leaders], return_inverse=True)
    crowd = np.bincount(gram)[gram] > 1
    lead, gram = leaders[crowd], gram[crowd]
    m = len(lead)
    if m:
        r_len, l_len = right[lead], left[lead]
        rights = np.zeros((m, -(-LENGTH // 8) * 8), np.uint8)
        rights[:, :LENGTH] = body[lead, LEFT:]
        lefts = np.zeros((m, -(-LEFT // 8) * 8), np.uint8)
        lefts[:, :LEFT] = body[lead, :LEFT][:, ::-1]
        r_order, l_order = deep_shallow(rights, r_len, gram), deep_shallow(lefts, l_len, gram)
        r_lcp, l_lcp = neighbour_lcp(rights, r_len, gram, r_order), neighbour_lcp(lefts, l_len, gram, l_order)
        l_same_gram = np.r_[False, gram[l_order][1:] == gram[l_order][:-1]]
        place, lead_rank = np.arange(m), rank[lead]
        low, high = np.full(m, LENGTH), np.full(m, -1)
        for j in range(LEFT + 1):
            # Classes at this depth: where the run of neighbours that share it starts.
            r_cls, l_cls = np.empty(m, np.int64), np.empty(m, np.int64)
            r_cls[r_order] = np.maximum.accumulate(np.where(r_lcp >= LENGTH - j, 0, place))
            l_cls[l_order] = np.maximum.accumulate(np.where((l_lcp >= j) & l_same_gram, 0, place))
            fits = np.flatnonzero((l_len >= j) & (r_len >= LENGTH - j))
            if len(fits) < 2:
                continue
            pair = r_cls[fits] * m + l_cls[fits]
            inner = np.lexsort((lead_rank[fits], pair))
            ordered = pair[inner]
            dup = fits[inner][np.r_[False, ordered[1:] == ordered[:-1]]]
            low[dup] = np.minimum(low[dup], j)
            high[dup] = np.maximum(high[dup], j)
        got = high >= 0
        has[lead[got]], lo[lead[got]], hi[lead[got]] = True, high[got], LENGTH - low[got]
    return has, lo, hi


def removed_runs(table: pa.Table, doc_bucket) -> pa.Table:
    """A gram bucket's contexts -> byte runs to remove, packed by document bucket."""
    head, body, runs = _split_contexts(table)
    if len(head):
        has, lo, hi = earlier_windows(head, body)
        out = np.empty(int(has.sum()), RUN)
        pos = head["pos"][has].astype(np.int64)
        for name in ("doc", "th", "nth"):
            out[name] = head[name][has]
        out["start"], out["end"] = pos - lo[has], pos + hi[has]
        runs = np.concatenate([runs, out])
    return _blobs(runs, doc_bucket(runs["doc"], runs["th"]))


RESULT = "doc_id long, text binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def finish(texts: pa.Table, runs: pa.Table, keep_text: bool) -> pa.Table:
    records, where = _places(_unpacked(runs, RUN), "start")
    out: list[list] = [[] for _ in range(6)]
    for doc, data, ids in _texts(texts):
        own = records[where.get(doc, slice(0, 0))]
        kept, removed, spans = data, 0, 0
        if len(own):
            delta = np.zeros(len(data) + 1, np.int64)
            np.add.at(delta, own["start"], 1)
            np.add.at(delta, own["end"], -1)
            gone = np.cumsum(delta[:-1]) > 0
            removed = int(gone.sum())
            spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        for i, doc_id in enumerate(ids):
            if i and len(data) >= LENGTH:  # a repeated row: the first has all its strings
                kept, removed, spans = b"", len(data), 1
            for column, value in zip(out, (doc_id, kept if keep_text else None, len(data), removed, spans, hashlib.sha256(kept).hexdigest()), strict=True):
                column.append(value)
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.table({x.split()[0]: pa.array(c, t) for x, c, t in zip(RESULT.split(", "), out, kinds, strict=True)})


def suffix_dedup(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """doc_id, text (what is left, as bytes), n_bytes, n_removed, n_spans, kept_sha256."""
    n = partitions_for(docs, BUCKET_BYTES)

    def doc_bucket(ids: np.ndarray, th: np.ndarray) -> np.ndarray:
        x = (ids.astype(np.int64).view(np.uint64) ^ (th.astype(np.uint64) * _MIX[1])) * _MIX[0]
        return ((x ^ (x >> np.uint64(32))) % np.uint64(n)).astype(np.int64)

    @F.pandas_udf("int")
    def bucket_column(ids: pd.Series, th: pd.Series) -> pd.Series:
        return pd.Series(doc_bucket(ids.to_numpy(np.int64), th.to_numpy(np.int64)), dtype="int32")

    texts = canonical(docs).withColumn("th", F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)))
    texts = texts.select(bucket_column(F.coalesce("doc_id", F.lit(NULL_ID)), "th").alias("bucket"), "doc_id", "th", "text").repartition(n, "bucket")
    by_doc = texts.groupBy("bucket")
    found = by_doc.applyInArrow(lambda t: locate(t, n), BLOBS).repartition(n, "bucket").groupBy("bucket").applyInArrow(lambda t: repeated(t, doc_bucket), BLOBS).repartition(n, "bucket")
    near = by_doc.cogroup(found.groupBy("bucket")).applyInArrow(lambda t, f: contexts(t, f, n), BLOBS).repartition(n, "bucket")
    runs = near.groupBy("bucket").applyInArrow(lambda t: removed_runs(t, doc_bucket), BLOBS).repartition(n, "bucket")
    return by_doc.cogroup(runs.groupBy("bucket")).applyInArrow(lambda t, r: finish(t, r, keep_text), RESULT)


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir), keep_text=False).drop("text")
