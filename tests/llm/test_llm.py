"""The corpus operators against brute force, round trips and held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

DOCS = "doc_id long, text string, row int, bucket string"
random.seed(4)
WORDS = [a + b for a in ("ka", "lo", "mi", "tu", "re", "so", "na") for b in ("", "n", "r", "lis", "do", "fe")]


def prose(n, rng=random):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    base = [prose(rng.randint(5, 120), rng) for _ in range(40)]
    passage = prose(60, rng)
    texts = [*base, base[0], base[1], base[2] + " extra", base[3].replace("ka", "Ka", 1), f"{prose(20, rng)}\n{passage}", f"{passage}\n{prose(9, rng)}", "", None, "a", "É \x00 x", "the " * 300, "The " * 200, "x" * 5000]
    return [(i * 3, t, 1, "c") for i, t in enumerate(texts)] + [(0, base[0], 1, "c"), (None, base[4], None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def print_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    s = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hs = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(docs, empty, rows):
    from curatrix.llm.simhash import simhash_components

    got = Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_components(docs).collect())
    prints = [(d, print_of(t)) for d, t, *_ in rows]
    group = list(range(len(prints)))
    for _ in prints:
        for i, (_, a) in enumerate(prints):
            for j, (_, b) in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    group[i] = group[j] = min(group[i], group[j])
    least = {g: min(d for (d, _), h in zip(prints, group) if h == g and d is not None) for g in group}
    assert got == Counter((d, f"{p:016x}", least[g]) for (d, p), g in zip(prints, group))
    assert simhash_components(empty).count() == 0


def test_shard_links_of_several_trees_lose_no_link():
    from curatrix.llm.simhash import shard_links

    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 1 << 62, 12)
    fps = np.unique(np.concatenate([seeds, *[seeds ^ (1 << int(b)) for b in rng.integers(0, 62, 30)]])).astype(np.int64)
    tree = rng.integers(0, 3, len(fps))
    a, b = [], []
    for k in range(3):
        x, y = shard_links(fps, np.full(len(fps), 7), tree == k, 4)
        a += x.tolist()
        b += y.tolist()
    parent = {int(f): int(f) for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a, b):
        parent[find(x)] = find(y)
    want = {int(f): int(f) for f in fps}
    for _ in range(6):
        for x in want:
            want[x] = min(want[int(y)] for y in fps if (x ^ int(y)).bit_count() <= 4)
    for x in want:
        for y in want:
            assert (find(x) == find(y)) == (want[x] == want[y])


def test_language_model(docs, empty, rows, monkeypatch):
    from curatrix.llm import language_model as m

    monkeypatch.setattr(m, "LOOKUP", 20)
    got = {(r["doc_id"], r["n_tokens"]): r for r in m.score_language_model(docs).collect()}
    tokens = [(d, (t or "").encode().lower().split() + [0]) for d, t, *_ in rows]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    c = Counter(x for d, t in tokens if not held(d) for x in t)
    n, v = sum(c.values()), len(c)
    for d, t in tokens:
        r = got[d, len(t)]
        assert r["held_out"] == held(d) and r["train_tokens"] == n and r["n_known"] == sum(c[x] > 0 for x in t)
        assert math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), rel_tol=1e-9)
        assert -1e9 < r["score"] < 0
    assert m.score_language_model(empty).count() == 0


def test_language_model_score_is_the_models_probability(docs, rows, monkeypatch):
    """The score again from the parameters: a softmax over all ids, then the share in the class."""
    from curatrix.llm import language_model as m

    rng, kept = np.random.default_rng(3), []

    def drawn(training, vocabulary, unigram):
        model = m.LogBilinear(unigram)
        model.q = rng.normal(0, 0.4, model.q.shape).astype(np.float32)
        kept.append((model, vocabulary))
        return model

    monkeypatch.setattr(m, "train_lbl", drawn)
    monkeypatch.setattr(m, "LOOKUP", 30)
    got = Counter((r["doc_id"], r["n_tokens"], round(r["score"], 1)) for r in m.score_language_model(docs).collect())
    (model, vocabulary), = kept
    tokens = [(d, (t or "").encode().lower().split()) for d, t, *_ in rows]
    c = Counter(w for d, t in tokens if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2 for w in t)
    one = lambda w: vocabulary.get(w) or m.class_of(w)
    inside = Counter()
    for w in c:
        if w not in vocabulary:
            inside[one(w)] += c[w] + 1
    want = Counter()
    for d, t in tokens:
        ids, total = [0, 0, *map(one, t), 0], 0.0
        for i in range(2, len(ids)):
            s = (model.r[ids[i - 1]] * model.c[0] + model.r[ids[i - 2]] * model.c[1]).astype(float) @ model.q.T + model.b
            total += (s[ids[i]] - np.log(np.exp(s - s.max()).sum()) - s.max()) / math.log(10)
        total += sum(math.log10((c[w] + 1) / (inside[one(w)] + 1)) for w in t if w not in vocabulary)
        want[d, len(t) + 1, round(total, 1)] += 1
    near = sum((got & want).values())
    assert near >= len(rows) - 2  # a rounding edge may part one or two


def test_language_model_does_not_follow_partitions(spark, docs):
    from curatrix.llm.language_model import score_language_model

    one, many = ({(r["doc_id"], r["n_tokens"]): r["score"] for r in score_language_model(docs.repartition(k)).collect()} for k in (1, 9))
    assert one.keys() == many.keys() and all(math.isclose(one[k], many[k], rel_tol=1e-6) for k in one)


def test_frequent_words_of_one_count(spark):
    from curatrix.llm.language_model import frequent_words

    counts = spark.createDataFrame([(f"w{i:03d}", 1) for i in range(50)] + [("top", 2)], "word string, c long")
    assert frequent_words(counts, 4)["word"].tolist() == ["top", "w000", "w001", "w002"]
    assert frequent_words(counts.where("c = 1"), 3)["word"].tolist() == ["w000", "w001", "w002"]


def test_log_bilinear_is_normalised():
    from curatrix.llm.language_model import VOCAB, LogBilinear

    model = LogBilinear(np.arange(1.0, VOCAB + 1))
    model.q = np.random.default_rng(0).normal(size=model.q.shape).astype(np.float32)
    a1, a2, z = model.tables()
    p = np.exp(a1[5].astype(float) + a2[9] - z[5, 9])
    assert math.isclose(p.sum(), 1.0, rel_tol=1e-4)


def removed_by_brute_force(rows):
    """Rows that share an id in the order of the operator's hash of their texts."""
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    hashed = SparkSession.active().createDataFrame(rows, "d long, t string").select("d", F.coalesce("t", F.lit("")).alias("t")).withColumn("h", F.xxhash64("t").bitwiseAND(F.lit(0xFFFFFFFF))).collect()
    seen, want = set(), Counter()
    for d, _, b in sorted((-(1 << 63) if r["d"] is None else r["d"], r["h"], r["t"].encode()) for r in hashed):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                gone[s : s + 100] = True
            seen.add(b[s : s + 100])
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        want[None if d == -(1 << 63) else d, len(b), int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum()), hashlib.sha256(kept).hexdigest()] += 1
    return want


def test_suffix_dedup(docs, empty, rows):
    from curatrix.llm.suffix_dedup import suffix_dedup

    want = removed_by_brute_force([r[:2] for r in rows])
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup(docs).collect())
    assert got == want
    assert suffix_dedup(empty).count() == 0


def test_suffix_dedup_of_periods_and_rows_of_one_id(spark):
    from curatrix.llm.suffix_dedup import anchors, suffix_dedup

    rng = random.Random(17)
    passage = prose(60, rng)
    texts = ["x" * 700, "y" + "x" * 500, "abc" * 200, "zabc" * 3 + "abc" * 90 + passage, passage + "abcd" * 120 + passage, "ab" * 49, "ab" * 50, "ab" * 51 + "c", prose(40, rng) + " - " * 80]
    rows = [(None, t) for t in texts] + [(7, t) for t in texts] + [(7, prose(30, rng) + passage) for _ in range(20)] + [(7, texts[0])] * 3 + [(None, "short")] * 3
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == removed_by_brute_force(rows)
    assert len(anchors(b"x" * 2_000_000)[1]) < 300


def test_suffix_dedup_of_many_rows_without_an_id(spark):
    from pyspark.sql import functions as F

    from curatrix.llm.suffix_dedup import suffix_dedup

    rows = spark.range(70_000).select(F.lit(None).cast("long").alias("doc_id"), F.format_string("row %d", "id").alias("text"))
    assert suffix_dedup(rows).agg(F.sum("n_bytes"), F.sum("n_removed")).first()[1] == 0


@pytest.mark.parametrize("shallow", [0, 8, 40])
def test_deep_shallow_sorts(shallow):
    from curatrix.llm.suffix_sort import deep_shallow, neighbour_lcp

    rng = random.Random(2)
    strings = [bytes(rng.choice(b"ab\x00") for _ in range(rng.choice((0, 3, 20, 60)))) for _ in range(300)] + [b"abab" * 14 + bytes([i % 3]) for i in range(9)]
    matrix, lengths = np.zeros((len(strings), 64), np.uint8), np.array([len(s) for s in strings])
    for i, s in enumerate(strings):
        matrix[i, : len(s)] = np.frombuffer(s, np.uint8)
    group = np.array([i % 4 for i in range(len(strings))])
    order = deep_shallow(matrix, lengths, group, shallow)
    assert sorted(order.tolist()) == list(range(len(strings)))
    padded = [(int(group[i]), matrix[i].tobytes()) for i in order]
    assert padded == sorted(padded)
    lcp = neighbour_lcp(matrix, lengths, group, order)
    assert all(lcp[i] == 0 or strings[order[i]][: lcp[i]] == strings[order[i - 1]][: lcp[i]] for i in range(1, len(order)))


def test_packing(docs, empty, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    from curatrix.llm.packing import best_fit_packing

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = best_fit_packing(docs, max_tokens=256).collect()
    want = Counter()
    for d, t, *_ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids), 256), len(ids)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[d, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert best_fit_packing(empty).count() == 0


def test_special_token_text_keeps_the_tokenizer_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    from curatrix.llm.packing import encoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    for text in ("a <|endoftext|> b", "I'll  go\n\n now 12é ", " ", "\t\n x", "日本 'S"):
        assert list(encoder(path)(text)) == tok.encode(text, add_special_tokens=False).ids


def test_mpeg_round_trip_and_resync(docs, empty, rows):
    from curatrix.llm import mpeg

    raw = prose(900).encode()
    media = mpeg.write_mpeg(mpeg.padded(raw), len(raw))
    parsed = mpeg.parse_mpeg(media)
    assert mpeg.read_payload(media, parsed) == mpeg.padded(raw)
    assert parsed.bad_crc == 0 and parsed.table["frames"] == len(parsed.offsets) and parsed.tags["TEXT_BYTES"] == str(len(raw))
    assert parsed.duration == mpeg.Fraction(1152 * len(parsed.offsets), 48000)
    damaged = media[: parsed.offsets[1]] + b"junk\xff\xfb" + media[parsed.offsets[1] :]
    again = mpeg.parse_mpeg(damaged)
    assert len(again.offsets) == len(parsed.offsets) and again.skipped == 6 and mpeg.read_payload(damaged, again) == mpeg.padded(raw)
    broken = bytearray(media)
    broken[parsed.offsets[2] + 10] ^= 1
    assert mpeg.parse_mpeg(bytes(broken)).bad_crc == 1
    assert mpeg.parse_mpeg(b"").offsets == [] and mpeg.parse_mpeg(b"\xff" * 50).duration == 0
    out = mpeg.media_facts(mpeg.media_column(docs)).collect()
    assert mpeg.media_facts(mpeg.media_column(empty)).count() == 0
    got = Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in out)
    want = Counter()
    for d, t, *_ in rows:
        raw = (t or "").encode()
        pay = raw + b"\xff" * (576 - len(raw) % 576 if len(raw) % 576 or not raw else 0)
        want[d, len(raw), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-32:])] += 1
    assert got == want
    files = {(r["doc_id"], r["n_bytes"]): r["media"] for r in mpeg.media_column(docs).collect()}
    for r in out:
        media = files[r["doc_id"], r["n_bytes"]]
        assert r["media_bytes"] == len(media) and r["media_sha256"] == hashlib.sha256(media).hexdigest()
        assert len(r["seek_offsets"]) == r["payload_bytes"] // 576 and all(media[o : o + 2] == b"\xff\xfa" for o in r["seek_offsets"])
        assert "table_holds=True" in r["feature"] and r["bad_crc"] == 0


def crc_bits(bits):
    c = 0xFFFF
    for b in bits:
        c = ((c << 1) ^ (0x8005 if (c >> 15) ^ b else 0)) & 0xFFFF
    return c


def test_mpeg_checksums_of_layers_one_and_two():
    from curatrix.llm import mpeg

    rng = random.Random(4)
    for head, bits in ((bytes((0xFF, 0xFE, 0x80, 0x00)), 256), (bytes((0xFF, 0xFE, 0x80, 0xC0)), 128), (bytes((0xFF, 0xFE, 0x80, 0x50)), 4 * (16 + 24))):
        h = mpeg.parse_header(head)
        body = bytes(rng.randrange(256) for _ in range(h.size - 6))
        covered = [b >> (7 - i) & 1 for b in head[2:4] + body for i in range(8)][: 16 + bits]
        frame = head + crc_bits(covered).to_bytes(2, "big") + body
        assert h.layer == 1 and mpeg.covered_bits(frame, 0, h) == bits and mpeg.parse_mpeg(frame * 3).bad_crc == 0
        assert mpeg.parse_mpeg(frame[:6] + bytes((frame[6] ^ 1,)) + frame[7:] + frame).bad_crc == 1
    head = bytes((0xFF, 0xFC, 0xA4, 0x00))  # Layer II, 192 kbit/s, 48 kHz, stereo: table of 27 subbands
    h = mpeg.parse_header(head)
    widths = [4] * 11 + [3] * 12 + [2] * 4
    zero = bytes(h.size - 6)
    assert h.layer == 2 and mpeg.covered_bits(head + b"\0\0" + zero, 0, h) == 2 * sum(widths)
    full = b"\xff" * (h.size - 6)
    n = 2 * sum(widths) + 2 * 2 * 27
    frame = head + crc_bits([b >> (7 - i) & 1 for b in head[2:4] + full for i in range(8)][: 16 + n]).to_bytes(2, "big") + full
    assert mpeg.covered_bits(frame, 0, h) == n and mpeg.frame_crc(frame, 0, h) == int.from_bytes(frame[4:6], "big")


def test_vbri_table_is_read_and_held_against_frames():
    from curatrix.llm import mpeg

    raw = prose(900).encode()
    media = mpeg.write_mpeg(mpeg.padded(raw), len(raw))
    parsed = mpeg.parse_mpeg(media)
    size, first, n = mpeg._FRAME, parsed.table_at, len(parsed.offsets)
    seek = [size * (1 + 2) if not k else size * 2 for k in range((n - 1) // 2)]
    vbri = mpeg._START + b"VBRI" + bytes(6) + mpeg.struct.pack(">IIHHHH", (n + 1) * size, n, len(seek), 1, 2, 2) + b"".join(mpeg.struct.pack(">H", x) for x in seek)
    at = first + 36
    data = bytearray(media)
    data[first + 4 : first + size] = bytes(size - 4)
    data[at : at + len(vbri) - len(mpeg._START)] = vbri[len(mpeg._START) :]
    again = mpeg.parse_mpeg(bytes(data))
    assert again.table["kind"] == "VBRI" and again.table["frames"] == n and again.offsets == parsed.offsets
    assert mpeg.seek_table_holds(again, len(data)) is True
    again.table["seek"][1] += 1
    assert mpeg.seek_table_holds(again, len(data)) is False


def test_line_dedup(spark, empty):
    from curatrix.llm.lines import dedup_lines

    rng = random.Random(3)
    rows = [(i, f"Page {i} of 77 visited on 2020-01-{i}\n{prose(12, rng)}\n\n{prose(15, rng)}", 1, "c") for i in range(12)]
    copies = [(100 + i, "whole copy line one here\nwhole copy line two there", 1, "c") for i in range(8)]
    out = {r["doc_id"]: r for r in dedup_lines(spark.createDataFrame([*rows, *copies, (200, None, 1, "c"), (201, "", 1, "c")], DOCS)).collect()}
    for i, text, *_ in rows:
        assert out[i]["text"] == text.split("\n", 1)[1]
    assert all(out[i]["text"] == t for i, t, *_ in copies) and out[200]["text"] is None and out[201]["text"] == "" and out[0]["bucket"] == "c"
    assert dedup_lines(empty).count() == 0


def words(n, rng):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_line_dedup_of_passages_copies_and_long_lines(spark):
    from curatrix.llm.lines import dedup_lines

    rng, rows, want = random.Random(21), [], {}

    def add(text, kept):
        want[len(rows)] = kept
        rows.append((len(rows), text, 1, "c"))

    for shared, own in ((2, 1), (3, 3), (8, 5), (5, 10)):  # passages of several lines
        passage = "\n".join(words(8, rng) for _ in range(shared))
        for _ in range(40):
            body = "\n".join(words(12 * shared // own + 4, rng) for _ in range(own))
            add(f"{passage}\n{body}", body)
    hot = words(8, rng)  # in unlike documents and in one large group of copies
    for body in [words(30, rng) for _ in range(10)] + [words(30, rng)] * 60:
        add(f"{hot}\n{body}", body)
    long, short = words(55, rng), words(9, rng)  # in two unlike documents
    for line in (long, short):
        for body in (words(60, rng), words(60, rng)):
            add(f"{line}\n{body}", body if line == long else f"{line}\n{body}")
    base = words(300, rng).split()  # near copies and whole copies stay
    for k in range(30):
        base[10 * k] = f"changed{k}"
        if k < 6:
            text = " ".join(base[:150]) + "\n" + " ".join(base[150:])
            add(text, text)
    out = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert out == want


def test_templates_generalise():
    from curatrix.llm.lines import cluster_leaf

    lines = sorted(f"user {name} logged in from the far host today ok" for name in ("ann", "bob", "cyd"))
    assert len(set(cluster_leaf(lines))) == 1 and len(set(cluster_leaf(sorted([lines[0], "user ann has no other word in common with it"])))) == 2


def labelled(spark, bad, n=240):
    rng = random.Random(6)
    docs = [(i, prose(40, rng) if i % 3 else bad(rng), 1, "c") for i in range(n)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(n)] + [(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")


def test_toxicity(spark, empty):
    from curatrix.llm.toxicity import Matcher, fold, score_toxicity

    docs, labels = labelled(spark, lambda r: f"{prose(20, r)} {r.choice(('vilework', 'v1lework', 'VILEWORK!!'))} {prose(20, r)}")
    out = {r["doc_id"]: r for r in score_toxicity(docs, labels).collect()}
    assert all((r["predicted"] == 1) == (i % 3 == 0) for i, r in out.items()) and all(0 <= r["score"] <= 1 for r in out.values())
    assert fold("Vіl3 ＡB") == "vile ab" and len(fold("İx")) == 2
    assert [m[:2] for m in Matcher((("=scum", 2.0),), ("pond scum",)).matches("scum, scumble and pond scum")] == [(0, 4)]
    assert score_toxicity(empty, labels).count() == 0 and {r["score"] < 0.01 for r in score_toxicity(docs, labels.limit(0)).collect()} == {True}


def test_quality(spark, empty):
    from curatrix.llm.quality import estimate_prior, score_quality

    docs, labels = labelled(spark, lambda r: " ".join([r.choice(WORDS)] * 40), 600)
    out = {r["doc_id"]: r for r in score_quality(docs, labels).collect()}
    held = [(r["predicted"] == 1) == (i % 3 != 0) for i, r in out.items() if r["held_out"]]
    assert sum(held) / len(held) > 0.95
    rng = np.random.default_rng(0)
    p, u = rng.normal(3, 1, 4000), np.r_[rng.normal(3, 1, 2800), rng.normal(-3, 1, 1200)]
    assert abs(estimate_prior(*(np.histogram(v, np.linspace(-9, 9, 400))[0] for v in (p, u))) - 0.7) < 0.06
    assert score_quality(empty, labels).count() == 0 and {r["score"] for r in score_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_pii_base_spans():
    from curatrix.llm.pii import base_spans, luhn

    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    kinds, rng = ("email", "ip", "card", "phone"), random.Random(8)
    texts = ["".join(rng.choice("ab@.1234 -+()5") for _ in range(200)) for _ in range(200)] + ["x 4111 1111 1111 1111 y", "1.2.3.4.5.6.7.8 300.1.1.1", "a@b@c.d.e@f.g", "+1 (614) 555-8001 +12", "٣٤.1.1.1.1"]
    for text in texts:
        want = []
        for k, p in enumerate(patterns):
            for m in re.finditer(p, text):
                d = re.sub(r"[^0-9]", "", m[0])
                if (k == 1 and any(int(x) > 255 for x in m[0].split("."))) or (k == 2 and not (14 <= len(d) <= 19 and luhn(d))) or (k == 3 and not 10 <= len(d) <= 15):
                    continue
                want.append((m.start(), k, m.end()))
        assert base_spans(text) == [(s, e, kinds[k]) for s, k, e in sorted(want)]


def test_pii_adds_spans(spark, docs, empty):
    from curatrix.llm.pii import detect_pii

    keyed = spark.createDataFrame([(i, f"{prose(5)} token = ghp_{hashlib.sha1(str(i).encode()).hexdigest()} {prose(4)}", 1, "c") for i in range(30)] + [(99, None, 1, "c")], DOCS)
    out = {r["doc_id"]: r for r in detect_pii(keyed).collect()}
    assert sum(len(r["added"]) == 1 for r in out.values()) == 30 and out[99]["added"] == []
    assert detect_pii(docs).count() == docs.count() and detect_pii(empty).count() == 0


def test_pii_query_counts_its_spans(spark, tmp_path):
    from curatrix.llm.pii import base_spans, op8_pii

    rng = random.Random(2)
    long_key = "".join(rng.choice("abcXYZ019") for _ in range(400))
    texts = [f"token: sk-{long_key} end", "ship to 12 Maple Hill Street now", "mail a.b@c.de or 10.0.0.1", None, "", "x " * 50_000 + "a@b.cd"] + [f"key = ghp_{hashlib.sha1(str(i).encode()).hexdigest()}" for i in range(20)]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in op8_pii(spark, str(tmp_path)).collect()}
    assert len(out) == len(texts) and out[0]["n_secret"] == 1 and out[5]["n_email"] == 1
    for i, t in enumerate(texts):
        base = ",".join(f"{k}:{s}:{e}" for s, e, k in base_spans(t or ""))
        r = out[i]
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and set(filter(None, base.split(","))) <= set(r["spans"].split(","))
        assert r["n_spans"] == len([s for s in r["spans"].split(",") if s]) == sum(r[f"n_{k}"] for k in ("email", "ip", "card", "phone", "secret", "number", "address"))


def test_decontamination(spark, docs, empty):
    from curatrix.llm.decontaminate import benchmark_overlap, drop_contaminated

    rng = random.Random(5)
    items = [prose(30, rng), prose(22, rng), "only three words", "", None]
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)] + [(0, items[0], 1)], "item_id long, text string, row int")
    w = items[1].split()
    texts = [f"{prose(9, rng)} {items[0].upper()} {prose(9, rng)}", " ".join(["zz", *w[:-1]]), " ".join(w[:11]), "say only three words now", prose(50, rng), "", None, items[0]]
    out = {r["doc_id"]: r for r in benchmark_overlap(spark.createDataFrame([(i, t, 1, "c") for i, t in enumerate(texts)], DOCS), bench).collect()}
    assert {i: r["item_ids"] for i, r in out.items()} == {0: [0], 1: [1], 2: [], 3: [2], 4: [], 5: [], 6: [], 7: [0]}
    assert out[0]["best_similarity"] == 1.0
    assert benchmark_overlap(empty, bench).count() == 0 and benchmark_overlap(docs, bench.limit(0)).where("contaminated").count() == 0
    assert drop_contaminated(docs, bench).columns == docs.columns


def test_pipeline_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(1)
    rows = [(i, prose(60, rng), "en", "s", 1) for i in range(60)] + [(70, "vilework " + prose(30, rng), "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, rows[7][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.collect()} == {r[0] for r in rows} - {7}


def test_near_dedup_keeps_unlike_rows_of_one_id(spark):
    from curatrix.llm.near_copies import keep_representatives

    a, b, c = (words(60, random.Random(i)) for i in (1, 2, 3))
    rows = [(1, a), (1, b), (1, a), (None, a), (None, c), (None, c), (2, c + " more"), (3, None), (4, "")]
    kept = sorted(((r["doc_id"], r["text"]) for r in keep_representatives(spark.createDataFrame([(d, t, 1, "x") for d, t in rows], DOCS)).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (2, c + " more"), (3, None)], key=str)


def shingles_of(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_copy_rows():
    """Texts and copies with words replaced at even places, 0.7 to 0.97 similar; a shared opening."""
    rng, rows = random.Random(12), []
    opening = prose(30, rng)
    for k in range(60):
        words = (opening + " " + prose(rng.choice((12, 60, 150, 400)), rng) if k % 3 == 0 else prose(rng.choice((12, 60, 150, 400)), rng)).split()
        rows.append((10 * k, " ".join(words)))
        for j in range(1, 4):
            changed, n = list(words), rng.randint(1, max(1, len(words) // 30))
            for place in rng.sample(range(len(words)), n):
                changed[place] = f"new{k}x{j}"
            rows.append((10 * k + j, " ".join(changed)))
    return rows


def test_near_copies_of_similarity_08_go(spark, empty):
    from curatrix.llm.near_copies import keep_representatives

    rows = [*near_copy_rows(), (2000, ""), (2001, None), (2002, "three words only"), (2003, "Three  words only")]
    sets = [shingles_of(t) for _, t in rows]
    group = list(range(len(rows)))
    near = [(i, j) for i in range(len(rows)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8]
    assert sum(jaccard(sets[i], sets[j]) < 0.9 for i, j in near) > 30
    for _ in range(8):
        for i, j in near:
            group[i] = group[j] = min(group[i], group[j])
    docs = spark.createDataFrame([(d, t, 1, "c") for d, t in rows], DOCS)
    kept = keep_representatives(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({rows[g][0] for g in group})
    assert keep_representatives(empty).count() == 0
