"""LM scoring: a log-bilinear neural model trained with noise-contrastive estimation.

Tokens are lower-cased words and one end a text. The model predicts one of VOCAB ids (the
end, the most frequent words, and classes of all other words by beginning and ending) from
the two ids before it: the prediction vector is the sum of position-weighted context
vectors, its product with an id's vector plus a bias is the id's score. Noise-contrastive
estimation (shared noise of each batch, drawn from the unigram distribution, Adagrad) runs
over all training text. Texts are dealt by a hash of id and text into shards of about
SHARD_TOKENS tokens, whatever files they lie in, and each shard's texts into ROUNDS rounds.
In a round every shard learns from its texts of that round, starting from the average of all
shards' parameters after the round before, weighted by tokens and aggregated in Spark by
row. So scores follow the rows and not how files are split. Normalised log-probabilities of
all contexts come from one batched matrix product, as exp(a + b) sums to a product of
exponentials. A word inside its class has its add-one share of the class, where one unseen
word a class has a share too, so all probabilities of a context sum to one.

Counts cover the whole training corpus and stay in a table. The most frequent LOOKUP words
travel with the scorer; other words of a text are joined with the table by word.

Defined results: null and empty texts are one end token; a null id is in the fold of the
empty string; repeated rows count and score as rows of their own; texts of any length are
read whole; words that tie in count are taken in the order of their bytes; with no training
rows all counts are 0 and the model is uniform; an empty table gives no rows; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import bucket_of, by_texts, canonical, documents, fold_column, materialize

FOLDS, HELD_OUT = 7, 2
WORDS, CLASSES, DIM = 768, 255, 16
VOCAB = 1 + WORDS + CLASSES
#: Words whose counts travel with the scorer, at most.
LOOKUP = 1 << 17
BATCH, NOISE, RATE, MIN_STEPS = 1024, 48, 0.15, 1500
#: Training tokens of a shard, about, and rounds of averaging.
SHARD_TOKENS, ROUNDS = 4_000_000, 4
#: Distinct words that a counting task holds before it passes them on.
HELD_WORDS = 200_000
#: Texts that a scoring task turns into ids together.
TEXTS = 128


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def class_of(word: bytes) -> int:
    """The id of a word outside the vocabulary: by its first three bytes and its last."""
    tail = word[-1:]
    return 1 + WORDS + zlib.crc32(word[:3] + b"\0" + (b"" if tail.isalpha() or tail >= b"\x80" else tail)) % CLASSES


class WordIds(dict):
    """word -> id; words outside the vocabulary are remembered up to LOOKUP."""

    def __missing__(self, word: bytes) -> int:
        k = class_of(word)
        if len(self) < LOOKUP:
            self[word] = k
        return k


class Places(dict):
    """word -> place in the lookup, -1 without one."""

    def __missing__(self, word: bytes) -> int:
        return -1


def count_words(training: DataFrame) -> DataFrame:
    """(word, c) over all training texts, ends not included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(seen):
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"])

        seen: Counter = Counter()
        for batch in by_texts(batches):
            for text in batch[0].to_pylist():
                seen.update(words_of(text))
                if len(seen) > HELD_WORDS:
                    yield flush(seen)
                    seen.clear()
        yield flush(seen)

    return training.select("text").mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame, most: int = LOOKUP):
    """(word, c) of the ``most`` most frequent words, by count and then by word. Only these
    reach the driver: all above the least count that fits, and of the next count the first."""
    least, n, tie = None, 0, None
    for row in counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).toLocalIterator():
        if n + row["n"] > most:
            tie = row["c"]
            break
        n += row["n"]
        least = row["c"]
    rows = counts.where(F.col("c") >= least) if least is not None else counts.limit(0)
    if tie is not None and n < most:
        rows = rows.unionByName(counts.where(F.col("c") == tie).orderBy("word").limit(most - n))
    return rows.toPandas().sort_values(["c", "word"], ascending=[False, True], ignore_index=True)


def _class_totals(counts: DataFrame, vocabulary: dict[bytes, int]) -> np.ndarray:
    """[class, (sum of c, words)] over the words outside the vocabulary."""
    share = counts.sparkSession.sparkContext.broadcast(vocabulary)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = share.value, np.zeros((CLASSES, 2), np.int64)
        for batch in batches:
            words = batch[0].cast(pa.binary()).to_pylist()
            ids = np.array([known.get(w, 0) or class_of(w) for w in words], np.int64) - (1 + WORDS)
            out, c = ids >= 0, batch[1].to_numpy()
            sums[:, 0] += np.bincount(ids[out], c[out], CLASSES).astype(np.int64)
            sums[:, 1] += np.bincount(ids[out], minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(range(CLASSES), pa.int32()), pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["k", "c", "n"])

    sums = np.zeros((CLASSES, 2), np.int64)
    for row in counts.select("word", "c").mapInArrow(total, "k int, c long, n long").groupBy("k").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect():
        sums[row["k"]] = row["c"], row["n"]
    return sums


class LogBilinear:
    """Parameters: context vectors r, position weights c, target vectors q, biases b."""

    def __init__(self, unigram: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.noise = (unigram / unigram.sum()).astype(np.float64)
        self.r = rng.normal(0, 0.3, (len(unigram), DIM)).astype(np.float32)
        self.c = np.array([[1.0] * DIM, [0.7] * DIM], np.float32)
        self.q = np.zeros((len(unigram), DIM), np.float32)
        self.b = np.log(self.noise).astype(np.float32)

    def parameters(self) -> tuple[np.ndarray, ...]:
        return self.r, self.q, self.b[:, None], self.c

    def pack(self, state: list[np.ndarray]) -> np.ndarray:
        """A row for each id, and one with the position weights: parameters, then the sums of
        squared gradients that scale their steps."""
        body = np.column_stack([self.r, self.q, self.b, *state[:3]])
        last = np.concatenate([self.c.ravel(), [0.0], state[3].ravel(), [0.0]])
        return np.concatenate([body, last[None]]).astype(np.float64)

    def unpack(self, rows: np.ndarray) -> list[np.ndarray]:
        body, last, half = rows[:-1], rows[-1], 2 * DIM + 1
        self.r, self.q, self.b = (np.ascontiguousarray(x, np.float32) for x in (body[:, :DIM], body[:, DIM : 2 * DIM], body[:, 2 * DIM]))
        self.c = last[: 2 * DIM].reshape(2, DIM).astype(np.float32)
        return [np.ascontiguousarray(x, np.float32) for x in (body[:, half : half + DIM], body[:, half + DIM : half + 2 * DIM], body[:, [-1]], last[half:-1].reshape(2, DIM))]

    def fresh_state(self) -> list[np.ndarray]:
        return [np.full_like(p, 1e-4) for p in self.parameters()]

    def train(self, w2: np.ndarray, w1: np.ndarray, w: np.ndarray, steps: int, rng: np.random.Generator, state: list[np.ndarray]) -> None:
        """Noise-contrastive steps over the positions, in a random order each time round.
        Only the rows of a step's ids have gradients, so only these are touched."""
        n, cum, log_kq = len(w), np.cumsum(self.noise), np.log(NOISE * self.noise).astype(np.float32)
        order, at = rng.permutation(n).astype(np.int32), 0
        np.seterr(over="ignore")
        for _ in range(steps):
            if at >= n:
                order, at = rng.permutation(n).astype(np.int32), 0
            pick = order[at : at + BATCH]
            at += BATCH
            a, b, y = w1[pick], w2[pick], w[pick]
            noise = np.minimum(np.searchsorted(cum, rng.random(NOISE)), len(cum) - 1).astype(y.dtype)
            ra, rb = self.r[a], self.r[b]
            h = ra * self.c[0] + rb * self.c[1]
            qy, qn = self.q[y], self.q[noise]
            real = np.einsum("ij,ij->i", h, qy) + (self.b[y] - log_kq[y])
            fake = h @ qn.T + (self.b[noise] - log_kq[noise])
            gr = 1 / (1 + np.exp(real))  # 1 - P(data | real); an overflow means 0
            np.negative(fake, out=fake)
            np.exp(fake, out=fake)
            fake += 1
            gf = np.divide(-1, fake, out=fake)
            dh = gr[:, None] * qy + gf @ qn
            ga, gb = dh * self.c[0], dh * self.c[1]
            gc = np.stack([(dh * ra).sum(0), (dh * rb).sum(0)]) / 50
            ids, dr = _summed(np.concatenate([a, b]), np.concatenate([ga, gb]))
            _step(self.r, state[0], ids, dr / len(pick))
            ids, dq = _summed(np.concatenate([y, noise]), np.column_stack([np.concatenate([gr[:, None] * h, gf.T @ h]), np.concatenate([gr, gf.sum(0)])]))
            dq /= len(pick)
            _step(self.q, state[1], ids, dq[:, :DIM])
            _step(self.b[:, None], state[2], ids, dq[:, DIM:])
            _step(self.c, state[3], slice(None), gc / len(pick))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """a1[w1, w], a2[w2, w] and log z[w1, w2], with the bias in a1."""
        a1 = (self.r * self.c[0]) @ self.q.T + self.b
        a2 = (self.r * self.c[1]) @ self.q.T
        m1, m2 = a1.max(1), a2.max(1)
        z = np.exp((a1 - m1[:, None]).astype(np.float64)) @ np.exp((a2 - m2[:, None]).astype(np.float64)).T
        return a1, a2, (np.log(np.maximum(z, 1e-300)) + m1[:, None] + m2[None]).astype(np.float32)


def _summed(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids and the sums of their rows."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    return ids[first], np.add.reduceat(rows[order], first, axis=0)


def _step(p: np.ndarray, state: np.ndarray, ids, g: np.ndarray) -> None:
    """An Adagrad step uphill on some rows."""
    new = state[ids] + g * g
    state[ids] = new
    p[ids] += RATE * g / (np.sqrt(new) + np.float32(1e-6))


SHARD = "round int, shard long, h long, ids binary"


def shard_ids(training: DataFrame, vocabulary: dict[bytes, int], shards: int) -> DataFrame:
    """The training texts as 16-bit ids, dealt by a hash of id and text."""
    share = training.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordIds(share.value)
        for batch in by_texts(batches):
            ids = [np.fromiter(map(known.__getitem__, words_of(t)), np.uint16).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["round"], batch["shard"], batch["h"], pa.array(ids, pa.binary())], names=["round", "shard", "h", "ids"])

    h = F.xxhash64("doc_id", "text")
    dealt = training.select(F.pmod(F.shiftright(h, 40), F.lit(ROUNDS)).cast("int").alias("round"), F.pmod(h, F.lit(shards)).alias("shard"), h.alias("h"), "text")
    return materialize(dealt.mapInArrow(run, SHARD).repartition("round", "shard"), "lm-ids")


def learn_shard(model: LogBilinear, state: list[np.ndarray], texts: list[bytes], seed: int) -> int:
    """A round's steps over a shard's texts, which come in a fixed order; the tokens there were."""
    parts = []
    for ids in texts:  # each text starts with two ends that are context only, and ends with one
        body = np.frombuffer(ids, np.uint16)
        parts.append(np.concatenate([np.array([0xFFFF, 0xFFFF], np.uint16), body, np.zeros(1, np.uint16)]))
    ids = np.concatenate(parts)
    at = np.flatnonzero(ids != 0xFFFF).astype(np.int32)
    clean = np.where(ids == 0xFFFF, 0, ids).astype(np.int16)
    model.train(clean[at - 2], clean[at - 1], clean[at], max(-(-len(at) // BATCH), MIN_STEPS // ROUNDS), np.random.default_rng(seed), state)
    return len(at)


def train_lbl(training: DataFrame, vocabulary: dict[bytes, int], unigram: np.ndarray) -> LogBilinear:
    """ROUNDS rounds of training in shards and averaging."""
    model = LogBilinear(unigram)
    state = model.fresh_state()
    shards = max(1, round((unigram.sum() - len(unigram)) / SHARD_TOKENS))
    dealt = shard_ids(training, vocabulary, shards)
    columns = [f"v{i}" for i in range(2 * (2 * DIM + 1))]
    schema = ", ".join(["k int", "n double", *[f"{c} double" for c in columns]])

    def learned(table: pa.Table, share, number: int) -> pa.Table:
        counts, rows = share.value
        local = LogBilinear(counts)
        own = local.unpack(rows)
        table = table.sort_by([("h", "ascending"), ("ids", "ascending")])
        n = learn_shard(local, own, table["ids"].to_pylist(), 1000 * number + 3)
        packed = local.pack(own) * n
        return pa.table({"k": pa.array(range(len(packed)), pa.int32()), "n": pa.array([float(n)] * len(packed)), **{c: pa.array(packed[:, i]) for i, c in enumerate(columns)}})

    def round_of(number: int):
        share = training.sparkSession.sparkContext.broadcast((unigram, model.pack(state)))
        return lambda table: learned(table, share, number)

    for number in range(ROUNDS):
        trained = dealt.where(F.col("round") == number).groupBy("shard").applyInArrow(round_of(number), schema)
        rows = trained.groupBy("k").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns]).toPandas().sort_values("k")  # one row for each id
        if len(rows):
            state = model.unpack(rows[columns].to_numpy() / rows["n"].to_numpy()[:, None])
    return model


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<struct<word:string,n:long>>"


def score_language_model(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    texts = canonical(docs)
    training = texts.where(fold_column(F.col("doc_id"), FOLDS) != HELD_OUT)
    counts = materialize(count_words(training), "word-counts")
    n_docs = training.count()
    words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, kinds = words + n_docs, distinct + (n_docs > 0)
    log_base = math.log10(total + kinds + 1)
    top = frequent_words(counts)
    keys = [w.encode("utf-8", "surrogatepass") for w in top["word"]]
    vocabulary = {w: i + 1 for i, w in enumerate(keys[:WORDS])}
    classes = _class_totals(counts, vocabulary)
    unigram = np.ones(VOCAB)
    unigram[0] += n_docs
    unigram[1 : 1 + len(vocabulary)] += top["c"].to_numpy()[:WORDS]
    unigram[1 + WORDS :] += classes[:, 0]
    model = train_lbl(training, vocabulary, unigram)
    log_class = np.log10(classes.sum(1) + 1.0)  # c + 1 of each word, and 1 of an unseen one
    ids = np.array([vocabulary.get(w) or class_of(w) for w in keys], np.int64)
    logs = np.log10(top["c"].to_numpy(np.float64) + 1)
    within = np.where(ids > WORDS, logs - log_class[np.maximum(ids - 1 - WORDS, 0)], 0.0) if len(ids) else np.zeros(0)
    end_log = math.log10(n_docs + 1) - log_base
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast((keys, ids, logs - log_base, within, log_class, model.tables()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids, base_of, within_of, log_class, (a1, a2, log_z) = share.value
        index = Places((w, i) for i, w in enumerate(words))
        # One more row for words outside the lookup; their ids are set apart.
        ids, both = np.r_[ids, 0], np.column_stack([np.r_[base_of, 0.0], np.r_[within_of, 0.0]])
        a1, a2, log_z, ln10 = a1.ravel(), a2.ravel(), log_z.ravel(), math.log(10)
        pair = pa.struct([("word", pa.string()), ("n", pa.int64())])
        for batch in by_texts(batches, TEXTS):
            docs = batch[0].to_pylist()
            tokens = [words_of(t) for t in batch[1].to_pylist()]
            sizes = np.array([len(t) for t in tokens], np.int64)
            owner = np.repeat(np.arange(len(tokens)), sizes)
            at = np.fromiter(map(index.__getitem__, itertools.chain.from_iterable(tokens)), np.int64, int(sizes.sum()))
            missing = np.flatnonzero(at < 0)
            known = np.bincount(owner[at >= 0], minlength=len(tokens))
            names: dict[bytes, int] = {}
            flat = list(itertools.chain.from_iterable(tokens)) if len(missing) else []
            named = np.array([names.setdefault(flat[i], len(names)) for i in missing.tolist()], np.int64)
            kind = np.array([class_of(w) for w in names], np.int64)
            pair_of, times = np.unique(owner[missing] * (len(names) + 1) + named, return_counts=True)
            rare_owner, rare_name = np.divmod(pair_of, len(names) + 1)
            # Two ends before each text, one behind it.
            begin = np.cumsum(sizes + 3) - (sizes + 3)
            place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes) + 2
            seq = np.zeros(int((sizes + 3).sum()), np.int64)
            seq[place] = ids[at]
            seq[place[missing]] = kind[named]
            asked = np.delete(np.arange(len(seq)), np.concatenate([begin, begin + 1]))
            w2, w1, w = seq[asked - 2], seq[asked - 1], seq[asked]
            logs = a1[w1 * VOCAB + w].astype(np.float64) + a2[w2 * VOCAB + w] - log_z[w1 * VOCAB + w2]
            model = np.add.reduceat(logs, np.cumsum(sizes + 1) - (sizes + 1)) / ln10
            sums = np.stack([np.bincount(owner, both[at, i], len(tokens)) for i in range(2)])
            gone = np.bincount(rare_owner, times, len(tokens))
            behind = np.bincount(rare_owner, times * log_class[kind[rare_name] - 1 - WORDS], len(tokens))
            rare = pa.array(list(names), pa.binary()).cast(pa.string()).take(pa.array(rare_name))
            ends = np.searchsorted(rare_owner, np.arange(len(tokens) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([rare, pa.array(times.astype(np.int64))], fields=list(pair)))
            held = [bucket_of(d, FOLDS) == HELD_OUT for d in docs]
            columns = [pa.array(docs, pa.int64()), pa.array(held), pa.array(sizes + 1), pa.array(known + int(n_docs > 0)), pa.array(sums[0] - log_base * gone + end_log), pa.array(model + sums[1] - behind), lists]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCORED.split(", ")])

    parts = materialize(texts.mapInArrow(score, SCORED), "lm-parts").withColumn("row", F.monotonically_increasing_id())
    rare = parts.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n").join(counts, "word")
    seen = rare.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("log"), F.sum("n").alias("known"))
    log, known = F.coalesce("log", F.lit(0.0)), F.coalesce("known", F.lit(0))
    return parts.drop("rare").join(seen, "row", "left").select("doc_id", "held_out", "n_tokens", (F.col("n_known") + known).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + log).alias("base_score"), (F.col("score") + log).alias("score"))


def op2_language_model(spark, sf_dir: str) -> DataFrame:
    return score_language_model(documents(spark, sf_dir))
