"""Best-fit packing: bounded-space online best-fit over tokenised documents.

Documents become ids of a public byte-level BPE plus an end id; longer ones are cut into
pieces of ``max_tokens`` (the first piece takes the remainder). Pieces then go, in an order
fixed by a hash of their place, through a packer that keeps a fixed number of open bins in
a bitset keyed by free space: a piece goes to the open bin with the least sufficient room,
and when one bin too many is open the fullest closes.

Defined results: null text packs as the empty text (its end id only); repeated rows are
packed once per row; texts of any length are read whole and give as many pieces as they need;
pieces whose hashes tie go by document and piece, of bins of equal room the last used is taken; an empty
table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import canonical, materialize

MAX_TOKENS = 1024
OPEN_BINS = 1024
END_ID = 2
#: Pieces that one packer handles; what stays half full is OPEN_BINS bins of each packer.
PIECES_PER_PACKER = 250_000
SPECIAL = "<|endoftext|>"
#: The public pre-tokenisation pattern with possessive repeats, which match the same text faster.
PATTERN = r"""'(?:s|t|re|ve|m|ll|d)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s++"""

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


@functools.cache
def encoder(path: str):
    """text -> ids. The tokenizer file's own vocabulary is run by the faster of two equal
    engines; texts that spell a special token go to the file's tokenizer itself."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    special = Tokenizer.from_file(path)
    try:
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    except OSError:
        return lambda text: special.encode(text, add_special_tokens=False).ids
    if any(rank >= len(vocab) for rank in ranks.values()):
        raise ValueError(f"{path}: ranks and vocabulary differ")
    fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: special.encode(text, add_special_tokens=False).ids if SPECIAL in text else fast.encode_ordinary(text)


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: all of the full size but the first."""
    first = n % size or size
    return [(0, min(first, n))] + [(s, size) for s in range(first, n, size)]


def pieces(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row per piece with the crc32 of its ids."""
    import public_tokenizers

    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            known: dict[str, list[tuple]] = {}
            for doc_id, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                if (cuts := known.get(text)) is None:
                    ids = np.array([*encode(text), END_ID], dtype="<u4")
                    cuts = known[text] = [(i, s, n, zlib.crc32(ids[s : s + n])) for i, (s, n) in enumerate(cut(len(ids), max_tokens))]
                for i, s, n, crc in cuts:
                    for column, value in zip(out, (doc_id, i, s, n, crc, zlib.crc32(f"{doc_id}:{i}".encode())), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), *[pa.int64()] * 4), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"])

    return canonical(docs).mapInArrow(tokenise, PIECES)


class BoundedBestFit:
    """Online best fit with at most ``open_bins`` open bins."""

    def __init__(self, size: int, open_bins: int) -> None:
        self.size, self.most, self.opened, self.n = size, open_bins, 0, 0
        self.bits = 0  # bit f is set if some open bin has f free
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset in it) of a piece."""
        if fits := self.bits >> length:
            free = length + (fits & -fits).bit_length() - 1
            bin_id = self._take(free)
        else:
            bin_id, free = self.opened, self.size
            self.opened += 1
        if left := free - length:
            self.bins[left].append(bin_id)
            self.bits |= 1 << left
            self.n += 1
            if self.n > self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return bin_id, self.size - free

    def _take(self, free: int) -> int:
        bin_id = self.bins[free].pop()
        self.n -= 1
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        return bin_id


def pack(pieces_df: DataFrame, max_tokens: int = MAX_TOKENS, open_bins: int = OPEN_BINS) -> DataFrame:
    """Adds sequence_id and offset; each partition is one packer's stream."""
    stored = materialize(pieces_df, "pieces")
    packers = max(1, -(-stored.count() // PIECES_PER_PACKER))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base = BoundedBestFit(max_tokens, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [packer.put(n) for n in batch["length"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array([base + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    dealt = stored.repartition(packers, "salt").sortWithinPartitions("salt", "doc_id", "piece", "ids_crc32")
    return dealt.mapInArrow(run, PACKED)


def best_fit_packing(docs: DataFrame, tokenizer: str | None = None, max_tokens: int = MAX_TOKENS, open_bins: int = OPEN_BINS) -> DataFrame:
    return pack(pieces(docs, tokenizer, max_tokens), max_tokens, open_bins)


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    from curatrix.llm.common import documents

    return best_fit_packing(documents(spark, sf_dir)).select("doc_id", "piece", "start", "length", "ids_crc32", F.col("sequence_id"), F.col("offset"))
