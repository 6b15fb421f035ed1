"""Lines repeated across documents, found by probing sharded minimal perfect hashes.

A line's key is its 128-bit hash. Distinct keys with their document counts are dealt to
shards of SHARD_KEYS keys; a shard is one row holding a minimal perfect hash with a
fingerprint and a count for each key, and the keeping document of the frequent ones.
Documents send (hash, document) pairs to the shard and get back only the lines to drop;
line texts are neither joined nor shuffled. A shard whose keys are very common is repeated
so that its probes spread over several tasks.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plazaflow.llm.common import CHUNK_BYTES, NO_ID, SPACE, mix, packed, small_batches, written

SHARD_KEYS = 8192  # keys in a shard, so its row has some 100 KB
HOT_SHARES = 4096  # a shard is repeated when it gets more than this part of all probes; so fewer than this many are
LEVELS = 24
_STRIP = SPACE.encode()


def line_key(line: bytes) -> bytes:
    """Stripped and with A-Z in lower case; bytes.lower() leaves all but ASCII alone."""
    return line.strip(_STRIP).lower()


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


class MinimalPerfectHash:
    """Levels of bit arrays: a key sits in the first level where no other key shares its bit.

    Its index is the rank of that bit. Keys left after the last level are kept sorted.
    """

    def __init__(self, bits: list[np.ndarray], rest: np.ndarray):
        self.bits, self.rest = bits, rest
        self.base = np.cumsum([0, *(int(b.sum()) for b in bits)])
        self.ranks = [np.cumsum(b) - b for b in bits]

    @staticmethod
    def _seats(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        bits, left = [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            seats = cls._seats(left, level, size := 2 * len(left))
            alone = np.bincount(seats, minlength=size) == 1
            bits.append(alone)
            left = left[~alone[seats]]
        return cls(bits, np.sort(left))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The key's index; -1 for some keys that were not built in, any index for the others."""
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, bits in enumerate(self.bits):
            seats = self._seats(keys[open_], level, len(bits))
            hit = bits[seats]
            found[open_[hit]] = self.base[level] + self.ranks[level][seats[hit]]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            found[open_[hit]] = self.base[-1] + at[hit]
        return found

    def dump(self) -> bytes:
        parts = [struct.pack("<II", len(self.bits), len(self.rest)), self.rest.tobytes()]
        for b in self.bits:
            parts += [struct.pack("<I", len(b)), np.packbits(b).tobytes()]
        return b"".join(parts)

    @classmethod
    def load(cls, data: bytes) -> MinimalPerfectHash:
        levels, n_rest = struct.unpack_from("<II", data)
        rest, at, bits = np.frombuffer(data, np.uint64, n_rest, 8), 8 + 8 * n_rest, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<I", data, at)
            bits.append(np.unpackbits(np.frombuffer(data, np.uint8, (n + 7) // 8, at + 4), count=n).astype(bool))
            at += 4 + (n + 7) // 8
        return cls(bits, rest)


class LineIndex:
    """One shard: fingerprints and counts by the key's index, keepers of the frequent keys."""

    def __init__(self, mph: MinimalPerfectHash, prints: np.ndarray, counts: np.ndarray, keepers: np.ndarray, min_docs: int):
        self.mph, self.prints, self.counts, self.keepers, self.min_docs = mph, prints, counts, keepers, min_docs
        self.frequent = counts >= min_docs
        self.slot = np.cumsum(self.frequent) - 1

    @staticmethod
    def _key(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        return mix(h1) ^ h2

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, counts: np.ndarray, keepers: np.ndarray, min_docs: int) -> LineIndex:
        mph = MinimalPerfectHash.build(cls._key(h1, h2))
        order = np.argsort(mph.index(cls._key(h1, h2)))
        counts, keepers = counts[order], keepers[order]
        return cls(mph, (h2[order] >> np.uint64(32)).astype(np.uint32), np.minimum(counts, 2**16 - 1).astype(np.uint16),
                   keepers[counts >= min_docs], min_docs)

    def dropped(self, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Whether a frequent line sits in another document than the one that keeps it."""
        if not len(self.prints):
            return np.zeros(len(h1), bool)
        at = self.mph.index(self._key(h1, h2))
        known = (at >= 0) & (self.prints[at] == (h2 >> np.uint64(32)).astype(np.uint32)) & self.frequent[at]
        out = np.zeros(len(h1), bool)
        out[known] = self.keepers[self.slot[at[known]]] != doc[known]
        return out

    def dump(self) -> bytes:
        mph = self.mph.dump()
        head = struct.pack("<IIII", len(mph), len(self.prints), len(self.keepers), self.min_docs)
        return b"".join([head, mph, self.prints.tobytes(), self.counts.tobytes(), self.keepers.astype(np.int64).tobytes()])

    @classmethod
    def load(cls, data: bytes) -> LineIndex:
        n_mph, n, n_keep, min_docs = struct.unpack_from("<IIII", data)
        at = 16 + n_mph
        return cls(MinimalPerfectHash.load(data[16:at]), np.frombuffer(data, np.uint32, n, at),
                   np.frombuffer(data, np.uint16, n, at + 4 * n), np.frombuffer(data, np.int64, n_keep, at + 6 * n), min_docs)


def _line_hashes(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(document, its text's hash, line hash), once for each different long line of a row."""
    for batch in small_batches(batches, 2):
        ids, texts, of, digests = batch.column(0).to_numpy(), batch.column(1).to_numpy(), [], []
        for i, text in enumerate(batch.column(2)):
            own = set()
            for line in (text.as_py() or b"").split(b"\n"):
                key = line_key(line)
                # bytes bound code points from above, so short keys need no decoding
                if len(key) >= min_chars and len(key.decode("utf-8", "replace")) >= min_chars:
                    own.add(_hash(key))
            digests.extend(own)
            of.extend([i] * len(own))
        both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[of] if of else ids[:0]), pa.array(texts[of] if of else texts[:0]), pa.array(both[:, 0]), pa.array(both[:, 1])],
            names=["doc", "copy", "h1", "h2"])


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by seat with the seat's shard row first; probes stream past it."""
    seat, index = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        shard, rep = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        doc, copy, h1, h2 = (batch.column(i).fill_null(0).to_numpy() for i in (3, 4, 5, 6))
        cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(rep) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            if (shard[lo], rep[lo]) != seat:
                seat, index = (shard[lo], rep[lo]), None
            while lo < hi and batch.column(2)[lo].is_valid:
                index, lo = LineIndex.load(batch.column(2)[lo].as_py()), lo + 1
            if lo < hi and index is not None:
                hit = index.dropped(h1[lo:hi].view(np.uint64), h2[lo:hi].view(np.uint64), doc[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array(x[lo:hi][hit]) for x in (doc, copy, h1, h2)], names=["doc", "copy", "h1", "h2"])


def _cut(text: bytes | None, h1: list[int] | None, h2: list[int] | None) -> tuple[bytes | None, int, int, str]:
    """The text without the lines of these hashes; `kept` is null where nothing goes.

    Pickled rows: Spark sends a hundred texts at a time, where an Arrow batch holds up to ten thousand of them,
    and the packed row stays in the executor.
    """
    text = text or b""
    lines = text.split(b"\n")
    n_lines, kept = len(lines), None
    if h1:
        gone = {struct.pack("<qq", *h) for h in zip(h1, h2)}
        lines = [x for x in lines if _hash(line_key(x)) not in gone]
    if len(lines) < n_lines:
        kept = b"\n".join(lines)
    return kept, n_lines, n_lines - len(lines), hashlib.sha256(text if kept is None else kept).hexdigest()


def build_index(keys: DataFrame, min_docs: int) -> tuple[DataFrame, int]:
    """One row per shard from distinct (h1, h2, n, keeper); also the number of shards."""
    shards = -(-keys.count() // SHARD_KEYS) or 1

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        data = LineIndex.build(pdf.h1.to_numpy().view(np.uint64), pdf.h2.to_numpy().view(np.uint64), pdf.n.to_numpy(), pdf.keeper.to_numpy(), min_docs)
        return pd.DataFrame({"shard": [pdf.shard.iloc[0]], "load": [int(pdf.n.sum())], "data": [data.dump()]})

    dealt = keys.withColumn("shard", F.pmod("h1", F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(build, "shard long, load long, data binary"), shards


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """Drops lines found in at least `min_docs` documents, but in the largest doc_id holding them.

    Returns row (the input row without its text), text (binary, as it was), kept (the new text, null
    where nothing goes), n_lines, n_dropped, kept_sha256.
    A null or empty text is one empty line. Rows with one doc_id are one document, and so are
    all rows without a doc_id, which count as the smallest id. A repeated line stays or goes
    with all its copies. An empty table gives an empty result.
    """
    if not 1 <= min_docs < 2**16:
        raise ValueError("min_docs must fit the count array")
    rows = packed(docs, without="text", doc=F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), copy=F.xxhash64("text"), text=F.col("text").cast("binary"))
    lines = written(
        rows.select("doc", "copy", "text").mapInArrow(lambda b: _line_hashes(b, min_chars), "doc long, copy long, h1 long, h2 long"), "lines", CHUNK_BYTES)
    keys = written(lines.groupBy("h1", "h2").agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("keeper")), "line-keys")
    index, shards = build_index(keys, min_docs)
    index = written(index, "line-index")
    total = index.agg(F.sum("load")).first()[0] or 0
    most = max(2 * SHARD_KEYS, total // HOT_SHARES)
    # fewer than HOT_SHARES shards exceed 1/HOT_SHARES of the probes, so this table has a fixed bound
    hot = index.where(F.col("load") > most).select("shard", F.ceil(F.col("load") / most).cast("int").alias("times"))
    seats = index.join(F.broadcast(hot), "shard", "left").select(
        "shard", F.explode(F.sequence(F.lit(0), F.coalesce("times", F.lit(1)) - 1)).alias("rep"), "data",
        *[F.lit(None).cast("long").alias(c) for c in ("doc", "copy", "h1", "h2")])
    probes = lines.withColumn("shard", F.pmod("h1", F.lit(shards))).join(F.broadcast(hot), "shard", "left").select(
        "shard", F.coalesce(F.pmod(F.xxhash64("doc", "copy"), F.col("times")).cast("int"), F.lit(0)).alias("rep"),
        F.lit(None).cast("binary").alias("data"), "doc", "copy", "h1", "h2")
    hits = (
        seats.union(probes).repartition("shard", "rep").sortWithinPartitions("shard", "rep", F.col("data").isNull())
        .mapInArrow(_probe, "doc long, copy long, h1 long, h2 long")
    )
    drops = hits.groupBy("doc", "copy").agg(F.collect_set(F.struct("h1", "h2")).alias("gone"))
    cut = F.udf(_cut, "kept binary, n_lines long, n_dropped long, kept_sha256 string", useArrow=False)
    done = rows.join(drops, ["doc", "copy"], "left").select("row", "text", cut("text", "gone.h1", "gone.h2").alias("cut"))
    return done.select("row", "text", *[F.col("cut")[c].alias(c) for c in ("kept", "n_lines", "n_dropped", "kept_sha256")])
