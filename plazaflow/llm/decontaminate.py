"""Benchmark phrases found in training text by backward search over an FM-index per shard.

A shard is a run of documents of one input split, as a sequence of word symbols. Words that no
phrase has can be part of no occurrence; each of them, and each end of a document, is a sentinel
of its own. The shard's suffixes are sorted, its Burrows-Wheeler transform goes into a wavelet
matrix, and suffix positions are sampled. All phrases are searched at once, backwards, by ranks;
occurrences are located by walking to the next sample, and the spans they cover are merged.
Documents are neither shuffled nor joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plazaflow.llm.common import WordHasher, packed, text_chunks, unpacked

WINDOW = 10
SHARD_BYTES = 2**21  # of text in a shard; a longer document is a shard of its own
PHRASE_WORDS = 2**21  # phrases sent to executors at a time; a larger benchmark takes several passes
SAMPLE = 32
# On lower-cased UTF-8: digits, a-z and every byte of a character beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def word_list(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


class Lexicon:
    """Numbers from 1 for the words of the phrases, 0 for any other word, over whole buffers at once.

    Words are known by their 64-bit hashes; those of the phrases are checked to differ.
    """

    def __init__(self, vocab: dict[bytes, int]):
        is_word = np.zeros(256, bool)
        for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
            is_word[lo:hi] = True
        self.hasher = WordHasher(is_word)
        hashes, _ = self.hasher.of_texts([b" ".join(sorted(vocab, key=vocab.get))], b"\0")
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if len(np.unique(hashes)) != len(vocab):
            raise ValueError("two words of the phrases have one hash; change the seed")

    def symbols(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all texts, each followed by a 0, and their numbers of words."""
        hashes, n = self.hasher.of_texts(texts, b"\0")
        out = np.zeros(len(hashes) + len(texts), np.int64)
        if len(hashes) and len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = np.where(self.hashes[at] == hashes, self.order[at] + 1, 0)
            out[np.arange(len(hashes)) + np.repeat(np.arange(len(texts)), n)] = known
        return out, n


class WaveletMatrix:
    """Rank and access over integers below 2**bits; works on arrays of positions."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.words, self.counts, self.zeros = bits, [], [], []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level) & 1 == 1
            packed_ = np.packbits(bit, bitorder="little")
            padded = np.zeros((len(bit) // 64 + 1) * 8, np.uint8)
            padded[: len(packed_)] = packed_
            words = padded.view(np.uint64)
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]))
            self.zeros.append(len(bit) - int(bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])
        symbols = np.arange(2**bits)
        self.first = self.descend(symbols, np.zeros(len(symbols), np.int64))

    def _ones(self, i: int, at: np.ndarray) -> np.ndarray:
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        return self.counts[i][word] + np.bitwise_count(self.words[i][word] & ((np.uint64(1) << rest) - np.uint64(1)))

    def descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i in range(self.bits):
            ones = self._ones(i, at)
            at = np.where((symbols >> (self.bits - 1 - i)) & 1 == 1, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self.descend(symbols, at) - self.first[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and how often it stands before it."""
        symbols = np.zeros(len(at), np.int64)
        for i in range(self.bits):
            bit = (self.words[i][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones = self._ones(i, at)
            symbols = symbols * 2 + bit
            at = np.where(bit, self.zeros[i] + ones, at - ones)
        return symbols, at - self.first[symbols]


def suffix_order(text: np.ndarray, bits: int) -> np.ndarray:
    """Suffixes that start with a symbol above 0, in order; each 0 is smaller than all symbols and than later 0s.

    The first sort takes as many symbols as fit 62 bits; suffixes still equal are sorted further
    by the rank of what follows, twice as far each time.
    """
    n, per = len(text), 62 // bits
    tail = np.concatenate([text, np.zeros(per, text.dtype)]).astype(np.int64)
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(per):
        part = tail[j: j + n]
        alive &= part > 0
        key = (key << bits) | np.where(alive, part, 0)
    at = np.flatnonzero(text > 0)
    key, alive = key[at], alive[at]
    sorted_ = np.argsort(key, kind="stable")
    order, key, alive = at[sorted_], key[sorted_], alive[sorted_]
    rank = np.arange(n, dtype=np.int64) - n  # of a 0: below all symbols, by position
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | ~alive[1:]]) if len(key) else np.zeros(0, bool)
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1] if len(order) else rank[order]
    single = fresh & np.concatenate([fresh[1:], [True]]) if len(fresh) else fresh
    open_, h = np.flatnonzero(~single), per
    while len(open_):
        members = order[open_]
        follow = np.where(members + h < n, rank[np.minimum(members + h, n - 1)], -n - 1)
        both = rank[members] * (2 * n + 2) + (follow + n + 1)
        again = np.argsort(both, kind="stable")
        members, both = members[again], both[again]
        order[open_] = members
        fresh = np.concatenate([[True], both[1:] != both[:-1]])
        rank[members] = open_[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        open_ = open_[~(fresh & np.concatenate([fresh[1:], [True]]))]
        h *= 2
    return order


class FmIndex:
    """Over symbols 0..vocab, 0 being sentinels; the text must end with a 0."""

    def __init__(self, text: np.ndarray, vocab: int):
        bits = max(int(vocab).bit_length(), 1)
        sentinels = np.flatnonzero(text == 0)
        suffixes = np.concatenate([sentinels, suffix_order(text, bits)])
        last = np.where(suffixes > 0, text[suffixes - 1], 0)
        self.bwt = WaveletMatrix(last.astype(np.int64), bits)
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=vocab + 1))])
        # walking back stops at a sentinel, so what follows one is sampled too
        sampled = (suffixes % SAMPLE == 0) | (last == 0)
        self.sampled, self.seat, self.samples = sampled, np.cumsum(sampled) - 1, suffixes[sampled].astype(np.int32)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of all phrases, given as rows of symbols above 0."""
        lo, hi = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        alive = np.arange(len(phrases))
        symbol = phrases[:, -1]
        lo[:], hi[:] = self.starts[symbol], self.starts[symbol + 1]
        for j in range(phrases.shape[1] - 2, -1, -1):
            alive = alive[hi[alive] > lo[alive]]
            symbol = phrases[alive, j]
            lo[alive] = self.starts[symbol] + self.bwt.rank(symbol, lo[alive])
            hi[alive] = self.starts[symbol] + self.bwt.rank(symbol, hi[alive])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, steps, open_, rows = np.zeros(len(rows), np.int64), 0, np.arange(len(rows)), rows.copy()
        while len(open_):
            hit = self.sampled[rows[open_]]
            done = open_[hit]
            out[done] = self.samples[self.seat[rows[done]]] + steps
            open_ = open_[~hit]
            symbols, before = self.bwt.access(rows[open_])
            rows[open_] = self.starts[symbols] + before
            steps += 1
        return out


class Phrases:
    """Windows of the items by length, their symbols, and the items each window is of."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocab: dict[bytes, int] = {}
        seen: dict[int, dict[tuple[int, ...], set[int]]] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        for name, text in items:
            symbols = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in word_list(text)]
            if symbols:
                size = min(window, len(symbols))
                own = seen.setdefault(size, {})
                for i in range(len(symbols) - size + 1):
                    own.setdefault(tuple(symbols[i:i + size]), set()).add(number[name])
        self.by_size = [(size, np.array(list(own), np.int64).reshape(-1, size), [np.array(sorted(s), np.int64) for s in own.values()])
                        for size, own in sorted(seen.items())]
        self.lexicon = Lexicon(self.vocab)


def search_shard(joined: np.ndarray, lengths: np.ndarray, phrases: Phrases) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per document of the shard: which words are hit, and which items have a window in it."""
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    cover, pairs = np.zeros(len(joined) + 1, np.int64), []
    index = FmIndex(joined, len(phrases.vocab))
    for size, windows, owners in phrases.by_size:
        lo, hi = index.search(windows)
        found = np.flatnonzero(hi > lo)
        if not len(found):
            continue
        n = hi[found] - lo[found]
        rows = np.repeat(lo[found] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        at, window = index.locate(rows), np.repeat(found, n)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + size, -1)
        seen = np.unique(np.stack([np.searchsorted(starts, at, "right") - 1, window]), axis=1)
        pairs.extend((d, owners[w]) for d, w in zip(seen[0], seen[1]))
    hit = np.cumsum(cover[:-1]) > 0
    items: list[list[np.ndarray]] = [[] for _ in lengths]
    for d, own in pairs:
        items[d].append(own)
    return [hit[a: a + n] for a, n in zip(starts, lengths)], [np.unique(np.concatenate(x)) if x else np.zeros(0, np.int64) for x in items]


def _spans(hit: np.ndarray) -> list[int]:
    """Starts and ends of the runs of hit words, in turn."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).tolist()


def cut_words(text: bytes, spans: list[int]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    bounds = [m.span() for m in _WORD.finditer(text.lower())]
    parts, at = [], 0
    for a, b in zip(spans[::2], spans[1::2]):
        parts.append(text[at: bounds[a][0]])
        at = bounds[b - 1][1]
    return b"".join([*parts, text[at:]])


def find_phrases(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, phrase_words: int = PHRASE_WORDS, shard_bytes: int = SHARD_BYTES,
                 cut: bool = False) -> DataFrame:
    """Words of documents inside an occurrence of a benchmark window.

    Returns row (the input row without its text), text (binary), n_words, spans (word offsets of merged hits: start,
    end, start, end ...), items (the item_ids, as strings, with a window in the document) and cut (where asked
    for and anything is hit: the text without the hit words). An item of fewer words
    than a window is one window; null or empty texts have no words and give none. Items that
    repeat an item_id are one item; one without an id is called ''. Documents may repeat, and each is searched.
    """
    rough = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-rough // (2 * phrase_words)))  # a word and its gap take two bytes at least
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text"))
    found = packed(docs, without="text", text=F.col("text").cast("binary")).withColumn("n_words", F.lit(0).cast("long")).withColumn(
        "spans", F.lit(None).cast("array<int>")).withColumn("items", F.lit(None).cast("array<string>")).withColumn("cut", F.lit(None).cast("binary"))
    kind = found.schema["row"].dataType.simpleString()
    for group in range(groups):
        part = items.where((F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == group) & F.col("text").isNotNull())
        sent = docs.sparkSession.sparkContext.broadcast(Phrases([(r.item, bytes(r.text)) for r in part.collect()], window))

        def run(batches: Iterator[pa.RecordBatch], sent=sent, cutting=cut and group == groups - 1) -> Iterator[pa.RecordBatch]:
            phrases = sent.value
            for batch in batches:
                hits, own, n_words = [], [], []
                for texts in text_chunks(batch.column(1), shard_bytes):
                    joined, lengths = phrases.lexicon.symbols(texts)
                    a, b = search_shard(joined, lengths, phrases)
                    hits.extend(a)
                    own.extend([phrases.names[i] for i in x] for x in b)
                    n_words.append(lengths)
                spans, names = [], []
                for before, hit, had, got in zip(batch.column(3).to_pylist(), hits, batch.column(4).to_pylist(), own):
                    for a, b in zip((before or [])[::2], (before or [])[1::2]):
                        hit[a:b] = True
                    spans.append(_spans(hit))
                    names.append(sorted({*(had or []), *got}))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.concatenate(n_words) if n_words else [], pa.int64()), pa.array(spans, pa.list_(pa.int32())),
                     pa.array(names, pa.list_(pa.string())),
                     pa.array([cut_words(t.as_py(), s) if cutting and s else None for t, s in zip(batch.column(1), spans)], pa.binary())],
                    names=["row", "text", "n_words", "spans", "items", "cut"])

        found = found.mapInArrow(run, f"row {kind}, text binary, n_words long, spans array<int>, items array<string>, cut binary")
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of each document."""
    found = find_phrases(docs.select("doc_id", "text"), benchmark, window)
    sign = lambda i: F.when(i % 2 == 0, F.lit(-1)).otherwise(1)
    n_hit = F.aggregate(F.transform("spans", lambda x, i: x * sign(i)), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with all benchmark spans cut out; other texts and columns stay as they are (n_chars, if there, follows the text)."""
    cut = find_phrases(docs, benchmark, window, cut=True).select("row", "text", "cut")
    text = F.coalesce("cut", "text").cast("string")
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("cut").isNull(), F.col("row.n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType)
    return unpacked(cut, docs.columns, **changed)
