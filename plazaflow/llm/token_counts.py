"""Edit-aware token counts: a segment tree of pre-tokens per document, re-encoded only where edits touch.

A byte-pair tokenizer splits text into pre-tokens by a pattern and encodes each by itself, so a
count is a sum over pre-tokens. The tree's leaves hold runs of pre-tokens as (characters,
tokens); inner nodes hold sums. An edit re-splits from a pre-token that ends CONTEXT characters
before it, until a new boundary falls on an old one behind it; only the leaves between are
rebuilt, and the sums above them.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The public pattern that belongs to the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CONTEXT = 4  # the pattern looks at most three characters past the start of what it takes, or one past its end
LEAF = 64  # pre-tokens in a leaf
MAX_RANKS = 64 * 2**20  # bytes of a vocabulary file that may be sent to executors
EDIT = "struct<start:bigint,n_delete:bigint,insert:string>"


class Counter(dict):
    """Pre-token to its tokens, encoded when first asked for; forgets all when it has grown large."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN, most: int = 200_000):
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.bpe = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
        self.pattern, self.most = regex.compile(pattern), most

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[piece] = n = len(self.bpe.encode_ordinary(piece))
        return n


class PieceTree:
    """Pre-tokens of one text: leaves of (lengths, token counts) under a heap of sums."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter, self.touched = text, counter, 0
        pieces = counter.pattern.findall(text)
        self._build(list(map(len, pieces)), list(map(counter.__getitem__, pieces)))

    def _build(self, lengths: list[int], counts: list[int]) -> None:
        self.leaves = [(lengths[i:i + LEAF], counts[i:i + LEAF]) for i in range(0, len(lengths), LEAF)] or [([], [])]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, leaf in enumerate(self.leaves):
            self.chars[self.width + i], self.sums[self.width + i] = sum(leaf[0]), sum(leaf[1])
        for node in range(self.width - 1, 0, -1):
            self._pull(node)

    def _pull(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.sums[1]

    def _leaf_at(self, at: int) -> tuple[int, int]:
        """The leaf that holds character `at` (the last one for the text's end), and where it starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if at >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def edit(self, start: int, n_delete: int, insert: str) -> None:
        """Replaces n_delete characters from `start` by `insert`; both are cut to the text."""
        start = min(max(start, 0), len(self.text))
        stop = min(start + max(n_delete, 0), len(self.text))
        shift = len(insert) - (stop - start)
        # first pre-token that may change: the one after the last that ends CONTEXT before the edit
        first, at = self._leaf_at(max(start - CONTEXT, 0))
        ends = list(accumulate(self.leaves[first][0], initial=at))
        skip = max(bisect_right(ends, start - CONTEXT) - 1, 0)
        begin = ends[skip]
        self.text = self.text[:start] + insert + self.text[stop:]
        # old boundaries behind the edit, leaf by leaf, until a new boundary meets one
        last, ends = first, ends
        lengths, counts, now = [], [], begin
        behind = None
        for m in self.counter.pattern.finditer(self.text, begin):
            lengths.append(m.end() - m.start())
            counts.append(self.counter[m[0]])
            self.touched += 1
            now = m.end()
            old = now - shift
            if old < stop or now < start + len(insert):
                continue
            while ends[-1] < old and last + 1 < len(self.leaves):
                last += 1
                ends = list(accumulate(self.leaves[last][0], initial=ends[-1]))
            i = bisect_right(ends, old) - 1
            if i >= 0 and ends[i] == old:
                behind = i
                break
        head = self.leaves[first]
        if behind is None:  # the text's end was reached
            last, tail = len(self.leaves) - 1, ([], [])
        else:
            tail = (self.leaves[last][0][behind:], self.leaves[last][1][behind:])
        merged = (head[0][:skip] + lengths + tail[0], head[1][:skip] + counts + tail[1])
        if len(merged[0]) > 8 * LEAF:
            leaves = [*self.leaves[:first], merged, *self.leaves[last + 1:]]
            self._build([n for x in leaves for n in x[0]], [n for x in leaves for n in x[1]])
            return
        self.leaves[first] = merged
        for i in range(first + 1, last + 1):
            self.leaves[i] = ([], [])
        for i in range(first, last + 1):
            self.chars[self.width + i], self.sums[self.width + i] = sum(self.leaves[i][0]), sum(self.leaves[i][1])
        lo, hi = (self.width + first) >> 1, (self.width + last) >> 1
        while lo:
            for node in range(lo, hi + 1):
                self._pull(node)
            lo, hi = lo >> 1, hi >> 1


def read_ranks(spark: SparkSession, path: str = RANKS) -> bytes:
    """The vocabulary file, by a local path of the driver or any that Spark can read; its size is checked."""
    if "://" in path:
        found = spark.read.format("binaryFile").load(path).where(F.col("length") <= MAX_RANKS).select("content").first()
        data = bytes(found[0]) if found else b""
    else:
        with open(path, "rb") as f:
            data = f.read(MAX_RANKS + 1)
    if not 0 < len(data) <= MAX_RANKS:
        raise ValueError(f"{path} is not a vocabulary of at most {MAX_RANKS} bytes")
    return data


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """Documents with their edits (doc_id, seq, start, n_delete, insert) as one ordered array column `edits`."""
    own = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "start", "n_delete", "insert"))).alias("edits"))
    own = own.select("doc_id", F.transform("edits", lambda e: F.struct(
        e["start"].cast("long").alias("start"), e["n_delete"].cast("long").alias("n_delete"), e["insert"].alias("insert"))).alias("edits"))
    return docs.join(own, "doc_id", "left")


def count_with_edits(docs: DataFrame, edits: str = "edits", ranks: str = RANKS) -> DataFrame:
    """Token counts before and after the edits of each row (array of start, n_delete, insert, applied in order).

    Returns row (the input row), n_pieces, n_tokens, n_edits, n_tokens_edited, n_reencoded (pre-tokens that the
    edits re-encoded). Offsets are code points of the text as the edits before left it, cut to it. A
    null text is empty; null edits, also within the array, change nothing; a null start or n_delete is 0, a null insert empty.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(read_ranks(spark, ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        for batch in batches:
            out: list[list[int]] = [[], [], [], [], []]
            for text, todo in zip(batch.column(1), batch.column(2)):
                tree = PieceTree(text.as_py() or "", counter)
                pieces, before, todo = sum(len(x[0]) for x in tree.leaves), tree.n_tokens, [e for e in todo.as_py() or [] if e]
                for e in todo:
                    tree.edit(e["start"] or 0, e["n_delete"] or 0, e["insert"] or "")
                for column, value in zip(out, (pieces, before, len(todo), tree.n_tokens, tree.touched)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in out]],
                                             names=["row", "n_pieces", "n_tokens", "n_edits", "n_tokens_edited", "n_reencoded"])

    given = F.col(edits) if edits in docs.columns else F.lit(None)
    columns = [c for c in docs.columns if c != edits]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text", given.cast(f"array<{EDIT}>").alias("edits"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, n_pieces long, n_tokens long, n_edits long, n_tokens_edited long, n_reencoded long")


def revision_edits() -> Column:
    """Three edits of each row, made of its own text and source: its first line is also put into the
    middle, ten characters go at a quarter, and its last five give way to the source's name."""
    text, n = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit(""))).cast("long")
    cut = lambda start, n_delete, insert: F.struct(start.alias("start"), F.lit(n_delete).cast("long").alias("n_delete"), insert.alias("insert"))
    return F.array(
        cut(F.floor(n / 2), 0, F.substring_index(text, "\n", 1)), cut(F.floor(n / 4), 10, F.lit("")),
        cut(F.greatest(n - 5, F.lit(0)), 5, F.coalesce(F.col("source").cast("string"), F.lit(""))))
