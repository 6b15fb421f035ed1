"""Documents whose sets of word shingles nearly coincide, by signature trees.

Equal sets are one class. For candidates a set is cut by a hash of its shingles into more parts
than two linked sets can differ in, so linked sets have equal parts; the largest parts suffice.
Most parts are of one class only: tasks first send the places of their parts in a space of hashes,
at some two bytes each, and only parts whose place comes more than once are sent with their class.
Classes that share parts, directly or through others, form a family, and no link leaves a
family. Only texts of families are shuffled, one a class. Each family gets
a signature tree: leaves of classes, and nodes with the OR of their bitmaps and their range of
sizes. A traversal of node pairs drops those whose largest possible overlap is too small and
those that are one component already; what remains is compared exactly. A large family is cut
into blocks, and only what its first block does not connect is compared across blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from plazaflow.llm.common import NO_ID, Bloom, WordHasher, discard, mix, packed, text_chunks, unpacked, written
from plazaflow.llm.components import components

SHINGLE = 3
PERCENT = 90
BLOCK_SHINGLES = 2**20  # of the classes in a block of a family, and of the small families in a task
LEAF, FAN = 16, 8
SEEN = 200_000  # classes whose text a task has sent already; forgotten when there are more
HELD_KEYS = 2**20  # part keys that a task gathers before it sends their places
BUCKET_KEYS = 2**17  # part keys whose places meet in one group

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def shingle_sets(texts: list[bytes], size: int, hasher: WordHasher) -> list[np.ndarray]:
    """The sorted different hashes of each text's shingles; fewer words than `size` are one shingle."""
    words, n = hasher.of_texts(texts, b" ")
    ends = np.cumsum(n)
    with np.errstate(over="ignore"):
        joined = mix(words + np.uint64(size))
        for j in range(1, min(size, len(words))):
            joined[: len(words) - j] = mix(joined[: len(words) - j] + words[j:])
        out = []
        for end, k in zip(ends, n):
            if k >= size:
                out.append(np.unique(joined[end - k: end - size + 1]))
            elif k:
                h = np.array([0xA5A5A5A5 + int(k)], np.uint64)
                for w in words[end - k: end]:
                    h = mix(h + w)
                out.append(h)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


class Scheme:
    """By how many shingles two linked sets of a size can differ at most.

    Sizes fall into bands such that linked sets are in one band or in adjacent ones. A pair uses
    the band of its larger set, so a set is cut for its own band and for the next one.
    For |A & B| >= t |A | B|, |A ^ B| <= (1-t)/(1+t) (|A| + |B|).
    """

    def __init__(self, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("percent must be above 0 and at most 100")
        self.percent, self.starts = percent, [1]

    def band(self, n: np.ndarray) -> np.ndarray:
        while len(n) and self.starts[-1] <= n.max():
            self.starts.append(self.starts[-1] * 100 // self.percent + 1)
        return np.searchsorted(np.array(self.starts, np.int64), n, "right") - 1

    def differ(self, band: np.ndarray) -> np.ndarray:
        while len(band) and len(self.starts) < band.max() + 2:
            self.starts.append(self.starts[-1] * 100 // self.percent + 1)
        most = np.array(self.starts, np.int64)[band + 1] - 1
        return 2 * most * (100 - self.percent) // (100 + self.percent)


def part_keys(sets: list[np.ndarray], scheme: Scheme) -> list[np.ndarray]:
    """For each set, the hashes of its largest parts, for both bands.

    Sets that differ by at most d shingles, cut into k > d parts, have k - d equal parts or more.
    The largest of these (by size, then hash) has k - d - 1 equal parts below it in either set,
    so it is among the d + 1 largest of both: those are enough, and small parts, which
    unrelated sets may share, are left out.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(len(sets)), sizes)
    band, found = scheme.band(sizes), []
    with np.errstate(over="ignore"):
        for step in (0, 1):
            send = scheme.differ(band + step) + 1
            k = send * 5 // 4
            first = np.cumsum(k) - k
            salt = mix((band + step + 1).astype(np.uint64))
            part = first[of] + (mix(flat + salt[of]) % k[of].astype(np.uint64)).astype(np.int64)
            sums, held = np.zeros(int(k.sum()), np.uint64), np.bincount(part, minlength=int(k.sum()))
            np.add.at(sums, part, mix(flat ^ salt[of]))
            number = np.arange(int(k.sum())) - np.repeat(first, k)
            keys = mix(sums + mix(np.repeat(salt, k) ^ number.astype(np.uint64)))
            rank = (np.minimum(held, 2**15).astype(np.uint64) << np.uint64(48)) | (keys >> np.uint64(16))
            found.append([keys[f: f + n][np.argpartition(rank[f: f + n], n - m)[n - m:]] if n > m else keys[f: f + n] for f, n, m in zip(first, k, send)])
    return [np.concatenate(pair) for pair in zip(*found)]


def _digest(s: np.ndarray) -> tuple[int, int]:
    both = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
    return int(both[0]), int(both[1])


def _classes(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Per document: n and the class (c1, c2)."""
    hasher = WordHasher(~_SPACES)
    for batch in batches:
        sets = (s for texts in text_chunks(batch.column(1)) for s in shingle_sets(texts, size, hasher))
        found = [(len(s), *(_digest(s) if len(s) else (0, 0))) for s in sets]
        n, c1, c2 = np.array(found, np.int64).reshape(-1, 3).T
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n), pa.array(c1), pa.array(c2)],
                                         names=["doc_id", "copy", "n", "c1", "c2"])


def _first_texts(batches: Iterator[pa.RecordBatch], first: Bloom) -> Iterator[list[bytes]]:
    """The texts of (text, h) in chunks, without most of those that `first` does not name."""
    for batch in batches:
        yield from text_chunks(batch.column(0).filter(pa.array(first.passes(batch.column(1).to_numpy()))))


class Places:
    """A space of at least 32 places a part key; its first bits are a place's bucket."""

    def __init__(self, keys: int):
        self.bits = max((32 * keys).bit_length(), 16)
        self.inner = self.bits - min(max(keys // BUCKET_KEYS, 1).bit_length(), 14)

    def of(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def packed(self, places: np.ndarray) -> pa.RecordBatch:
        """(bucket, marks): the places of each bucket in order, each as what it is beyond the one before, in 16 bits;
        65535 is a step without a place. Of equal places two are kept."""
        places = np.sort(places)
        places = places[np.concatenate([np.ones(2, bool), places[2:] != places[:-2]])[: len(places)]]
        bucket, at = np.unique(places >> self.inner, return_index=True)
        beyond = np.diff(places, prepend=0)
        beyond[at] = places[at] - (bucket << self.inner)
        ends = np.cumsum(beyond // 65535 + 1)
        marks = np.full(ends[-1], 65535, np.uint16)
        marks[ends - 1] = beyond % 65535
        offsets = np.append(0, 2 * ends[np.append(at[1:], len(places)) - 1]).astype(np.int32)
        blobs = pa.Array.from_buffers(pa.binary(), len(bucket), [None, pa.py_buffer(offsets), pa.py_buffer(marks)])
        return pa.RecordBatch.from_arrays([pa.array(bucket), blobs], names=["bucket", "marks"])

    def repeated(self, group: pa.Table) -> pa.Table:
        """The places that come more than once among the rows of a bucket."""
        found = []
        for blob in group.column("marks").to_pylist():
            marks = np.frombuffer(blob, np.uint16)
            found.append(np.cumsum(marks.astype(np.int64))[marks != 65535])
        places = np.sort(np.concatenate(found))
        places = np.unique(places[1:][places[1:] == places[:-1]])
        return pa.table({"place": places + (group.column("bucket")[0].as_py() << self.inner)})


def _marks(batches: Iterator[pa.RecordBatch], size: int, percent: int, first: Bloom, places: Places) -> Iterator[pa.RecordBatch]:
    """(bucket, marks) of the parts of all classes."""
    hasher, scheme, held, n = WordHasher(~_SPACES), Scheme(percent), [], 0
    for texts in _first_texts(batches, first):
        sets = {_digest(s)[0]: s for s in shingle_sets(texts, size, hasher) if len(s)}
        if sets:
            held.append(places.of(np.concatenate(part_keys(list(sets.values()), scheme))))
            n += len(held[-1])
        if n >= HELD_KEYS:
            yield places.packed(np.concatenate(held))
            held, n = [], 0
    if n:
        yield places.packed(np.concatenate(held))


def _keys(batches: Iterator[pa.RecordBatch], size: int, percent: int, first: Bloom, places: Places, shared: Bloom) -> Iterator[pa.RecordBatch]:
    """(key, class, other): rows with a null `other` are parts to be met; the rest ties a class to another of its chunk.

    Within a chunk each class is cut once, and each key is sent by the first class that has it;
    the others name that class instead, so a common key leaves a chunk once. Most keys that no
    other class has are left out.
    """
    hasher, scheme = WordHasher(~_SPACES), Scheme(percent)
    for texts in _first_texts(batches, first):
        sets = {_digest(s)[0]: s for s in shingle_sets(texts, size, hasher) if len(s)}
        if not sets:
            continue
        ids, keys = np.array(list(sets), np.int64), part_keys(list(sets.values()), scheme)
        flat, of = np.concatenate(keys), np.repeat(np.arange(len(ids)), [len(k) for k in keys])
        met = shared.passes(places.of(flat))
        flat, of = flat[met], of[met]
        _, at, inverse = np.unique(flat, return_index=True, return_inverse=True)
        holder = of[at][inverse]
        lead = holder == of
        ties = np.unique(np.stack([ids[of[~lead]], ids[holder[~lead]]]), axis=1)
        n = int(lead.sum())
        other = np.concatenate([np.zeros(n, np.int64), ties[1]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([flat[lead].view(np.int64), ties[0]])), pa.array(np.concatenate([ids[of[lead]], ties[0]])),
             pa.array(other, mask=np.arange(len(other)) < n)], names=["key", "c", "other"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from the classes of a key to its first one, and the ties; rows come sorted by key and class."""
    last_key, first = None, 0
    for batch in batches:
        met = batch.column(2).is_null().to_numpy(zero_copy_only=False)
        a, b = batch.column(1).to_numpy()[~met], batch.column(2).fill_null(0).to_numpy()[~met]
        key, c = batch.column(0).to_numpy()[met], batch.column(1).to_numpy()[met]
        if len(key):
            fresh = np.concatenate([[key[0] != last_key], key[1:] != key[:-1]])
            heads = np.concatenate([[first], c[fresh]])
            lead = heads[np.cumsum(fresh)]
            last_key, first = key[-1], lead[-1]
            a, b = np.concatenate([a, c[lead != c]]), np.concatenate([b, lead[lead != c]])
        pairs = np.unique(np.stack([a, b]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


class SignatureTree:
    """Nodes over classes in order of size: bitmaps, the most shingles beyond a bitmap's bits, sizes."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        n = len(sets)
        self.sizes = np.array([len(s) for s in sets], np.int64)
        bitmap = np.zeros((n, bits // 8), np.uint8)
        for i, s in enumerate(sets):
            row = np.zeros(bits, np.uint8)
            row[(mix(s) % np.uint64(bits)).astype(np.int64)] = 1
            bitmap[i] = np.packbits(row)
        maps = bitmap.view(np.uint64)
        excess = self.sizes - np.bitwise_count(maps).sum(axis=1)
        # each level: lo, hi (classes), bitmaps, excess, least and most size, children
        self.levels = [(np.arange(n), np.arange(1, n + 1), maps, excess, self.sizes, self.sizes, None)]
        fan = LEAF
        while len(self.levels[-1][0]) > 1:
            lo, hi, maps, excess, least, most, _ = self.levels[-1]
            cut = np.arange(0, len(lo), fan)
            self.levels.append((
                lo[cut], np.append(hi[cut[1:] - 1], hi[-1]), np.bitwise_or.reduceat(maps, cut, axis=0), np.maximum.reduceat(excess, cut),
                np.minimum.reduceat(least, cut), np.maximum.reduceat(most, cut), np.append(cut, len(lo))))
            fan = FAN

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """For nodes a and b of a level: whether some pair below may be linked, as a matrix."""
        _, _, maps, excess, least, most, _ = self.levels[level]
        fits = (100 * most[a][:, None] >= percent * least[b][None, :]) & (100 * most[b][None, :] >= percent * least[a][:, None])
        need = -(-percent * (least[a][:, None] + least[b][None, :]) // (100 + percent))
        spare = np.minimum(excess[a][:, None], excess[b][None, :])
        common = np.array([np.bitwise_count(maps[i] & maps[b]).sum(axis=1) for i in a]).reshape(len(a), len(b))
        return fits & (common + spare >= need)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def join_self(sets: list[np.ndarray], percent: int, labels: np.ndarray | None = None) -> np.ndarray:
    """A component label for each set, by a dual traversal of the tree with itself.

    Sets that start with one label are known to be connected; pairs of one component are passed over.
    """
    n = len(sets)
    order = np.array(sorted(range(n), key=lambda i: (len(sets[i]), sets[i][0] if len(sets[i]) else 0)), np.int64)
    sets = [sets[i] for i in order]
    label = np.unique(labels[order], return_inverse=True)[1] if labels is not None else np.arange(n)
    size = max(int(np.median([len(s) for s in sets])) if n else 1, 4)
    tree = SignatureTree(sets, 1 << (16 * size - 1).bit_length())
    top = len(tree.levels) - 1
    stack = [(top, 0, 0)] if n > 1 else []
    while stack:
        level, x, y = stack.pop()
        lo, hi = tree.levels[level][0], tree.levels[level][1]
        a, b = label[lo[x]:hi[x]], label[lo[y]:hi[y]]
        if (a == a[0]).all() and (b == a[0]).all():
            continue
        cut = tree.levels[level][6]
        p, q = np.arange(cut[x], cut[x + 1]), np.arange(cut[y], cut[y + 1])
        ok = tree.possible(level - 1, p, q, percent)
        if x == y:
            ok = np.triu(ok, 1 if level == 1 else 0)
        if level > 1:
            # the diagonal comes off the stack first: it connects most of what can be
            pairs = [(level - 1, p[i], q[j]) for i, j in zip(*np.nonzero(ok))]
            stack.extend(sorted(pairs, key=lambda s: s[1] == s[2]))
            continue
        for i, j in zip(*np.nonzero(ok & (label[p][:, None] != label[q][None, :]))):
            u, v = p[i], q[j]
            if label[u] != label[v] and linked(sets[u], sets[v], percent):
                label[label == label[v]] = label[u]
    out = np.empty(n, np.int64)
    out[order] = label
    return out


def _task(pdf: pd.DataFrame, size: int, percent: int) -> pd.DataFrame:
    """Edges that connect what is linked within each family of a task; `known` labels what was connected before."""
    hasher, a, b = WordHasher(~_SPACES), [], []
    for _, family in pdf.groupby("family", sort=False):
        family = family.drop_duplicates("cid")
        sets = [s for texts in text_chunks(pa.array(family.text, pa.binary())) for s in shingle_sets(texts, size, hasher)]
        known = family.known.to_numpy() if "known" in family else None
        label, cid = join_self(sets, percent, known), family.cid.to_numpy()
        heads = {}
        for x, c in zip(label, cid):
            h = heads.setdefault(x, c)
            if h != c:
                a.append(c)
                b.append(h)
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _links(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) edges between class ids that connect all linked classes.

    docs: text and h; of a class's rows those with the h of the class stand for it.
    """
    n_classes, n_shingles = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    first_rows = Bloom(classes.select("h"), n_classes)
    # a set is cut twice, into parts for twice this share of the largest set of its band
    places = Places(4 * n_shingles * (100 - percent) * 100 // ((100 + percent) * percent) + 2 * n_classes)
    marks = docs.mapInArrow(lambda b: _marks(b, size, percent, first_rows, places), "bucket long, marks binary")
    repeated = written(marks.groupBy("bucket").applyInArrow(lambda group: places.repeated(group), "place long"), "repeated-places")
    shared = Bloom(repeated, repeated.count())
    discard(repeated)
    keys = docs.mapInArrow(lambda b: _keys(b, size, percent, first_rows, places, shared), "key long, c long, other long")
    stars = keys.repartition("key").sortWithinPartitions("key", "c").mapInArrow(_stars, "a long, b long")
    family = components(stars).select(F.col("node").alias("c1"), F.col("component").alias("family"))
    members = written(classes.join(family, "c1"), "members")  # c1, c2, cid, n, h, family
    sums = members.groupBy("family").agg(F.sum("n").alias("weight"))
    blocks = F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("long")
    total, n_members = members.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, wanted = total or 0, Bloom(members.select("h"), n_members)
    slots = F.lit(-(-total // BLOCK_SHINGLES) or 1)
    placed = members.join(sums, "family").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("cid"), "blocks")).withColumn(
        "slot", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), slots)).otherwise(-1))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A text of each class of a family (and of few others), about once."""
        hasher, seen = WordHasher(~_SPACES), set()
        for texts in _first_texts(batches, wanted):
            digests = [_digest(s) if len(s) else (0, 0) for s in shingle_sets(texts, size, hasher)]
            if len(seen) > SEEN:
                seen.clear()
            keep = []
            for i, digest in enumerate(digests):
                if digest != (0, 0) and digest not in seen:
                    seen.add(digest)
                    keep.append(i)
            c1, c2 = np.array([digests[i] for i in keep], np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(c1), pa.array(c2), pa.array([texts[i] for i in keep], pa.binary())], names=["c1", "c2", "text"])

    texts = docs.mapInArrow(once, "c1 long, c2 long, text binary")
    # the same plan at every size: texts are shuffled also where the members would fit a broadcast; the join leaves
    # the rows of a class together and in order, so the aggregate moves nothing
    at = ["cid", "family", "slot", "block", "blocks"]
    held = placed.select("c1", "c2", *at).hint("merge").join(texts, ["c1", "c2"])
    held = written(held.groupBy("c1", "c2").agg(*[F.first(c).alias(c) for c in [*at, "text"]]).select(*at, "text"), "family-texts")
    schema = "a long, b long"
    # a large family: each block with itself and with the first block
    spread = F.when((F.col("blocks") > 1) & (F.col("block") == 0), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))
    group = F.when(F.col("slot") < 0, F.col("family")).otherwise(0).alias("of")
    first = held.select("cid", "family", "slot", "text", group, F.explode(spread).alias("block")).groupBy("slot", "of", "block").applyInPandas(
        lambda pdf: _task(pdf, size, percent), schema)
    first = written(first, "links")
    large = held.where("blocks > 1").select("cid", "family", "blocks")
    if large.isEmpty():
        discard(held)
        return first
    # of a large family's components the largest need not be compared with itself; all else meets all
    found = components(first).select(F.col("node").alias("cid"), "component")
    known = written(large.join(found, "cid", "left").select("cid", "family", "blocks", F.coalesce("component", "cid").alias("known")), "known")
    counts = known.groupBy("family", "known").count()
    giant = counts.groupBy("family").agg(F.max(F.struct("count", "known")).alias("m")).select("family", F.col("m.known").alias("giant"))
    sides = known.join(giant, "family").withColumn("rest", F.col("known") != F.col("giant"))
    n_rest = sides.where("rest").groupBy("family").agg(F.count(F.lit(1)).alias("n_rest"))
    all_n = sides.groupBy("family").agg(F.count(F.lit(1)).alias("n_all"), F.max("blocks").alias("most"))
    sides = sides.join(n_rest, "family").join(all_n, "family")
    # rest blocks 0 .. r-1, then blocks of the largest component r .. r+g-1
    r = F.ceil(F.col("most") * F.col("n_rest") / F.col("n_all")).cast("long")
    g = F.greatest(F.ceil(F.col("most") * (F.col("n_all") - F.col("n_rest")) / F.col("n_all")).cast("long"), F.lit(1))
    sides = sides.withColumn("r", r).withColumn("g", g).withColumn("at", F.when(F.col("rest"), F.pmod(F.xxhash64("cid"), "r")).otherwise(
        F.col("r") + F.pmod(F.xxhash64("cid"), "g")))
    every = lambda lo, hi: F.sequence(lo, hi)
    zero = F.lit(0).cast("long")
    meets = F.when(F.col("rest"), F.transform(every(zero, F.col("r") + F.col("g") - 1), lambda o: F.struct(
        F.least("at", o).alias("i"), F.greatest("at", o).alias("j")))).otherwise(
        F.transform(every(zero, F.col("r") - 1), lambda o: F.struct(o.alias("i"), F.col("at").alias("j"))))
    second = sides.select("cid", "family", "known", F.explode(meets).alias("m")).join(held.select("cid", "text"), "cid").groupBy(
        "family", "m.i", "m.j").applyInPandas(lambda pdf: _task(pdf, size, percent), schema)
    second = written(second, "links")
    discard(held)
    return first.union(second)


def _id_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def near_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """Per document: rid (a row number), doc_id, n_shingles, component_id, the rid of its component, and key and copy of the row.

    Two documents link when 100 |A & B| >= percent |A | B| over their sets of `size`-word shingles; a
    component is what links connect, named by its smallest doc_id. Fewer words than `size` are
    one shingle; a document without words (null, empty) links with nothing. Missing ids name nothing:
    a component of none but such has a null name. Rows may repeat; equal texts are linked.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    rows = source.withColumn("copy", F.xxhash64("text")).mapInArrow(lambda b: _classes(b, size), "doc_id long, copy long, n long, c1 long, c2 long")
    rows = written(rows.withColumn("rid", F.monotonically_increasing_id()).withColumn("key", _id_key(F.col("doc_id"))), "shingle-classes")
    h = F.xxhash64("key", "copy")
    classes = written(rows.where("n > 0").groupBy("c1", "c2").agg(
        F.min("rid").alias("cid"), F.min("doc_id").alias("first_doc"), F.max("n").alias("n"), F.min(h).alias("h")), "classes")
    texts = source.select("text", F.xxhash64(_id_key(F.col("doc_id")), F.xxhash64("text")).alias("h"))
    edges = _links(texts, classes.select("c1", "c2", "cid", "n", "h"), size, percent)
    label = components(edges).select(F.col("node").alias("cid"), "component")
    named = classes.join(label, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    names = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    of_class = written(named.join(names, "component").select("c1", "c2", "component", "component_id"), "named-classes")
    some = rows.where("n > 0").select("rid", "doc_id", "n", "c1", "c2", "key", "copy").join(of_class, ["c1", "c2"]).select(
        "rid", "doc_id", F.col("n").alias("n_shingles"), "component_id", "component", "key", "copy")
    none = rows.where("n = 0").select("rid", "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("rid").alias("component"), "key", "copy")
    return some.union(none)


def one_of_each(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """One document of each component stays: the one with the smallest doc_id (a missing id comes last).

    Of rows that repeat that id one stays. Documents without words all stay. Columns as they are.
    """
    found = near_components(docs, percent, size)
    keeper = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("k"), F.max("n_shingles").alias("n"))
    # what goes is told apart first: only rows that may be among it are shuffled
    gone = written(found.join(keeper.select(F.col("k.rid").alias("rid"), F.lit(True).alias("stays")), "rid", "left").groupBy("key", "copy").agg(
        F.max("stays").alias("stays"), F.count(F.lit(1)).alias("times"), F.max("n_shingles").alias("n")).where(
        "n > 0 AND (stays IS NULL OR times > 1)").select("key", "copy", "stays", F.xxhash64("key", "copy").alias("h")), "copies")
    filter_ = Bloom(gone.select("h"), gone.count())
    maybe = F.pandas_udf(lambda h: pd.Series(filter_.passes(h.to_numpy())), "boolean")
    rows = packed(docs, without="text", text=F.col("text"), key=_id_key(F.col("doc_id")), copy=F.xxhash64("text"))
    rows = rows.withColumn("maybe", maybe(F.xxhash64("key", "copy")))
    asked = rows.where("maybe").join(gone.select("key", "copy", "stays", F.lit(True).alias("gone")), ["key", "copy"], "left")
    nth = F.row_number().over(Window.partitionBy("key", "copy").orderBy("key"))
    asked = asked.withColumn("nth", F.when(F.col("gone"), nth)).where("gone IS NULL OR (stays AND nth = 1)")
    kept = rows.where("NOT maybe").select("row", "text").union(asked.select("row", "text"))
    return unpacked(kept, docs.columns, text=F.col("text"))
