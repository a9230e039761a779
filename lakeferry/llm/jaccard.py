"""Documents joined by the Jaccard similarity of their word shingles, and their components.

Size-aware heavy-light join. Two sets of sizes s and t that reach the threshold share at least
``need`` = ceil(threshold / (1 + threshold) * (s + t)) shingles, so under any one order of all
shingles they share at least c of the first (s - least need of s + c). With that:

* sets up to a boundary size are light: the c-subsets (c = 2) of that beginning are enumerated, and
  two light sets that are similar share a subset;
* larger sets are heavy: inverted lists of the beginning for c = 1 are scanned for them, in which
  light sets large enough to be partners of a heavy one stand too.

The lists' beginnings are longer than they must be by a twentieth of the set, so that two similar sets
share that many more entries. A set with fewer entries in lists of several sets than this has no
partner and goes before any pair is formed; texts that share a passage only, mostly go here. An entry
counts only if the next smaller or next larger set of its list has a size that allows a link from these
places in the order: most short lists hold sets of sizes far apart and go as soon as they are sorted.

The boundary is where the estimated cost (subsets enumerated plus list entries met) is least. The
order is rare shingles first, by a count sketch over all documents; any order gives all pairs, this
one keeps common passages out of the beginnings.

Only components are needed, so not all pairs of a group are formed. Equal sets are one node. Each
list (split by a salt where the sketch says its shingle is common) first pairs its members with its
most typical one, the one whose shingles are the most common on average: in a group of edited copies
that is the text they were made from. Of longer lists that still hold several components, the most typical
set of the whole list then meets all sets of other components: the texts farthest from the others mostly
resemble that one only, and stood in a part of the list without it. What that leaves in different
components is paired across components. Pairs are cut by sizes, places in the order, the entries they
share there and a parity bitmap that bounds the symmetric difference from below, and counted exactly on
whole sets. No true link is lost by any of these.

Shingles are 64-bit hashes of whole word sequences; sets are told apart by a 64-bit hash as well.

Defined results: null or wordless texts have an empty set and link with nothing; fewer words than
``width`` are one shingle; repeated rows and ids give a row each; a row with a null doc_id links with
nothing and has a null component; no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lakeferry.functions.joins import grouped_lookup
from lakeferry.llm.common import held, id_text, slices
from lakeferry.session import staged

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_STEPS = [pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(16)]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CHUNKS = 64
_BITMAP_WORDS = 16
_SMALL = 64
#: Sets of a list whose pairs are few enough to be formed at once.
_FEW = 8
_SLICE = 1 << 19

_powers: dict[str, np.ndarray] = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers[name]
    while len(have) < n:
        have = np.concatenate((have, have * _U(pow(base, len(have), 1 << 64))))
    _powers[name] = have
    return have[:n]


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" " + b" ".join(coded) + b" ", np.uint8)]
    word = ~_SPACE[data]
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    total = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * _power("up", _P, len(data)), out=total[1:])
    down = _power("down", _P_INVERSE, len(data))
    words = _mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))
    offsets = np.cumsum([0] + [len(c) + 1 for c in coded]) + 1
    bounds = np.searchsorted(starts, offsets)
    rolled = np.zeros(max(0, len(words) - width + 1), _U)
    for k in range(width):
        rolled += words[k : k + len(rolled)] * _U(_STEPS[k])
    rolled = _mix(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            short = np.array([b - a], _U) * _U(_STEPS[15])
            for k in range(b - a):
                short += words[a + k : a + k + 1] * _U(_STEPS[k])
            out.append(_mix(short))
        else:
            out.append(np.zeros(0, _U))
    return out


def set_key(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set, independent of order."""
    total = np.sum(_mix(shingles ^ _U(_STEPS[9])), dtype=_U) + _U(len(shingles))
    return int(_mix(np.array([total], _U)).view(np.int64)[0])


def parity(shingles: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of shingles hash to i: the bitmaps of two sets differ in at
    most as many bits as the sets differ in shingles."""
    bits = _BITMAP_WORDS * 64
    counts = np.bincount((shingles & _U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def least_shared(size: int, threshold: Fraction) -> int:
    """Fewest shingles a set of this size shares with a partner of any size."""
    other = math.ceil(threshold * size)
    return math.ceil(threshold / (1 + threshold) * (size + other))


def _spare(size: int) -> int:
    """Entries a beginning holds beyond those that let two similar sets share one."""
    return size // 20


def _least_entries(size: Column, threshold: Fraction, light: int) -> Column:
    """Entries that a set shares with any partner: one, and the spare ones of the smallest partner
    (sets that may have a light partner are kept with one)."""
    up, down = threshold.numerator, threshold.denominator
    smallest = F.floor((size * up + (down - 1)) / down)
    return F.when(size * up > light * down, F.floor(smallest / 20) + 1).otherwise(1)


def _with_neighbours(
    lists: DataFrame, by_size: WindowSpec, size: Column, place: Column, salted: Column, threshold: Fraction
) -> DataFrame:
    """Entries (key, sig, meta) that may be among the first ones a set shares with a partner.

    Of sets that share ``need`` shingles the k-th shared one has need - k + 1 others at or behind it, and
    1 + ``_spare`` of the smaller one count. So a partner's size is bounded by the place as well, and if
    there is a partner in the list, the next set on its side is near enough too. Parts of salted lists
    do not show all neighbours.
    """
    up, down = threshold.numerator, threshold.denominator
    behind = (size.cast("long") - place + F.floor(size / 20)) * (up + down) - size.cast("long") * up
    below, above = F.lag(size).over(by_size), F.lead(size).over(by_size)
    reached = F.max(behind).over(by_size.rowsBetween(Window.unboundedPreceding, -1))
    return (
        lists.withColumns({"_below": below, "_above": above, "_reached": reached})
        .where(
            salted
            | ((F.col("_below") * down >= size * up) & (F.col("_reached") >= size * up))
            | (F.col("_above") * up <= behind)
        )
        .select("key", "sig", "meta")
    )


def _sets_and_sketch(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """One row a document (kind 0) with key and size, one a short set (kind 2) with its shingles, and
    the task's sketch (kind 1): counters of bounded number, compressed."""

    schema = pa.schema(
        [
            ("kind", pa.int32()),
            ("doc_id", pa.int64()),
            ("size", pa.int32()),
            ("key", pa.int64()),
            ("chunk", pa.int32()),
            ("counts", pa.binary()),
            ("shingles", pa.list_(pa.int64())),
            ("bitmap", pa.list_(pa.int64())),
        ]
    )

    def rows(values: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*values, strict=True))
        return pa.record_batch(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("jaccard", lambda: None)
        counts = np.zeros(1 << bits, np.uint32)
        seen = False
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                sets = shingle_sets(part.column("text").to_pylist(), width)
                out = []
                for doc_id, own in zip(part.column("doc_id").to_pylist(), sets, strict=True):
                    key = set_key(own) if len(own) and doc_id is not None else None
                    bitmap = None if key is None else parity(own)
                    out.append((0, doc_id, len(own), key, None, None, None, bitmap))
                    if key is not None and 2 < len(own) <= _SMALL:
                        out.append((2, None, len(own), key, None, None, own.view(np.int64), None))
                if out:
                    yield rows(out)
                every = np.concatenate(sets)
                np.add.at(counts, (every >> _U(64 - bits)).astype(np.int64), 1)
                seen = seen or len(every) > 0
        if seen:
            small = np.minimum(counts, 255).astype(np.uint8).reshape(_CHUNKS, -1)
            yield rows([(1, None, None, None, i, zlib.compress(c.tobytes(), 1), None, None) for i, c in enumerate(small)])

    return docs.mapInArrow(
        work,
        "kind int, doc_id long, size int, key long, chunk int, counts binary, shingles array<long>,"
        " bitmap array<long>",
    )


def _summed(parts: DataFrame, bits: int, add: bool) -> np.ndarray:
    """Counters (or bits) of all tasks put together, streamed by chunk; at most 2**bits of them."""
    width = (1 << bits) // _CHUNKS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(zlib.decompress(data), np.uint8)
                if add:
                    have = total.setdefault(chunk, np.zeros(width, np.uint64))
                    have += own
                else:
                    have = total.setdefault(chunk, np.zeros(len(own), np.uint8))
                    have |= own
        for chunk, have in total.items():
            if add:  # what is kept of a count is its size class
                have = np.floor(2 * np.log2(have + 1.0)).astype(np.uint8)
            yield pa.record_batch(
                [pa.array([chunk], pa.int32()), pa.array([have.tobytes()], pa.binary())],
                names=["chunk", "counts"],
            )

    found = parts.select("chunk", "counts").repartition(_CHUNKS, "chunk").mapInArrow(
        work, "chunk int, counts binary"
    )
    rows = {r["chunk"]: np.frombuffer(r["counts"], np.uint8) for r in found.collect()}
    size = width if add else width // 8
    return np.concatenate([rows.get(i, np.zeros(size, np.uint8)) for i in range(_CHUNKS)])


def boundary(histogram: dict[int, int], met: float, threshold: Fraction, subset: int) -> int:
    """Largest light size: the least of subsets enumerated plus list entries met. ``met``: mean
    number of entries in the list of a short set's shingle."""
    best, best_cost = 0, math.inf
    for x in range(_SMALL + 1):
        cost = 0.0
        for size, n in histogram.items():
            shared = least_shared(size, threshold)
            if subset <= size <= x:
                cost += n * math.comb(size - shared + subset, subset)
            if size > threshold * x:
                cost += n * (size - shared + 1) * met
        if cost < best_cost:
            best, best_cost = x, cost
    return best


def _signatures(
    docs: DataFrame, width: int, threshold: Fraction, light: int, classes: np.ndarray, common: int
) -> DataFrame:
    """key, sig, meta: the subsets of light sets and the list entries of the others. ``meta`` packs
    size (26 bits), typical (mean size class of the set's shingles, in eighths, 10 bits), salted (one
    bit) and place (26 bits). Rows of a set lie together and differ in two places that touch, sig and
    place, so that a shuffle writes little else of them."""
    bits = int(len(classes)).bit_length() - 1
    shared_classes = docs.sparkSession.sparkContext.broadcast(classes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared_classes.value
        done: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                found = []
                for own in shingle_sets(part.column("text").to_pylist(), width):
                    size = len(own)
                    if size < 3:  # no other set can be similar
                        continue
                    key = set_key(own)
                    if key in done:
                        continue
                    if len(done) < 50_000:
                        done.add(key)
                    shared = least_shared(size, threshold)
                    level = rank[(own >> _U(64 - bits)).astype(np.int64)]
                    about = size << 37 | min(1023, int(level.mean() * 8)) << 27
                    order = np.argsort((level.astype(_U) << _U(56)) | (own >> _U(8)), kind="stable")
                    if size <= light:
                        first = order[: size - shared + 2]
                        a, b = np.triu_indices(len(first), 1)
                        sig = _mix(own[first[a]] * _U(_STEPS[3]) + own[first[b]] * _U(_STEPS[5]))
                        heavy = np.minimum(level[first[a]], level[first[b]]) >= common
                        found.append((sig, key, heavy.astype(np.int64) << 26 | about))
                    if size > threshold * light:
                        first = order[: size - shared + 1 + _spare(size)]
                        heavy = (level[first] >= common).astype(np.int64)
                        found.append((own[first], key, heavy << 26 | about | np.arange(len(first))))
                if found:
                    lens = [len(f[0]) for f in found]
                    yield pa.record_batch(
                        [
                            pa.array(np.repeat(np.array([f[1] for f in found], np.int64), lens)),
                            pa.array(np.concatenate([f[0] for f in found]).view(np.int64)),
                            pa.array(np.concatenate([f[2] for f in found])),
                        ],
                        names=["key", "sig", "meta"],
                    )

    return docs.where("doc_id is not null").select("text").mapInArrow(
        work, "key long, sig long, meta long"
    )


def _bloom(keys: DataFrame, bits: int) -> np.ndarray:
    """Bits set for ids that are wanted; others may be set too, which only costs work."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << bits, bool)
        for batch in batches:
            out[_bloom_at(batch.column(0), bits)] = True
        packed = np.packbits(out, bitorder="little").reshape(_CHUNKS, -1)
        yield pa.record_batch(
            [
                pa.array(range(_CHUNKS), pa.int32()),
                pa.array([zlib.compress(p.tobytes(), 1) for p in packed], pa.binary()),
            ],
            names=["chunk", "counts"],
        )

    parts = keys.coalesce(8).mapInArrow(work, "chunk int, counts binary")
    return _summed(parts, bits, add=False)


def _bloom_at(ids: pa.Array, bits: int) -> np.ndarray:
    values = ids.to_numpy(zero_copy_only=False).astype(np.int64).view(_U)
    return (_mix(values + _U(_STEPS[7])) >> _U(64 - bits)).astype(np.int64)


def _whole_sets(docs: DataFrame, wanted: DataFrame, width: int, bits: int = 24) -> DataFrame:
    """key, shingles of the wanted documents (doc_id, key), and of a few others that the filter lets
    pass; a key may come twice."""
    bloom = docs.sparkSession.sparkContext.broadcast(_bloom(wanted.select("doc_id"), bits))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(bloom.value, bitorder="little").view(bool)
        for batch in batches:
            keep = pa.array(flags[_bloom_at(batch.column("doc_id"), bits)])
            for part in slices(batch.filter(keep), "text", _SLICE):
                sets = shingle_sets(part.column("text").to_pylist(), width)
                yield pa.record_batch(
                    [
                        pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()),
                    ],
                    names=["key", "shingles"],
                )

    return docs.where("doc_id is not null").mapInArrow(work, "key long, shingles binary")


def _may_link(a: str, b: str, threshold: Fraction) -> Column:
    """Sizes whose ratio allows the threshold."""
    low, high = F.least(f"{a}.size", f"{b}.size"), F.greatest(f"{a}.size", f"{b}.size")
    return low * threshold.denominator >= high * threshold.numerator


def _near(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs (a, b and more) whose sizes and bitmaps allow a link; ``sets``: key, size, bitmap."""
    x, y = sets.alias("x"), sets.alias("y")
    return (
        pairs.join(x, F.col("a") == F.col("x.key"))
        .join(y, F.col("b") == F.col("y.key"))
        .where(_may_link("x", "y", threshold) & _bitmaps_allow("x", "y", threshold))
        .select(*pairs.columns)
    )


def _links(
    pairs: DataFrame, docs: DataFrame, named: DataFrame, width: int, threshold: Fraction
) -> DataFrame:
    """Pairs (a, b) of keys that reach the threshold, counted on whole sets, which are made anew
    for the documents of these pairs only; ``named``: doc_id and key of a document of each set."""
    pairs = staged(pairs, "jaccard-pairs")
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    wanted = staged(named.join(keys, "key").select("doc_id", "key"), "jaccard-wanted")
    sets = staged(_whole_sets(docs, wanted, width), "jaccard-whole")
    # few sets are pivots: only theirs go to the first join
    pivots = sets.join(pairs.select(F.col("a").alias("key")).distinct(), "key", "left_semi")
    wide = (
        pairs.join(pivots.select(F.col("key").alias("a"), F.col("shingles").alias("_a")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("_b")), "b")
        .select("a", "b", "_a", "_b")
    )
    up, down = threshold.numerator, threshold.denominator

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("_a"), batch.column("_b"), strict=True):
                s, t = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                shared = len(s) + len(t) - len(np.union1d(s, t))
                keep.append(down * shared >= up * (len(s) + len(t) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return wide.mapInArrow(work, "a long, b long")


def _bitmaps_allow(a: str, b: str, threshold: Fraction) -> Column:
    """The bitmaps differ in at most (1 - t) / (1 + t) of the sizes' sum."""
    most = (1 - threshold) / (1 + threshold)
    differ = F.aggregate(
        F.zip_with(f"{a}.bitmap", f"{b}.bitmap", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, n: total + n,
    )
    return differ * most.denominator <= (F.col(f"{a}.size") + F.col(f"{b}.size")) * most.numerator


def _rooted(rows: DataFrame, root: DataFrame) -> DataFrame:
    """Rows with the root of their key, itself if it has no links; ``root``: see ``components``."""
    found = rows.join(root.withColumnRenamed("node", "key"), "key", "left")
    return found.withColumn("root", F.coalesce("root", "key"))


def _apart(entries: DataFrame, threshold: Fraction, light: int) -> DataFrame:
    """Entries, with the root of their set, of lists that hold more than one component; a set that is
    left with fewer than it shares with any partner has none in another component."""
    of_sig, of_key = Window.partitionBy("sig"), Window.partitionBy("key")
    short_lists = (
        entries.where("not salted")
        .withColumns({"_l": F.min("root").over(of_sig), "_h": F.max("root").over(of_sig)})
        .where("_l < _h")
        .drop("_l", "_h")
    )
    long_lists = entries.where("salted")  # may be too long for one task
    mixed = grouped_lookup(long_lists, ["sig"], F.min("root").alias("_l"), F.max("root").alias("_h")).where("_l < _h")
    return (
        short_lists.unionByName(long_lists.join(mixed.select("sig"), "sig"))
        .withColumn("_n", F.count("*").over(of_key))
        .where(F.col("_n") >= _least_entries(F.col("size"), threshold, light))
        .drop("_n")
    )


def _with_leaders(apart: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs (a, b) that sizes and bitmaps allow of the most typical set of a list and its sets of other
    components: as many as the entries at most. Pairs of short lists come up anyway."""
    leader = F.max(F.struct("typical", "key", "size", "bitmap", "root")).alias("y")
    leaders = grouped_lookup(apart, ["sig"], leader, F.count("*").alias("_n")).where(F.col("_n") > _FEW)
    return (
        apart.alias("x")
        .join(leaders, "sig")
        .where((F.col("x.root") != F.col("y.root")) & _may_link("x", "y", threshold) & _bitmaps_allow("x", "y", threshold))
        .select(F.col("y.key").alias("a"), F.col("x.key").alias("b"))
        .distinct()
    )


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root (the smallest node of its component) for all nodes of edges (a, b).

    Alternating star contraction: every round links neighbours to their least neighbour, first
    larger ones, then smaller ones. Rounds are written to the shared folder.
    """
    spark = edges.sparkSession
    current = staged(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
        "links",
    )
    state = None
    for _ in range(most_rounds):
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        current = staged(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct(),
            "links",
        )
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = now
    raise RuntimeError(f"components of {spark.sparkContext.appName} did not settle")


def join(
    docs: DataFrame,
    *,
    threshold: Fraction = Fraction(3, 4),
    width: int = 5,
    sketch_bits: int = 22,
    salts: int = 64,
) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    docs = id_text(docs)
    first = staged(_sets_and_sketch(docs, width, sketch_bits), "jaccard-sets")
    rows = first.where("kind = 0").select("doc_id", "size", "key", "bitmap")
    classes = _summed(first.where("kind = 1"), sketch_bits, add=True)

    short = first.where("kind = 2").select("key", "size", "shingles").dropDuplicates(["key"])
    histogram = {r["size"]: r["count"] for r in short.groupBy("size").count().collect()}
    lists = short.select(F.explode("shingles").alias("s")).groupBy("s").count()
    met = lists.agg((F.sum(F.col("count") * F.col("count")) / F.sum("count")).alias("met")).first()["met"]
    light = boundary(histogram, met or 1.0, threshold, 2)

    # common: eight times the typical counter, in half powers of two
    common = int(np.median(classes[classes > 0])) + 6 if (classes > 0).any() else 255
    signatures = _signatures(docs, width, threshold, light, classes, common)
    up, down = threshold.numerator, threshold.denominator
    size, place = F.expr("shiftright(meta, 37)").cast("int"), F.expr("meta & 67108863").cast("int")
    salted = F.expr("shiftright(meta, 26) & 1") == 1
    salt = F.when(salted, F.pmod("key", F.lit(salts))).otherwise(F.lit(0)).cast("int")
    mine = Window.partitionBy("sig", "salt")
    by_size = mine.orderBy("meta", "key")
    # the salt is made after the shuffle, which needs not write it
    listed = (
        signatures.repartition("sig", salt)
        .withColumn("salt", salt)
        .withColumns({"_before": F.lag("key").over(by_size), "_least": F.min("key").over(mine), "_most": F.max("key").over(mine)})
        .where((salted | (F.col("_least") < F.col("_most"))) & ~F.col("_before").eqNullSafe(F.col("key")))
        .select("key", "sig", "meta", "salt")
    )
    shared = staged(_with_neighbours(listed, by_size, size, place, salted, threshold), "jaccard-shared")
    entries_of = Window.partitionBy("key")
    typical = F.expr("shiftright(meta, 27) & 1023").cast("int").alias("typical")
    member = F.struct(typical, "key", size.alias("size"))
    entries = staged(
        shared.withColumn("_n", F.count("*").over(entries_of))
        .where(F.col("_n") >= _least_entries(size, threshold, light))
        .select("key", "sig", "meta")
        .repartition("sig", salt)
        .withColumn("salt", salt)
        .withColumn("pivot", F.max(member).over(mine))
        .select("sig", "key", typical, size.alias("size"), place.alias("place"), salted.alias("salted"), "pivot"),
        "jaccard-entries",
    )
    top = entries.where("salted").groupBy("sig").agg(F.max("pivot").alias("top"))
    stars = (
        entries.where("key <> pivot.key")
        .where(F.least("size", "pivot.size") * down >= F.greatest("size", "pivot.size") * up)
        .groupBy(F.col("pivot.key").alias("a"), F.col("key").alias("b"))
        .agg(F.count("*").alias("n"))
    )
    tops = (
        entries.where("salted")
        .select("sig", F.col("pivot.key").alias("b"))
        .distinct()
        .join(top, "sig")
        .where("b <> top.key")
        .select(F.col("top.key").alias("a"), "b")
        .distinct()
    )
    held = rows.where("key is not null")
    named = staged(grouped_lookup(held, ["key"], F.min("doc_id").alias("doc_id")), "jaccard-named")
    sets = staged(
        held.select("key", "size", "bitmap")
        .join(entries.select("key").distinct(), "key", "left_semi")
        .groupBy("key")
        .agg(F.first("size").alias("size"), F.first("bitmap").alias("bitmap")),
        "jaccard-bitmaps",
    )
    # of the pivots a set may link with, the one it meets in most lists; others come up again below
    # if they are in another component
    nearest = _near(stars, sets, threshold).groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a"))
    first_pairs = nearest.select("a", "b").union(_near(tops, sets, threshold)).distinct()
    links = staged(_links(first_pairs, docs, named, width, threshold), "jaccard-links")
    root = components(links)

    # what the stars left apart: lists with more than one component, their members paired with the most
    # typical one, then across components
    bitmaps = sets.select("key", "bitmap")  # joined last, so that they are not shuffled with each entry
    placed = _rooted(entries.select("key", "sig", "typical", "size", "place", "salted"), root)
    apart = staged(_apart(placed, threshold, light).join(bitmaps, "key"), "jaccard-apart")
    led = staged(_links(_with_leaders(apart, threshold), docs, named, width, threshold), "jaccard-links")
    if not led.isEmpty():
        links = links.union(led)
        root = components(links)
        placed = _rooted(apart.drop("root", "bitmap"), root)
        apart = staged(_apart(placed, threshold, light).join(bitmaps, "key"), "jaccard-apart")
    x, y = apart.alias("x"), apart.alias("y")
    need = F.ceil((F.col("x.size") + F.col("y.size")) * F.lit(up) / F.lit(up + down) - F.lit(1e-9))
    rest = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    spare = F.floor(F.least("x.size", "y.size") / 20)
    across = (
        x.join(
            y,
            (F.col("x.sig") == F.col("y.sig"))
            & (F.col("x.key") < F.col("y.key"))
            & (F.col("x.root") != F.col("y.root"))
            & _may_link("x", "y", threshold)
            & (rest + spare >= need)
            & _bitmaps_allow("x", "y", threshold),
        )
        .select(
            F.col("x.key").alias("a"),
            F.col("y.key").alias("b"),
            F.when(F.greatest("x.size", "y.size") > light, spare + 1).otherwise(1).alias("least"),
        )
        .groupBy("a", "b", "least")
        .count()
        .where("count >= least")
        .select("a", "b")
    )
    more = staged(_links(across, docs, named, width, threshold), "jaccard-links")
    if not more.isEmpty():
        root = components(links.union(more))

    member = grouped_lookup(
        named.join(root.withColumnRenamed("node", "key"), "key", "left").select(
            F.coalesce("root", "key").alias("root"), "doc_id"
        ),
        ["root"],
        F.min("doc_id").alias("component_id"),
    )
    of_key = (
        named.select("key")
        .join(root.withColumnRenamed("node", "key"), "key", "left")
        .select("key", F.coalesce("root", "key").alias("root"))
        .join(member, "root")
    )
    full = grouped_lookup(of_key, ["key"], F.first("component_id").alias("component_id"))
    return rows.join(full, "key", "left").select(
        "doc_id",
        F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
