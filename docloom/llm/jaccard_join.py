"""Operator 2, n-gram Jaccard join by PartEnum signatures.

A document is its set of word n-gram hashes. Sets are put into size bands; two sets of a band whose
Jaccard similarity reaches the threshold differ in at most k elements. The hash domain is cut into
n1 parts of 3 pieces each with n1 > k / 2, so some part holds at most one difference and two of its three
pieces agree: the signatures are the pairs of pieces of every part, and sufficiently similar
sets share one. A set near the upper end of its band also signs for the bands of its larger partners.

1. One row per document: size, hash and elements of its set. Equal sets are one class from here on.
2. Classes that share a signature form a bucket. Each class is compared with one bucket's smallest class
   first, then with those of its other buckets that are still of another component (stars: linear in the bucket).
3. Only members of different components of a bucket are left to compare. A bucket with many such pairs
   signs anew by an independent cut, and its members meet by both signatures. After `families` cuts, what
   is left (sets just below the threshold) is compared by sketches, in tiles of at most `small` by `small`
   members that Spark deals to tasks; the largest component of a bucket is not compared with itself.
4. Candidates pass size and sketch bounds that lose nothing, then exact intersection of the sets.

Elements are shipped as 48 bits: two of different words agree in about one of 700,000 pairs of sets of 20,000
elements, which counts one element too many there.

Defined results: null or empty texts have an empty set and link with nothing; texts with fewer than n words have
one element, the whole sequence; rows with a null doc_id link like others, but name no component (null if a component
has no other id); repeated rows are equal sets; an empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import Scratch, WordHashes, free_name, mixed, small_batches, table, word_count, words_of, written

RATIO = 1.4  # of the sizes of neighbouring bands
SKETCH = 1024  # bits
WIDE = 4.0  # bits for each element, for pairs about to be compared exactly
SMALL = 4096  # members of a tile; a bucket with more than its square of pairs to compare signs anew
SHORT = np.uint64(16)  # signatures and shipped elements keep 48 bits
FEW_IDS = 1_000_000  # ids that may be broadcast (about 16 MB)
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)


def element_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; the whole sequence as one where words are fewer than n."""
    if not len(hashes):
        return hashes
    size = min(n, len(hashes))
    acc = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        acc = mixed(acc * ODD[i % 5] + hashes[i : len(hashes) - size + 1 + i])
    return np.unique(acc)


@lru_cache
def bands(most: int) -> np.ndarray:
    """Upper ends of the size bands, up to `most` and one beyond."""
    ends = [0, 1]
    while ends[-1] < most:
        ends.append(max(ends[-1] + 1, int(ends[-1] * RATIO)))
    return np.array(ends)


def band_ends(size: int, num: int, den: int) -> list[int]:
    """The bands (by upper end) in which a set of this size signs: its own, and those of partners up to size / threshold."""
    largest = size * den // num
    ends = bands(1 << int(largest).bit_length())
    return [int(x) for x in ends[np.searchsorted(ends, size) : np.searchsorted(ends, largest) + 1]]


@lru_cache(maxsize=4096)
def cut(end: int, num: int, den: int, family: int) -> tuple[int, np.ndarray, np.ndarray]:
    """n1, the lower ends of all pieces of the hash domain, and a tag for each part, for sets of up to `end` elements."""
    k = (den - num) * 2 * end // (den + num)
    n1 = k // 2 + 1 if k else 0
    lows = np.array([(i << 64) // (3 * n1) for i in range(3 * n1)], np.uint64)
    return n1, lows, mixed(np.arange(n1, dtype=np.uint64) * ODD[0] + np.array([end * 64 + family], np.uint64) * ODD[1])


def signatures(elements: np.ndarray, num: int, den: int, family: int = 0) -> np.ndarray:
    """All signatures of a set. family: which independent cut of the domain."""
    if family:
        elements = np.sort(mixed(elements ^ mixed(np.array([family], np.uint64))))
    out = []
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(elements ^ ODD[4]), dtype=np.uint64)))
    for end in band_ends(len(elements), num, den):
        n1, lows, tag = cut(end, num, den, family)
        if n1:
            at = np.append(np.searchsorted(elements, lows), len(elements))
            piece = (sums[at[1:]] - sums[at[:-1]]).reshape(n1, 3)
            for skip, (i, j) in enumerate(((1, 2), (0, 2), (0, 1))):
                out.append(mixed(mixed(piece[:, i] + tag) + mixed(piece[:, j] * ODD[2] + tag) + np.uint64(skip)))
    return np.concatenate(out) >> SHORT if out else np.zeros(0, np.uint64)


def sketch(elements: np.ndarray, share: float = 0.5) -> bytes:
    """Parity of the elements that fall on each bit: two sketches differ in at most as many bits as the sets in elements.

    At least SKETCH bits and `share` as many as elements, a power of 2, so that a longer sketch folds to a shorter one.
    """
    bits = max(SKETCH, 1 << max(int(len(elements) * share) - 1, 0).bit_length())
    return np.packbits((np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of `size` bytes of the same set, as 64-bit words."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, size // 8), axis=0)


def differing(s: list[bytes], t: list[bytes]) -> np.ndarray:
    """For each pair of sketches: the bits in which they differ."""
    return np.array([int(np.bitwise_count(folded(x, n) ^ folded(y, n)).sum()) for x, y in zip(s, t, strict=True) for n in (min(len(x), len(y)),)], np.int64)


def near_bound(n: np.ndarray, m: np.ndarray, num: int, den: int) -> np.ndarray:
    """Most differing elements that two sets of these sizes may have."""
    return (den - num) * (n + m) // (den + num)


def packed(e: np.ndarray) -> bytes:
    """The upper 48 bits of sorted elements."""
    return np.ascontiguousarray(e.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def unpacked(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _hash(e: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(e.tobytes()) - (1 << 63) if len(e) else 0


def set_rows(docs: DataFrame, n: int, key: str | None) -> DataFrame:
    """doc_id, key (if any), n_shingles, cls: the hash of the set, sketch, elements (packed), row: a number of its own once written."""
    keys = [key] if key else []

    def run(it):
        known = WordHashes()
        for b in it:
            sets = [element_set(known.array(words_of(x)), n) for x in b.column("text").to_pylist()]
            made = [pa.array([len(e) for e in sets], pa.int64()), pa.array([_hash(e) for e in sets], pa.int64()), *(pa.array([f(e) for e in sets], pa.binary()) for f in (sketch, packed))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", *keys)), *made], ["doc_id", *keys, "n_shingles", "cls", "sketch", "elements"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keys, F.col("text").cast("binary").alias("text"))
    made = texts.mapInArrow(run, f"doc_id long, {f'`{key}` long, ' if key else ''}n_shingles long, cls long, sketch binary, elements binary")
    return made.withColumn("row", F.monotonically_increasing_id())


def signature_rows(rows: DataFrame, num: int, den: int) -> DataFrame:
    """sig, cls, n for each signature of each set; a task gives a set's only once."""
    def run(it):
        seen: set[int] = set()
        for b in it:
            sig, cls, size = [], [], []
            for h, x in zip(b.column("cls").to_pylist(), b.column("elements").to_pylist(), strict=True):
                if h not in seen:
                    if len(seen) < 1_000_000:
                        seen.add(h)
                    s = signatures(e := unpacked(x), num, den)
                    sig.append(s)
                    cls.append(np.full(len(s), h, np.int64))
                    size.append(np.full(len(s), len(e), np.int32))
            if sig:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(cls)), pa.array(np.concatenate(size))], ["sig", "cls", "n"])

    return rows.select("cls", "elements").mapInArrow(run, "sig long, cls long, n int")


def shared_buckets(rows: DataFrame) -> DataFrame:
    """Of sig, cls, n: the rows of buckets that hold several classes, with the smallest class as center and its size."""
    def run(it):
        """The rows come sorted by sig, cls; a bucket may go on in the next batch, so its first class and last row are kept."""
        last_sig, last_cls, center, center_n = None, 0, 0, 0
        for b in it:
            sig, cls, n = (b.column(c).to_numpy() for c in ("sig", "cls", "n"))
            if not len(sig):
                continue
            new = np.append(last_sig is None or sig[0] != last_sig, sig[1:] != sig[:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
            c = np.where(start >= 0, cls[start], center)
            cn = np.where(start >= 0, n[start], center_n)
            again = ~new & (cls == np.append(last_cls, cls[:-1]))
            keep = (c != cls) & ~again
            last_sig, last_cls, center, center_n = sig[-1], cls[-1], c[-1], cn[-1]
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (sig, cls, n, c, cn)], ["sig", "cls", "n", "center", "center_n"])

    by_sig = rows.repartition("sig").sortWithinPartitions("sig", "cls")
    return by_sig.mapInArrow(run, "sig long, cls long, n int, center long, center_n int")


def sketch_passes(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Of pairs (a, b): those whose sizes and sketches leave the threshold possible; further columns are dropped but `times`."""
    keep_times = ["times"] if "times" in pairs.columns else []

    def run(it):
        for b in it:
            n, m = b.column("n").to_numpy(), b.column("m").to_numpy()
            if not len(n):
                continue
            differ = differing(b.column("s").to_pylist(), b.column("t").to_pylist())
            keep = differ <= near_bound(n, m, num, den)
            yield pa.RecordBatch.from_arrays([pa.array(b.column(c).to_numpy()[keep]) for c in ("a", "b", *keep_times)], ["a", "b", *keep_times])

    left = classes.select(F.col("cls").alias("a"), F.col("n_shingles").alias("n"), F.col("sketch").alias("s"))
    right = classes.select(F.col("cls").alias("b"), F.col("n_shingles").alias("m"), F.col("sketch").alias("t"))
    met = pairs.join(left, "a").join(right, "b").filter(f"least(n, m) * {den} >= greatest(n, m) * {num}")
    return met.select("a", "b", *keep_times, "n", "m", "s", "t").mapInArrow(run, "a long, b long" + (", times long" if keep_times else ""))


def sets_of(full: DataFrame, reps: DataFrame) -> DataFrame:
    """cls, elements of the classes in reps (cls, row): each once."""
    few, reps = reps.count() <= FEW_IDS, reps.select("row")
    return full.select("row", "cls", "elements").join(F.broadcast(reps) if few else reps, "row", "left_semi").select("cls", "elements")


def wide_sketches(sets: DataFrame) -> DataFrame:
    """cls, n_shingles, sketch of sets (cls, elements), with WIDE bits for each element."""
    def run(it):
        for b in it:
            each = [unpacked(x) for x in b.column("elements").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("cls"), pa.array([len(e) for e in each], pa.int64()), pa.array([sketch(e >> SHORT, WIDE) for e in each], pa.binary())], ["cls", "n_shingles", "sketch"])

    return sets.mapInArrow(run, "cls long, n_shingles long, sketch binary")


def linked(full: DataFrame, candidates: DataFrame, classes: DataFrame, num: int, den: int, scratch: Scratch) -> DataFrame:
    """Of the candidates (a, b): those whose sets reach the threshold, exactly. Written as "links"."""
    def run(it):
        for b in it:
            keep = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
                e, f = unpacked(x), unpacked(y)
                both = len(np.intersect1d(e, f, assume_unique=True))
                keep.append(den * both >= num * (len(e) + len(f) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = candidates.select(F.col("a").alias("cls")).unionByName(candidates.select(F.col("b").alias("cls"))).distinct()
    sets = scratch.written(sets_of(full, scratch.written(classes.join(ends, "cls", "left_semi").select("cls", "row"), "reps")), "sets")
    x, y = sets.select(F.col("cls").alias("a"), F.col("elements").alias("x")), sets.select(F.col("cls").alias("b"), F.col("elements").alias("y"))
    # a wide sketch is a tenth of a set, and leaves few pairs but links
    candidates = scratch.written(sketch_passes(candidates.select("a", "b"), scratch.written(wide_sketches(sets), "sets"), num, den), "sets")
    out = scratch.written(candidates.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "links")
    scratch.drop("reps", "sets")
    return out


def torn(members: DataFrame, roots: DataFrame, done: int) -> DataFrame:
    """Of members (sig, cls): those of buckets with more than `done` members and several components, with root; and of the bucket, far and far_root (its last class),
    heavy (pairs of different components), light (members outside of its largest component), main (that one's root) and all_n.

    Of buckets with the same members (told by their number and two 64-bit hashes) one stays: long texts with a passage in
    common meet in many.
    """
    every = members.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    parts = every.groupBy("sig", "root").agg(F.count("*").alias("n"), F.max("cls").alias("last"), F.bit_xor(F.xxhash64("cls")).alias("h"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("k"))
    facts = parts.groupBy("sig").agg(
        F.count("*").alias("n_roots"), F.sum("n").alias("all_n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"), F.max("n").alias("most"),
        F.max("last").alias("far"), F.max_by("root", "last").alias("far_root"), F.max_by("root", "n").alias("main"), F.bit_xor("h").alias("h"), F.bit_xor("k").alias("k")).filter(f"n_roots > 1 and all_n > {done}")
    facts = facts.groupBy("all_n", "h", "k").agg(F.min("sig").alias("sig"), *[F.first(c).alias(c) for c in ("far", "far_root", "main", "most", "squares")])
    facts = facts.select("sig", "far", "far_root", "main", "all_n", (F.col("all_n") - F.col("most")).alias("light"), ((F.col("all_n").cast("double") * F.col("all_n") - F.col("squares")) / 2).alias("heavy"))
    return every.join(facts, "sig")


def compared(left: DataFrame, classes: DataFrame, num: int, den: int, tile: int = SMALL) -> DataFrame:
    """Of torn(): pairs (a, b) of different components that pass the bounds.

    Members outside of a bucket's largest component are compared with all, in tiles of about `tile` by `tile` members, each
    a group of its own: a task holds one tile.
    """
    near = 3  # 64-bit words that are compared first

    def tile_pairs(light: int, alone: bool, cls: np.ndarray, root: np.ndarray, n: np.ndarray, sketches: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """light: how many of the first rows are light; they meet the rows from `light` on, or, in a bucket of one tile, all that follow."""
        size, out = min(map(len, sketches)), []
        bits = np.stack([folded(x, size) for x in sketches])
        begin = 0 if alone else light
        c, r, m = cls[begin:], root[begin:], n[begin:]
        parts = [np.ascontiguousarray(x) for x in (bits[begin:, :near], bits[begin:, near:])]
        for i in range(light):
            from_ = i + 1 if alone else 0
            ok = from_ + np.flatnonzero((r[from_:] != root[i]) & (np.minimum(m[from_:], n[i]) * den >= np.maximum(m[from_:], n[i]) * num))
            left = near_bound(m[ok], n[i], num, den)
            for part, mine in zip(parts, (bits[i, :near], bits[i, near:]), strict=True):
                left = left - np.bitwise_count(part[ok] ^ mine).sum(axis=1, dtype=np.int64)
                ok, left = ok[left >= 0], left[left >= 0]
            if len(ok):
                out.append((np.full(len(ok), cls[i]), c[ok]))
        return out

    def run(it):
        """The rows come sorted by tile and side; a tile that goes on in the next batch waits for its end."""
        held: list[pa.RecordBatch] = []

        def end():
            t = pa.Table.from_batches(held)
            held.clear()
            cls, root, n = (t.column(c).to_numpy() for c in ("cls", "root", "n_shingles"))
            light = int((t.column("side").to_numpy() == 0).sum())
            if 0 < light < len(cls) and (found := tile_pairs(light, t.column("alone")[0].as_py(), cls, root, n, t.column("sketch").to_pylist())):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["a", "b"])

        now = None
        for b in it:
            if not b.num_rows:
                continue
            sig, i, j = (b.column(c).to_numpy() for c in ("sig", "i", "j"))
            cuts = [0, *(np.flatnonzero((sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1).tolist(), b.num_rows]
            for x, y in zip(cuts, cuts[1:], strict=False):
                tile_ = (sig[x], i[x], j[x])
                if held and tile_ != now:
                    yield from end()
                now = tile_
                held.append(b.slice(x, y - x))
        if held:
            yield from end()

    tiles = lambda n: F.greatest(F.lit(1), F.ceil(n / tile)).cast("int")
    rows = left.join(classes.select("cls", "n_shingles", "sketch"), "cls").withColumns({"light_tiles": tiles(F.col("light")), "all_tiles": tiles(F.col("all_n"))})
    cols = ["sig", "i", "j", "side", "alone", "cls", "root", "n_shingles", "sketch"]
    alone = rows.filter("all_tiles = 1").withColumns({"i": F.lit(0), "j": F.lit(0), "side": F.when(F.col("root") == F.col("main"), 1).otherwise(0), "alone": F.lit(True)}).select(cols)
    rows = rows.filter("all_tiles > 1").withColumn("alone", F.lit(False))
    one = rows.filter("root <> main").withColumns({"i": F.pmod(F.xxhash64("cls"), "light_tiles"), "side": F.lit(0)}).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("all_tiles") - 1))).select(cols)
    other = rows.withColumns({"j": F.pmod(F.xxhash64("cls"), "all_tiles"), "side": F.lit(1)}).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("light_tiles") - 1))).select(cols)
    both = alone.unionByName(one).unionByName(other).withColumns({c: F.col(c).cast("long") for c in "ij"})
    return both.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j", "side").mapInArrow(run, "a long, b long")


def again_signed(full: DataFrame, heavy: DataFrame, classes: DataFrame, num: int, den: int, family: int) -> DataFrame:
    """sig, cls, n: members of heavy buckets (sig, cls), signed by their bucket and an independent cut."""
    def run(it):
        for b in it:
            sig, cls, size = [], [], []
            for hs, c, x in zip(b.column("sigs").to_pylist(), b.column("cls").to_pylist(), b.column("elements").to_pylist(), strict=True):
                e = unpacked(x)
                own = signatures(e, num, den, family)
                for h in hs:
                    sig.append(mixed(own ^ mixed(np.array([h], np.int64).view(np.uint64))) >> SHORT)
                    cls.append(np.full(len(own), c, np.int64))
                    size.append(np.full(len(own), len(e), np.int32))
            if sig:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(cls)), pa.array(np.concatenate(size))], ["sig", "cls", "n"])

    reps = classes.join(heavy.select("cls").distinct(), "cls", "left_semi").select("cls", "row")
    by_class = heavy.groupBy("cls").agg(F.collect_set("sig").alias("sigs"))  # no more than a set has signatures
    return by_class.join(sets_of(full, reps), "cls").select("sigs", "cls", "elements").mapInArrow(run, "sig long, cls long, n int")


def jaccard_rows(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, families: int = 3, small: int = SMALL, key: str | None = None) -> tuple[DataFrame, Scratch]:
    """doc_id, key (if any), n_shingles, cls, root (the component's smallest class; null for empty sets) and component_id of every row.

    The tables it reads are the caller's to drop, by the Scratch that comes with it.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    rows = scratch.written(set_rows(docs, n, key), "set-rows")
    full = rows.filter("n_shingles > 0")
    classes = scratch.written(full.groupBy("cls").agg(F.min("row").alias("row"), F.min("doc_id").alias("low_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")), "classes")
    signed = signature_rows(full, num, den)
    small_batches(docs.sparkSession, 16_384)  # rows of three numbers
    buckets = scratch.written(shared_buckets(signed), "buckets")
    small_batches(docs.sparkSession)
    tested: DataFrame | None = None
    roots = scratch.written(classes.select(F.col("cls").alias("node"), F.col("cls").alias("root")).limit(0), "roots")

    def join_by(pairs: DataFrame) -> None:
        """Verifies pairs of different components that were not before, and joins the components of those that link."""
        nonlocal tested, roots
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        pairs = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").filter("coalesce(root_a, a) <> coalesce(root_b, b)").select("a", "b")
        pairs = scratch.written(pairs, "tested")
        if pairs.isEmpty():
            return
        tested = pairs if tested is None else tested.unionByName(pairs)
        more = linked(full, pairs, classes, num, den, scratch)
        if not more.isEmpty():
            old = scratch.folders.pop("roots")
            now = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more), scratch)
            scratch.folders["old"] = old
            scratch.drop("old")
            roots = now
        scratch.drop("links")

    # stars: one center a class first, the one it shares most signatures with; then its other centers, as far as they are of another component
    stars = buckets.filter(f"least(n, center_n) * {den} >= greatest(n, center_n) * {num}").groupBy(F.col("cls").alias("a"), F.col("center").alias("b")).agg(F.count("*").alias("times"))
    stars = scratch.written(sketch_passes(stars, classes, num, den), "stars")
    join_by(stars.groupBy("a").agg(F.max_by("b", F.struct("times", "b")).alias("b")))
    join_by(stars)
    scratch.drop("stars")
    for family in range(1, families + 1):
        members = buckets.select("sig", "cls").unionByName(buckets.select("sig", F.col("center").alias("cls")).distinct())
        left = scratch.written(torn(members, roots, 2), "torn")  # two are compared by the star
        scratch.drop("buckets")
        # a second star, from the other end: it joins most groups of near copies that the first left apart
        join_by(sketch_passes(left.filter("root <> far_root").select(F.col("far").alias("a"), F.col("cls").alias("b")).distinct(), classes, num, den))
        again = scratch.written(torn(left.select("sig", "cls"), roots, 3), "torn-again")  # and three by both
        scratch.drop("torn")
        is_heavy = F.col("heavy") > (float(small) * small if family < families else float("inf"))
        join_by(scratch.written(compared(again.filter(~is_heavy), classes, num, den, small), "compared"))
        heavy = again.filter(is_heavy).select("sig", "cls")
        if heavy.isEmpty():
            break
        buckets = scratch.written(shared_buckets(again_signed(full, heavy, classes, num, den, family)), "buckets")
        scratch.drop("torn-again", "compared")
    named = classes.select("cls", "low_id").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    smallest = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    named = named.join(smallest, "root").select("cls", "root", "component_id")
    keys = [key] if key else []
    alone = rows.filter("n_shingles = 0").select("doc_id", *keys, "n_shingles", "cls", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"))
    return full.select("doc_id", *keys, "n_shingles", "cls").join(named, "cls").select(alone.columns).unionByName(alone), scratch


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, families: int = 3, small: int = SMALL) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for every row; links: den * |A and B| >= num * |A or B|."""
    rows, scratch = jaccard_rows(docs, n, num, den, families, small)
    out = written(rows.select("doc_id", "n_shingles", "component_id"), "components")
    scratch.drop()
    return out


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs, one row of each component: the smallest doc_id (null last), of its rows the one with the smallest hash of all columns. Rows without words all stay."""
    key = free_name("key", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]))
    rows, scratch = jaccard_rows(keyed, n, num, den, key=key)
    first = rows.filter("n_shingles > 0").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key)).alias("first"))
    first = written(first.select("first.doc_id", f"first.{key}").distinct(), "stays")
    again = written(rows.filter("n_shingles > 0").groupBy("doc_id", key).agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", key), "repeated")
    scratch.drop()
    few = first.count() <= FEW_IDS
    at = lambda rows: (keyed[key] == rows[key]) & keyed["doc_id"].cast("long").eqNullSafe(rows["doc_id"])
    worded = keyed.filter(word_count(F.col("text")) > 0)
    kept = worded.join(F.broadcast(first) if few else first, at(first), "left_semi")
    if not again.isEmpty():  # rows alike in all columns
        kept = kept.dropDuplicates(["doc_id", key])
    return kept.drop(key).unionByName(docs.filter(word_count(F.col("text")) == 0))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


ORACLE = r"""
with recursive d as materialized (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') as w from documents),
g as materialized (select doc_id, list_distinct(case when coalesce(len(w), 0) = 0 then []
  when len(w) < 4 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s from d),
k as materialized (select list_sort(s) as s, min(doc_id) as rep, len(any_value(s)) as n from g where len(s) > 0 group by 1),
e as materialized (select rep, n, unnest(s) as x from k),
p as materialized (select a.rep as a, b.rep as b from e a join e b on a.x = b.x and a.rep < b.rep
  where least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 85
  group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
l as (select a, b from p union all select b, a from p),
r(node, root) as (select rep, rep from k union select l.b, r.root from r join l on l.a = r.node),
m as (select node, min(root) as root from r group by node)
select g.doc_id, cast(len(g.s) as bigint) as n_shingles, coalesce(m.root, g.doc_id) as component_id
from g left join k on list_sort(g.s) = k.s and len(g.s) > 0 left join m on m.node = k.rep
"""
QUERIES = {"op2_jaccard_join": op2_jaccard_join}
SQL = {"op2_jaccard_join": ORACLE}
