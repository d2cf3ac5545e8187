"""Operator 6, language-model scoring: an interpolated modified Kneser-Ney bigram model.

Counted in Spark. Each task counts the bigrams of some millions of tokens, and sends them, packed, to
buckets by their hash; a bucket adds up and becomes one file of sorted hashes and one of counts in the
shared folder. What words need (count, number of left neighbours, and as a context: total, and followers
seen once, twice, more often) is gathered from the buckets in the same way. Workers memory-map these
files and look up a batch's distinct bigrams in hash order, so memory does not grow with the model, and
files outlive executors. All training text counts; nothing is pruned.

p(w|v) = (max(c(v,w) - D(c), 0) + g(v) p(w)) / c(v),  g(v) = D1 N1(v) + D2 N2(v) + D3 N3+(v)
p(w) = (max(n(w) - D'(n), 0) + g' / (V + 1)) / n(.),  n: distinct left neighbours; V known words and one unknown

Bigrams only: of the 27 million tokens of the smaller check table, 12.1 million bigrams and 18.9 million
trigrams are distinct, so trigrams would more than double the files for contexts that hardly recur.

Defined results: null or empty text: one token, its end; null doc_id: trained on, not held out; no
training text: every token is unknown, p = 1; repeated rows count each; extra columns do not matter.
"""

from __future__ import annotations

import io
import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import WordHashes, mixed, new_folder, shuffle_partitions, small_batches, table, words_of

BUCKET = 2_000_000  # tokens that a bucket holds about
FLUSH = 4_000_000  # tokens that a task counts before it sends
BITS = np.uint64((1 << 48) - 1)
BEGIN, STOP = np.uint64(1), np.uint64(2)
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Of a word: its count, left neighbours, total as a context, followers seen once, twice, more often.
WORD_COLUMNS = ("count", "left", "total", "n1", "n2", "n3")


def bigram(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(mixed(v * A) + w * B)


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """0 to n - 1, in the order of h."""
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def tokens(texts: list[bytes | None], known: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left neighbour and token of every token of all texts, and where each text begins."""
    parts, sizes = [], []
    for x in texts:
        h = known.array(words_of(x)) & BITS
        parts += (h, np.array([STOP]))
        sizes.append(len(h) + 1)
    w = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    first = np.cumsum([0, *sizes[:-1]]) if sizes else np.zeros(0, np.int64)
    v = np.concatenate((np.zeros(1, np.uint64), w[:-1])) if len(w) else w
    v[first] = BEGIN
    return v, w, first


def _six(x: np.ndarray) -> bytes:
    """48-bit values, byte by byte: neighbours in a sorted run share their high bytes."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes()


def _from_six(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(b, np.uint8).reshape(6, -1).T
    return out.reshape(-1).view("<u8")


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(sorted_keys) else np.zeros(0, np.int64)


def _summed(key: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = _runs(key)
    return key[at], [np.add.reduceat(c[order], at) if len(at) else c for c in columns]


def counted(docs: DataFrame, n: int) -> DataFrame:
    """bucket, v, w, c (packed) of the bigrams of the texts of docs."""
    def send(v: list, w: list) -> Iterator[pa.RecordBatch]:
        v, w = np.concatenate(v), np.concatenate(w)
        h = bigram(v, w)
        _, at, c = np.unique(h, return_index=True, return_counts=True)
        v, w, part = v[at], w[at], bucket_of(h[at], n)
        c = c.astype(np.int64)
        order = np.argsort(part << np.uint64(48) | v, kind="stable")
        times = (c + 254) // 255  # a count is a byte; larger ones come in several
        v, w, part, c, times = (x[order] for x in (v, w, part, c, times))
        last = np.cumsum(times) - 1
        byte = np.full(int(times.sum()), 255, np.uint8)
        byte[last] = (c - 255 * (times - 1)).astype(np.uint8)
        v, w, part = (np.repeat(x, times) for x in (v, w, part))
        cuts = np.append(_runs(part), len(part))
        rows = [(int(part[i]), _six(v[i:j]), _six(w[i:j]), byte[i:j].tobytes()) for i, j in zip(cuts, cuts[1:], strict=False)]
        for k in range(0, len(rows), 64):
            some = rows[k : k + 64]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in some], pa.int32()), *(pa.array([r[i] for r in some], pa.binary()) for i in (1, 2, 3))], ["bucket", "v", "w", "c"])

    def run(it):
        known, v, w, held = WordHashes(), [], [], 0
        for b in it:
            x, y, _ = tokens(b.column("text").to_pylist(), known)
            v.append(x)
            w.append(y)
            held += len(x)
            if held >= FLUSH:
                yield from send(v, w)
                v, w, held = [], [], 0
        if held:
            yield from send(v, w)

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "bucket int, v binary, w binary, c binary")


def save(folder: str, name: str, values: np.ndarray) -> None:
    """Written beside and moved into place, so a task that runs twice does no harm."""
    fs, at = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(at, recursive=True)
    np.save(out := io.BytesIO(), values)
    with fs.open_output_stream(beside := f"{at}/.{name}-{os.getpid()}-{os.urandom(4).hex()}") as f:
        f.write(out.getbuffer())
    fs.move(beside, f"{at}/{name}.npy")


@lru_cache(maxsize=4096)
def load(folder: str, name: str) -> np.ndarray | None:
    """The array, memory-mapped; None if there is none. A store that cannot be mapped is copied, file by file, as needed."""
    fs, at = pyarrow.fs.FileSystem.from_uri(folder)
    path = f"{at}/{name}.npy"
    if fs.get_file_info(path).type == pyarrow.fs.FileType.NotFound:
        return None
    if not isinstance(fs, pyarrow.fs.LocalFileSystem):
        with fs.open_input_stream(path) as f, tempfile.NamedTemporaryFile(suffix=".npy") as copy:
            while block := f.read(1 << 24):
                copy.write(block)
            copy.flush()
            return np.load(copy.name, mmap_mode="r")  # the mapping outlives the name, and goes with the worker
    return np.load(path, mmap_mode="r")


def _grouped(it: Iterator[pa.RecordBatch], key: str, columns: tuple[str, ...]) -> Iterator[tuple[int, list[list]]]:
    """Of rows sorted by key: each key with the values of its rows."""
    now, held = None, [[] for _ in columns]
    for b in it:
        for k, *values in zip(*(b.column(c).to_pylist() for c in (key, *columns)), strict=True):
            if k != now and now is not None:
                yield now, held
                held = [[] for _ in columns]
            now = k
            for h, x in zip(held, values, strict=True):
                h.append(x)
    if now is not None:
        yield now, held


def _counts_of(c: np.ndarray) -> list[int]:
    return [int((c == i).sum()) for i in (1, 2, 3, 4)]


def bigram_files(rows: DataFrame, folder: str, parts: int) -> DataFrame:
    """Writes each bucket's arrays; returns part, word, facts (packed, by word) and, in part -1, how many bigrams occur 1, 2, 3, 4 times.

    A task adds up the words of its buckets before it sends them, so what it sends are as many rows as there are parts,
    however many buckets it has.
    """
    def send(word: np.ndarray, facts: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
        part = bucket_of(word << np.uint64(16), parts).astype(np.int64)
        packed = np.stack(facts, 1)
        packed = packed.astype("<u4" if packed.max(initial=0) < 1 << 32 else "<u8")
        cuts = np.append(_runs(part), len(part))
        out = [(int(part[i]), _six(word[i:j]), packed[i:j].tobytes()) for i, j in zip(cuts, cuts[1:], strict=False)]
        out.append((-1, b"", counts.astype("<u8").tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), *(pa.array([r[i] for r in out], pa.binary()) for i in (1, 2))], ["part", "word", "facts"])

    def run(it):
        held, counts = None, np.zeros(4, np.int64)
        for bucket, (vs, ws, cs) in _grouped(it, "bucket", ("v", "w", "c")):
            v, w = (np.concatenate([_from_six(x) for x in xs]) for xs in (vs, ws))
            c = np.concatenate([np.frombuffer(x, np.uint8) for x in cs]).astype(np.int64)
            h = bigram(v, w)
            order = np.argsort(h, kind="stable")
            at = _runs(h[order])
            c = np.add.reduceat(c[order], at)
            v, w = v[order][at], w[order][at]
            save(folder, f"bigram-{bucket}", h[order][at])
            save(folder, f"bigram-{bucket}-n", c.astype(np.uint32 if c.max(initial=0) < 1 << 32 else np.int64))
            one, zero = np.ones_like(c), np.zeros_like(c)
            right = [c, one, zero, zero, zero, zero]
            left = [zero, zero, c, (c == 1).astype(np.int64), (c == 2).astype(np.int64), (c > 2).astype(np.int64)]
            now = _summed(np.concatenate((w, v)), [np.concatenate(x) for x in zip(right, left, strict=True)])
            held = now if held is None else _summed(np.concatenate((held[0], now[0])), [np.concatenate(x) for x in zip(held[1], now[1], strict=True)])
            counts += np.array(_counts_of(c))
            if len(held[0]) >= FLUSH:
                yield send(*held, counts)
                held, counts = None, np.zeros(4, np.int64)
        if held is not None:
            yield send(*held, counts)

    by = rows.repartition(shuffle_partitions(rows.sparkSession), "bucket").sortWithinPartitions("bucket")
    return by.mapInArrow(run, "part int, word binary, facts binary")


def word_files(rows: DataFrame, folder: str) -> dict[str, int]:
    """Writes the arrays of words; returns the model's totals."""
    names = ["tokens", "words", "pairs", *(f"b{i}" for i in range(1, 5)), *(f"u{i}" for i in range(1, 5)), "u_all"]

    def run(it):
        for part, (words, facts) in _grouped(it, "part", ("word", "facts")):
            total = dict.fromkeys(names, 0)
            if part < 0:
                for x in facts:
                    for i, y in enumerate(np.frombuffer(x, "<u8")):
                        total[f"b{i + 1}"] += int(y)
            else:
                word = np.concatenate([_from_six(x) for x in words])
                # 4 bytes a number, or 8 where one needs it
                wide = ["<u8" if len(y) == 8 * len(x) else "<u4" for x, y in zip(words, facts, strict=True)]
                f = np.concatenate([np.frombuffer(y, k).reshape(-1, 6).astype(np.int64) for y, k in zip(facts, wide, strict=True)])
                word, f = _summed(word, list(f.T))
                save(folder, f"word-{part}", word)
                save(folder, f"word-{part}-n", np.stack(f, 1))
                seen = f[0] > 0  # all but the begin of a text
                total |= {"tokens": int(f[0].sum()), "words": int(seen.sum()), "pairs": int(f[1].sum()), "u_all": int(seen.sum())}
                total |= {f"u{i + 1}": x for i, x in enumerate(_counts_of(f[1]))}
            yield pa.RecordBatch.from_pylist([total], schema=pa.schema([(k, pa.int64()) for k in names]))

    by = rows.repartition(shuffle_partitions(rows.sparkSession), "part").sortWithinPartitions("part")
    each = by.mapInArrow(run, ", ".join(f"{k} long" for k in names))
    return {k: v or 0 for k, v in each.agg(*[F.sum(k).alias(k) for k in names]).first().asDict().items()}


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """For counts 0, 1, 2, 3 and more. Where too little is counted to estimate one, a half, as often used."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    d = [k - (k + 1) * y * b / a if a and b else 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *(min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), d, strict=True))])


class Model:
    """What a worker needs to look up: the folder, the numbers of files of bigrams and of words, the totals."""

    def __init__(self, folder: str, n: int, parts: int, total: dict[str, int]):
        self.folder, self.n, self.parts, self.total = folder, n, parts, total
        self.two = discounts(*(total[f"b{i}"] for i in range(1, 5)))
        self.one = discounts(*(total[f"u{i}"] for i in range(1, 5)))

    def _found(self, kind: str, keys: np.ndarray, buckets: np.ndarray, width: int) -> np.ndarray:
        """The values of sorted distinct keys; 0 where there is none."""
        out = np.zeros((len(keys), width), np.int64)
        cuts = np.append(_runs(buckets), len(keys))
        for i, j in zip(cuts, cuts[1:], strict=False):
            there = load(self.folder, f"{kind}-{int(buckets[i])}")
            if there is not None and len(there):
                at = np.minimum(np.searchsorted(there, keys[i:j]), len(there) - 1)
                hit = there[at] == keys[i:j]
                values = load(self.folder, f"{kind}-{int(buckets[i])}-n")
                out[i:j][hit] = values[at[hit]].reshape(-1, width)
        return out

    def words(self, keys: np.ndarray) -> np.ndarray:
        return self._found("word", keys, bucket_of(keys << np.uint64(16), self.parts), len(WORD_COLUMNS))

    def scored(self, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token: log10 p(w|v), and the training count of w."""
        t = self.total
        known, back = np.unique(np.concatenate((w, v)), return_inverse=True)
        facts = self.words(known)
        fw, fv = facts[back[: len(w)]], facts[back[len(w) :]]
        pairs, back = np.unique(bigram(v, w), return_inverse=True)
        c = self._found("bigram", pairs, bucket_of(pairs, self.n), 1)[:, 0][back]
        u3 = t["u_all"] - t["u1"] - t["u2"]
        rest = self.one[1] * t["u1"] + self.one[2] * t["u2"] + self.one[3] * u3
        left = fw[:, 1]
        p = (np.maximum(left - self.one[np.minimum(left, 3)], 0) + rest / (t["words"] + 1)) / max(t["pairs"], 1)
        if not t["pairs"]:
            p = np.ones(len(w))
        g = fv[:, 3] * self.two[1] + fv[:, 4] * self.two[2] + fv[:, 5] * self.two[3]
        full = (np.maximum(c - self.two[np.minimum(c, 3)], 0) + g * p) / np.maximum(fv[:, 2], 1)
        return np.log10(np.where(fv[:, 2] > 0, full, p)), fw[:, 0]


def fit(docs: DataFrame) -> Model:
    """Counts the texts of docs and writes the model's files in the shared folder."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = shuffle_partitions(spark)
    # a bucket's bigrams fit a task's memory: about BUCKET tokens, a word being 6 bytes or so
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    n = max(4 * parts, size // (6 * BUCKET))
    folder = new_folder(spark, "kneser-ney")
    folder = folder if "://" in folder else f"file://{folder}"
    return Model(folder, n, parts, word_files(bigram_files(counted(docs, n), folder, parts), folder))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every document; further columns of docs before text are kept."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # totals and a path
    keep = [f for f in docs.schema if f.name != "text"]
    out = pa.schema([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(it):
        m, known = sent.value, WordHashes()
        n, size = m.total["tokens"], m.total["words"]
        for b in it:
            if not b.num_rows:
                continue
            v, w, first = tokens(b.column("text").to_pylist(), known)
            logp, c = m.scored(v, w)
            base = np.log10((c + 0.5) / (n + 0.5 * (size + 1)))
            sums = [np.diff(np.append(first, len(w))), np.add.reduceat((c > 0).astype(np.int64), first), np.full(len(first), n), np.add.reduceat(base, first), np.add.reduceat(logp, first)]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in keep), *(pa.array(x, t.type) for x, t in zip(sums, out, strict=True))], [*(f.name for f in keep), *out.names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ", n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(run, schema)


def fold(doc_id: Column | str, n: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % n


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("held_out", F.coalesce(fold("doc_id", 5) == 1, F.lit(False)))
    return scores(docs.select("doc_id", "held_out", "text"), fit(docs.filter("not held_out")))


QUERIES = {"op6_kneser_ney": op6_kneser_ney}
