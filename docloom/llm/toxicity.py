"""Operator 7, toxicity by class-conditional Kneser-Ney models.

Two kinds of models of toxic and of ordinary documents. A character model (orders 1 to ORDER) gives each word a
log-likelihood per character; a word is a sequence of characters between marks, so unseen forms of a toxic stem are
known by their beginning. A word model (orders 1 and 2) knows expressions of several words that are harmless one by one.
Both are interpolated modified Kneser-Ney: the highest order counts occurrences, lower orders count continuations (the
distinct left neighbours of a sequence; a sequence that begins a word or text has none, and counts occurrences). Each class
has its own counts above SHARED characters or one word; below, both back off to the same counts of both classes
together, so what is rare in both says nothing.

A document's features are length-normalised differences of the two log-likelihoods: of characters over the whole text,
over its most toxic word, the second, and its most toxic WINDOW words; of words over its most toxic WINDOW words. One
toxic sentence in a long text stays visible. A logistic regression on rows that the first models have not seen turns
them into a score; then the models are counted again with those rows.

Labels: at most FIT documents of each class for characters, PAIRS for words, by a hash of doc_id, none of more than LONG
bytes (documented bounds for fitting; the counts come from Spark). Everything else covers whole texts of all documents.

Defined results: null or empty text, or text without a letter: features 0, so a score below the threshold; null or
conflicting labels: left out or toxic; null doc_id: not labelled, not held out; no usable labels: score 0 for all; ties and
repeated rows score alike; extra columns do not matter, and keep their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kneser_ney import discounts, fold
from .shared import free_name, small_batches, table

ORDER, SHARED, WINDOW, FIT, PAIRS, LONG, THRESHOLD = 5, 2, 8, 8_000, 400, 1 << 20, 0.3
LETTERS = re.compile(r"[^\W\d_]+")
CACHE = 200_000
P = np.uint64(0x9E3779B97F4A7C15)
BEGIN, STOP = 1, 2  # stand for the beginning and the end of a text among hashes of words


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of ^word$, one after another, and for each its place in its word."""
    text = "".join(f"\x02{w}\x03" for w in words)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    start = np.repeat(np.cumsum(size) - size, size)
    return code, np.arange(len(code)) - start


def _gram_hashes(code: np.ndarray, order: int) -> np.ndarray:
    """For each place: the hash of the `order` characters that end there (of no use where fewer do)."""
    h = np.full(len(code), order, np.uint64)
    for back in range(order - 1, -1, -1):
        shifted = np.concatenate((np.zeros(back, np.uint64), code[: len(code) - back])) if back else code
        h = (h ^ shifted) * P
        h ^= h >> np.uint64(29)
    return h


def gram_counts(words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """order, hash of the gram, of its context (without the last character), of its end (without the first), counts by class, for words with counts by class (n x classes)."""
    code, place = _codes(words)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    weight = np.repeat(counts, size, axis=0)
    out = []
    for k in range(1, ORDER + 1):
        h, end = _gram_hashes(code, k), _gram_hashes(code, k - 1)
        c = np.concatenate((np.zeros(1, np.uint64), end[:-1]))
        ok = place >= max(1, k - 1)  # the first mark is given, not predicted
        h, c, end, n = h[ok], c[ok], end[ok], weight[ok]
        order = np.argsort(h, kind="stable")
        at = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1])) if len(h) else np.zeros(0, np.int64)
        out.append((np.full(len(at), k), h[order][at], c[order][at], end[order][at], np.add.reduceat(n[order], at, axis=0) if len(at) else n))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def pair_counts(texts: list[list[int]], counts: list[int], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """left word, word, counts by class (n x width) of the word pairs of texts of word hashes; counts: each text's class."""
    left = np.concatenate([np.array([BEGIN, *t], np.uint64) for t in texts]) if texts else np.zeros(0, np.uint64)
    word = np.concatenate([np.array([*t, STOP], np.uint64) for t in texts]) if texts else left
    one = np.zeros((len(word), width), np.int64)
    one[np.arange(len(word)), np.repeat(counts, [len(t) + 1 for t in texts])] = 1
    order = np.lexsort((word, left))
    left, word, one = left[order], word[order], one[order]
    at = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (word[1:] != word[:-1]))) if len(left) else np.zeros(0, np.int64)
    return left[at], word[at], np.add.reduceat(one, at, axis=0) if len(at) else one


class Level:
    """One order of a model, in both classes: what each gram keeps of its count after the discount, and what contexts pass on."""

    def __init__(self, gram: np.ndarray, context: np.ndarray, counts: np.ndarray):
        by = np.argsort(gram)
        self.gram, context, counts = gram[by], context[by], counts[by].astype(np.float32)
        self.context, back = np.unique(context, return_inverse=True)
        self.kept, self.total, self.rest = np.zeros_like(counts), np.zeros((len(self.context), 2)), np.zeros((len(self.context), 2))
        for y in (0, 1):
            whole = counts[:, y]
            d = discounts(*[int((whole == i).sum()) for i in (1, 2, 3, 4)])
            self.kept[:, y] = np.maximum(whole - np.where(whole > 0, d[np.minimum(whole, 3).astype(int)], 0), 0)
            np.add.at(self.total[:, y], back, whole)
            np.add.at(self.rest[:, y], back, whole - self.kept[:, y])

    def over(self, p: np.ndarray, gram: np.ndarray, context: np.ndarray) -> np.ndarray:
        """p (n x 2) of the order below, interpolated with this one."""
        if not len(self.gram):
            return p
        j = np.minimum(np.searchsorted(self.context, context), len(self.context) - 1)
        i = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        t = np.where((self.context[j] == context)[:, None], self.total[j], 0)
        n = np.where((self.gram[i] == gram)[:, None], self.kept[i], 0)
        return np.where(t > 0, (n + self.rest[j] * p) / np.maximum(t, 1e-9), p)


def continuations(gram: np.ndarray, counts: np.ndarray, ends: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Of grams: how many of the longer ones (by the hash of their end) each ends, by class; its count where none does."""
    by = np.argsort(gram)
    out = np.zeros((len(gram), longer.shape[1]))
    at = by[np.minimum(np.searchsorted(gram[by], ends), max(len(gram) - 1, 0))] if len(gram) else np.zeros(0, np.int64)
    ok = gram[at] == ends if len(gram) else np.zeros(len(ends), bool)
    for y in range(longer.shape[1]):
        np.add.at(out[:, y], at[ok], (longer[ok, y] > 0).astype(float))
    return np.where(out > 0, out, counts)


def both_classes(counts: np.ndarray) -> np.ndarray:
    return np.repeat(counts.sum(axis=1, keepdims=True), 2, axis=1)


class CharModel:
    """Log-likelihoods of characters in both classes, by interpolation from the shared lowest orders up."""

    def __init__(self, order: np.ndarray, gram: np.ndarray, context: np.ndarray, end: np.ndarray, counts: np.ndarray):
        at = [np.flatnonzero((order == k) & (counts.sum(axis=1) > 0)) for k in range(1, ORDER + 1)]
        self.levels = []
        for k, mine in enumerate(at, 1):
            n = counts[mine]
            if k < ORDER:
                longer, ends = counts[at[k]], end[at[k]]
                if k <= SHARED:
                    n, longer = both_classes(n), both_classes(longer)
                n = continuations(gram[mine], n, ends, longer)
            self.levels.append(Level(gram[mine], context[mine], n))
        self.letters = max(len(at[0]), 1) + 1

    def probabilities(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """p by class of every character of ^word$, and its place in its word."""
        code, place = _codes(words)
        p = np.full((len(code), 2), 1 / self.letters)
        for k, level in enumerate(self.levels, 1):
            h, c = _gram_hashes(code, k), np.concatenate((np.zeros(1, np.uint64), _gram_hashes(code, k - 1)[:-1]))
            at = np.flatnonzero(place >= max(1, k - 1))
            p[at] = level.over(p[at], h[at], c[at])
        return p, place

    def words(self, words: list[str]) -> np.ndarray:
        """Per word: the difference of its two log-likelihoods, by character."""
        p, place = self.probabilities(words)
        ratio = np.log(p[:, 1]) - np.log(p[:, 0])
        ratio[place == 0] = 0
        size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
        return np.add.reduceat(ratio, np.cumsum(size) - size) / (size - 1)


class WordModel:
    """Log-likelihoods of words after words in both classes. Words are numbered: 0 is any that the model does not know."""

    def __init__(self, left: np.ndarray, word: np.ndarray, counts: np.ndarray):
        some = counts.sum(axis=1) > 0
        left, word, counts = left[some], word[some], counts[some]
        self.known = np.unique(np.concatenate((left, word)))
        v, w = (np.searchsorted(self.known, x) + 1 for x in (left, word))
        # one word: continuations by class, over those of both classes, over any word alike
        alone, back = np.unique(w, return_inverse=True)
        zero = np.zeros(len(alone), np.uint64)
        seen = np.zeros((len(alone), 2))
        np.add.at(seen, back, (counts > 0).astype(float))
        every = np.zeros((len(alone), 2))
        np.add.at(every, back, both_classes((counts.sum(axis=1, keepdims=True) > 0).astype(float)) if len(counts) else counts)
        ids = np.arange(len(self.known) + 1, dtype=np.uint64)
        p = np.full((len(ids), 2), 1 / (len(alone) + 1))
        for n in (every, seen):
            p = Level(alone.astype(np.uint64), zero, n).over(p, ids, np.zeros(len(ids), np.uint64))
        self.one = p
        self.two = Level(self.pairs(v, w), v.astype(np.uint64), counts)

    @staticmethod
    def pairs(v: np.ndarray, w: np.ndarray) -> np.ndarray:
        return v.astype(np.uint64) << np.uint64(32) | w.astype(np.uint64)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        return np.where(self.known[at] == hashes, at + 1, 0) if len(self.known) else np.zeros(len(hashes), np.int64)

    def probabilities(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        return self.two.over(self.one[w], self.pairs(v, w), v.astype(np.uint64))

    def ratios(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        p = self.probabilities(v, w)
        return np.log(p[:, 1]) - np.log(p[:, 0])


def word_hash(w: str) -> int:
    return xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))


class Ratios(dict):
    """word -> a place in the arrays of ratios and of word numbers, remembered for words seen before."""

    def __init__(self, chars: CharModel, pairs: WordModel):
        super().__init__()
        self.chars, self.pairs = chars, pairs
        self.ratio, self.number = np.zeros(0), np.zeros(0, np.int64)

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Per text, of the characters' ratios: the mean, the largest, the second largest of another word, the largest mean over WINDOW words; and that of the words' ratios."""
        out, held, size = [], [], 0
        for x in texts:  # some texts at a time, so that memory does not grow with the batch
            held.append(x)
            size += len(x or "")
            if size > 500_000:
                out.append(self._some(held))
                held, size = [], 0
        return np.concatenate([*out, self._some(held)])

    def _some(self, texts: list[str | None]) -> np.ndarray:
        split = [LETTERS.findall(x.lower()) if x else [] for x in texts]
        if len(self) > CACHE:
            self.clear()
            self.ratio, self.number = np.zeros(0), np.zeros(0, np.int64)
        if new := list({w for ws in split for w in ws} - self.keys()):
            self.update(zip(new, range(len(self), len(self) + len(new)), strict=True))
            self.ratio = np.concatenate((self.ratio, *(self.chars.words(new[k : k + 10_000]) for k in range(0, len(new), 10_000))))
            self.number = np.concatenate((self.number, self.pairs.numbers(np.fromiter(map(word_hash, new), np.uint64, len(new)))))
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        out, some = np.zeros((len(texts), 5)), np.flatnonzero(sizes)
        if not len(some):
            return out
        sizes = sizes[some]
        at = np.fromiter((self[w] for ws in split for w in ws), np.int64, int(sizes.sum()))
        r, number, start = self.ratio[at], self.number[at], np.cumsum(sizes) - sizes
        top = np.maximum.reduceat(r, start)
        second = np.maximum.reduceat(np.where(r < np.repeat(top - 1e-12, sizes), r, -np.inf), start)
        # each text's words with its beginning before and its end after them
        text, begin, stop = np.repeat(np.arange(len(some)), sizes), *(int(self.pairs.numbers(np.array([x], np.uint64))[0]) for x in (BEGIN, STOP))
        place = np.arange(len(at)) + text
        v, w = np.full(len(at) + len(some), begin), np.full(len(at) + len(some), stop)
        w[place], v[place + 1] = number, number
        q = self.pairs.ratios(v, w)
        out[some] = np.stack((np.add.reduceat(r, start) / sizes, top, np.where(np.isfinite(second), second, top), best_window(r, start, sizes), best_window(q, start + np.arange(len(some)), sizes + 1)), 1)
        return out


def best_window(values: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text (start and size among values): the largest mean of WINDOW neighbours, or of all where there are fewer."""
    sums = np.concatenate((np.zeros(1), np.cumsum(values)))
    whole = (sums[start + sizes] - sums[start]) / sizes
    at = np.arange(len(values))
    means = np.where(at + WINDOW <= np.repeat(start + sizes, sizes), (sums[np.minimum(at + WINDOW, len(values))] - sums[at]) / WINDOW, -np.inf)
    return np.where(sizes < WINDOW, whole, np.maximum.reduceat(means, start))


def labelled(docs: DataFrame, labels: DataFrame, most: int = FIT, pairs: int = PAIRS) -> DataFrame:
    """text, toxic, later, paired of at most about `most` documents of each class; later: the third of rows that calibrates; paired: those whose word pairs count."""
    one = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    one = one.filter(F.coalesce(fold("doc_id", 4) != 2, F.lit(False)))
    sizes = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect() if r["toxic"] in (0, 1)}
    share, fewer = F.lit(0.0), F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("toxic") == y, F.lit(min(1.0, most / n))).otherwise(share)
        fewer = F.when(F.col("toxic") == y, F.lit(min(1.0, pairs / n))).otherwise(fewer)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    one = one.withColumn("paired", place < fewer).filter(place < share)
    # about 2 * most rows of an id and a label
    met = docs.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONG).join(F.broadcast(one), "doc_id")
    return met.select(F.col("text").cast("string").alias("text"), F.col("toxic").cast("int").alias("toxic"), (fold("doc_id", 4) == 3).alias("later"), "paired")


def counted(rows: DataFrame) -> DataFrame:
    """o (order; 0: a word pair), g, c, e and the counts n0, n1 (first rows), m0, m1 (later rows) of ordinary and toxic documents.

    g, c, e: hashes of a gram, its context and its end; of a pair: 0, the left word and the word.
    """
    names = ["o", "g", "c", "e", "n0", "n1", "m0", "m1"]

    def batch(order, gram, context, end, n):
        return pa.RecordBatch.from_arrays([pa.array(order, pa.int32()), *(pa.array(x.view(np.int64)) for x in (gram, context, end)), *(pa.array(x) for x in n.T.astype(np.int64))], names)

    def grams(it):
        held: dict[str, list[int]] = {}
        for b in it:
            texts, kinds = [], []
            for text, toxic, later, paired in zip(*(b.column(c).to_pylist() for c in ("text", "toxic", "later", "paired")), strict=True):
                ws = LETTERS.findall(text.lower()) if text else []
                for w in set(ws):
                    held.setdefault(w, [0, 0, 0, 0])[2 * later + toxic] += 1
                if paired and ws:
                    texts.append([word_hash(w) for w in ws])
                    kinds.append(2 * later + toxic)
            if texts:
                left, word, n = pair_counts(texts, kinds, 4)
                yield batch(np.zeros(len(left), np.int32), np.zeros(len(left), np.uint64), left, word, n)
        if held:
            yield batch(*gram_counts(list(held), np.array(list(held.values()))))

    each = rows.mapInArrow(grams, "o int, g long, c long, e long, n0 long, n1 long, m0 long, m1 long")
    return each.groupBy("o", "g", "c", "e").agg(*[F.sum(x).cast("int").alias(x) for x in names[4:]])


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, deviation and weights (the last: constant) of a ridge logistic regression by Newton steps."""
    mean, dev = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack(((x - mean) / dev, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    ridge = np.diag([0.1] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return mean, dev, w


class Scorer:
    def __init__(self, chars: CharModel, pairs: WordModel, fit: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.chars, self.pairs, self.fit = chars, pairs, fit

    def scores(self, ratios: Ratios, texts: list[str | None]) -> np.ndarray:
        mean, dev, w = self.fit
        z = (ratios.features(texts) - mean) / dev
        return 1 / (1 + np.exp(-np.clip(z @ w[:-1] + w[-1], -30, 30)))


def models(order: np.ndarray, gram: np.ndarray, context: np.ndarray, end: np.ndarray, counts: np.ndarray) -> tuple[CharModel, WordModel]:
    chars, pairs = order > 0, order == 0
    return CharModel(order[chars], gram[chars], context[chars], end[chars], counts[chars]), WordModel(context[pairs], end[pairs], counts[pairs])


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT) -> Scorer | None:
    """None if the labels do not have both classes."""
    small_batches(docs.sparkSession)
    rows = labelled(docs, labels, most)
    grams = counted(rows).toArrow()  # of a bounded number of documents of bounded length
    given = grams.column("o").to_numpy(), *(grams.column(c).to_numpy().view(np.uint64) for c in "gce")
    n, m = (np.stack([grams.column(c).to_numpy() for c in cs], 1) for cs in (("n0", "n1"), ("m0", "m1")))
    del grams
    if not len(n) or n.sum(axis=0).min() == 0:
        return None
    sent = docs.sparkSession.sparkContext.broadcast(models(*given, n))

    def run(it):
        r = Ratios(*sent.value)
        for b in it:
            f = r.features(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in f.T), b.column("toxic")], ["f0", "f1", "f2", "f3", "f4", "toxic"])

    seen = rows.filter("later").mapInArrow(run, "f0 double, f1 double, f2 double, f3 double, f4 double, toxic int").toPandas()
    y = seen["toxic"].to_numpy().astype(float)
    if len(set(y)) < 2:
        return None
    return Scorer(*models(*given, n + m), logistic(seen[["f0", "f1", "f2", "f3", "f4"]].to_numpy(), y))


def scores(docs: DataFrame, scorer: Scorer | None, name: str = "score") -> DataFrame:
    """docs with a score (0 to 1) under a name that docs do not have; the text is the only input."""
    if scorer is None:
        return docs.withColumn(name, F.lit(0.0))
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(scorer)  # a model of a bounded number of documents

    def run(it):
        r = Ratios(sent.value.chars, sent.value.pairs)
        for b in it:
            yield b.append_column(name, pa.array(sent.value.scores(r, b.column("text").to_pylist())))

    return docs.mapInArrow(run, docs.withColumn(name, F.lit(0.0)).schema)


def ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    name = free_name("score", docs.columns)
    return scores(docs, fit(docs, labels), name).filter(F.col(name) < THRESHOLD).drop(name)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op7_toxicity": op7_toxicity}
