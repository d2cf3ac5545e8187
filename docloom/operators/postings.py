"""An index of words with their places, written once and read by every search.

A document belongs to one block of at most BLOCK_DOCS documents of like length, read by one task one after the other; so the
texts are not shuffled. A row of the index is one token in one block: which documents (by their slot in the block), how often, and where; with
the most occurrences and the least document size among them, which bound the token's score in the block. The row of the
empty token has the block's document ids and sizes. Rows are dealt to folders by a hash of the token and a part of the block,
so that a common token is spread, and sorted by token, so that a search reads few row groups.

Phrases of any length are found block by block: the places of the rarest token, kept where each other token stands at its
distance. BM25 needs the number of documents with a phrase, so phrases are counted in all blocks; queries of single
tokens know it beforehand and leave out blocks whose bound is below a score that enough documents reach.

New documents are a further part (add()); a part that no manifest names does not exist. A row of the documents is one
document, repeated or not; null text has no tokens; null ids stay null. A text above a block's size is a block of
its own. Documents should come from files: a task that runs again must read the same rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.sources.store import Files, Manifest, new_name, shared_folder, written

K1, B, FLOOR = 1.2, 0.75, 1e-6  # fixed values of the formula
FORMAT = "2"  # of the index; another one is another folder
BLOCK_DOCS, BLOCK_TOKENS = 8_192, 2_000_000  # documents at most 65,536, as slots have 16 bits
BUCKET_BYTES, MOST_BUCKETS = 32 << 20, 20_000
QUERIES_AT_ONCE = 20_000  # phrases that are searched in one pass
SLOT = 32  # bits of a place below its slot
PARTS = 32  # of a query's hits, ranked apart first
FIRST = 2  # blocks of a query that are searched before others are left out
ROWS = "block long, token string, n int, max_f int, min_size int, slots binary, freqs binary, positions binary, ids array<long>"


def best(scored: DataFrame, top: int) -> DataFrame:
    """Adds rank; the best of parts of a query's hits first, so that no query with many hits is one task's sort."""
    order = (F.desc(F.round("score", 9)), "doc_id")
    part = F.row_number().over(Window.partitionBy("query_id", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))).orderBy(*order))
    some = scored.withColumn("rank", part).filter(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= top)


# --- writing ---

def _packed(values: np.ndarray, starts: np.ndarray, *kinds: type) -> pa.Array:
    """The values from each start to the next one as bytes, in the first of the kinds that holds them all."""
    kind = next(k for k in kinds if k is kinds[-1] or not len(values) or values.max() <= np.iinfo(k).max)
    data = values.astype(kind)
    offsets = (np.append(starts, len(values)) * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def unpacked(n: int, slots, freqs, positions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots, frequencies and places of a row's bytes; the lengths tell how they were packed."""
    slots = np.frombuffer(slots, np.uint16)
    freqs = np.frombuffer(freqs, np.uint8 if len(freqs) == n else np.uint32)
    if not len(positions):  # left out: the token is asked for by itself only
        return slots, freqs, np.empty(0, np.uint16)
    return slots, freqs, np.frombuffer(positions, np.uint16 if len(positions) == 2 * int(freqs.sum(dtype=np.int64)) else np.uint32)


def _rows_of_block(block: int, ids: pa.Array, tokens: pa.ListArray) -> Iterator[pa.RecordBatch]:
    """The head has the number of documents, and of tokens in min_size; its positions are the sizes."""
    sizes = np.asarray(tokens.value_lengths().fill_null(0), dtype=np.int32)
    n = len(sizes)
    names = [x.split()[0] for x in ROWS.split(", ")]
    head = [pa.array([block]), pa.array([""]), *(pa.array([x], pa.int32()) for x in (n, 0, int(sizes.sum()))), pa.array([b""], pa.binary()), pa.array([b""], pa.binary()), pa.array([sizes.tobytes()], pa.binary()), pa.array([ids.to_pylist()], pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_arrays(head, names)
    words = tokens.flatten().dictionary_encode()
    if not len(words):
        return
    codes = words.indices.to_numpy()
    starts = np.concatenate(([0], np.cumsum(sizes[:-1], dtype=np.int64)))
    slot, place = np.repeat(np.arange(n, dtype=np.int32), sizes), (np.arange(len(codes)) - np.repeat(starts, sizes)).astype(np.int32)
    order = np.argsort(codes, kind="stable")  # documents and places stay in order within a token
    codes, slot, place = codes[order], slot[order], place[order]
    new_token = np.flatnonzero(np.diff(codes, prepend=-1))
    pair = np.flatnonzero(np.diff(codes, prepend=-1) | np.diff(slot, prepend=-1))  # a token in a document
    freqs = np.diff(np.append(pair, len(codes))).astype(np.int32)
    at = np.searchsorted(pair, new_token)
    slots = slot[pair]
    counts = np.diff(np.append(at, len(pair))).astype(np.int32)
    columns = [pa.array(np.full(len(at), block)), words.dictionary.take(pa.array(codes[new_token])), pa.array(counts), pa.array(np.maximum.reduceat(freqs, at)), pa.array(np.minimum.reduceat(sizes[slots], at)),
               _packed(slots, at, np.uint16), _packed(freqs, at, np.uint8, np.uint32), _packed(place, new_token, np.uint16, np.uint32), pa.nulls(len(at), pa.list_(pa.int64()))]
    made = pa.RecordBatch.from_arrays(columns, names)
    for k in range(0, len(at), 8_192):
        yield made.slice(k, 8_192)


def _blocks(most_docs: int, most_tokens: int):
    """Rows doc_id, tokens to the rows of blocks; documents of like length (a factor of eight) come together."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held = TaskContext.get().partitionId(), 0, defaultdict(lambda: ([], [], [0, 0]))

        def done(kind: int) -> Iterator[pa.RecordBatch]:
            ids, tokens, _ = held.pop(kind)
            return _rows_of_block((task << 32) + made, pa.concat_arrays(ids), pa.concat_arrays(tokens))

        for b in it:
            ids, tokens = b.column("doc_id"), b.column("tokens")
            sizes = np.asarray(tokens.value_lengths().fill_null(0), dtype=np.int64)
            kinds = np.log2(sizes + 1).astype(np.int64) // 3
            for kind in np.unique(kinds).tolist():
                rows = np.flatnonzero(kinds == kind)
                for some in (rows[k:k + most_docs] for k in range(0, len(rows), most_docs)):
                    more = int(sizes[some].sum())
                    if kind in held and (held[kind][2][0] + len(some) > most_docs or held[kind][2][1] + more > most_tokens):
                        yield from done(kind)
                        made += 1
                    while len(held) > 1 and sum(x[2][1] for x in held.values()) + more > most_tokens:
                        yield from done(max(held, key=lambda x: held[x][2][1]))  # all kinds together hold what a block does
                        made += 1
                    part = held[kind]
                    part[0].append(ids.take(pa.array(some)))
                    part[1].append(tokens.take(pa.array(some)))
                    part[2][0] += len(some)
                    part[2][1] += more
        for kind in sorted(held):
            yield from done(kind)
            made += 1

    return run


def _for_writing(spark: SparkSession) -> dict[str, str | None]:
    """Bounds what an Arrow batch holds, and lets shuffle files go with their query; returns what was set before."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    return before


def _reset(spark: SparkSession, before: dict[str, str | None]) -> None:
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@dataclass
class Index:
    spark: SparkSession
    folder: str

    def state(self) -> dict:
        return Manifest(self.spark, self.folder).state() or {"parts": [], "n_docs": 0, "n_tokens": 0}

    def add(self, docs: DataFrame) -> Index:
        """Writes docs (doc_id, text) as a further part."""
        manifest = Manifest(self.spark, self.folder)
        version = manifest.version()
        state = manifest.state(version) or {"parts": [], "n_docs": 0, "n_tokens": 0}
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tx.search_tokens(F.col("text")).alias("tokens"))
        files = Files(self.spark)
        size = sum(files.size(f) for f in docs.inputFiles())
        buckets = min(MOST_BUCKETS, max(8, ceil(size / BUCKET_BYTES)))
        spread, name = max(1, buckets // 16), new_name("part")
        bucket = F.pmod(F.xxhash64("token", F.pmod(F.xxhash64("block"), F.lit(spread))), F.lit(buckets)).cast("int")
        before = _for_writing(self.spark)
        try:
            rows = docs.mapInArrow(_blocks(BLOCK_DOCS, BLOCK_TOKENS), ROWS).withColumn("bucket", bucket).repartition(buckets, "bucket").sortWithinPartitions("bucket", "token", "block")
            rows.write.option("parquet.block.size", 16 << 20).option("compression", "zstd").partitionBy("bucket").parquet(f"{self.folder}/postings/part={name}")
        finally:
            _reset(self.spark, before)
        sums = self._read([name]).filter("token = ''").agg(F.sum("n").alias("docs"), F.sum("min_size").alias("tokens")).first()
        if not sums.docs:
            return self
        state["parts"].append({"name": name, "buckets": buckets, "spread": spread})
        state["n_docs"] += int(sums.docs)
        state["n_tokens"] += int(sums.tokens)
        manifest.put(state, version)
        return self

    def _read(self, parts: list[str]) -> DataFrame:
        base = f"{self.folder}/postings"
        if not parts:
            return self.spark.createDataFrame([], f"{ROWS}, part string, bucket int")
        return self.spark.read.option("basePath", base).schema(f"{ROWS}, part string, bucket int").parquet(*[f"{base}/part={p}" for p in parts])

    def postings(self, tokens: DataFrame | None = None, heads: bool = False) -> DataFrame:
        """The rows of all parts; of some tokens (column token, a bounded set) if given, with the blocks' heads if asked."""
        rows = self._read([p["name"] for p in self.state()["parts"]])
        if tokens is None:
            return rows
        few = tokens.select("token").distinct()
        if heads:
            few = few.unionByName(self.spark.createDataFrame([("",)], "token string"))
        return rows.join(F.broadcast(few), "token")  # tokens of at most QUERIES_AT_ONCE phrases


def opened(spark: SparkSession, docs: DataFrame, what: str = "documents", folder: str | None = None) -> Index:
    """The index of docs: the one written before for the same files, else a new one in the shared folder.

    what: names what docs are of their files' rows, if that is not the rows themselves.
    """
    files = Files(spark)
    mark = hashlib.sha256("\n".join([FORMAT, what] + sorted(files.stamp(f) for f in docs.inputFiles())).encode()).hexdigest()[:16]
    index = Index(spark, f"{folder or shared_folder(spark)}/index-{mark}")
    return index if index.state()["parts"] else index.add(docs)


# --- searching ---

class Block:
    """One block's postings of the tokens asked for."""

    def __init__(self):
        self.found: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.ids, self.sizes, self.keys = None, None, {}

    def places(self, token: str) -> np.ndarray:
        """Slot and place of each occurrence in one number, rising."""
        if token not in self.keys:
            slots, freqs, positions = self.found[token]
            self.keys[token] = (np.repeat(slots.astype(np.int64), freqs) << SLOT) + positions
        return self.keys[token]

    def count(self, tokens: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the documents that have the tokens in a row, and how often."""
        if len(tokens) == 1:
            return self.found[tokens[0]][:2]
        order = sorted(range(len(tokens)), key=lambda i: len(self.found[tokens[i]][2]))
        begin = self.places(tokens[order[0]]) - order[0]
        for i in order[1:]:
            there = self.places(tokens[i])
            at = np.searchsorted(there, begin + i)
            begin = begin[there[np.minimum(at, len(there) - 1)] == begin + i]
            if not len(begin):
                break
        return np.unique(begin >> SLOT, return_counts=True)


HITS = "phrase_no long, doc_id long, n_tokens int, f long, part string, block long, slot int"


Found = list[tuple[int, np.ndarray, np.ndarray]]  # phrase, slots, how often


def _matches(it: Iterator[pa.RecordBatch], by_rarest: dict[str, list[tuple[int, tuple[str, ...]]]], made: Callable[[tuple, Block, Found], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, block and token (the head first); by_rarest: the phrases (number, tokens) by their rarest token;
    made: the rows that a block with hits gives."""
    now, block = None, Block()

    def hits() -> Iterator[pa.RecordBatch]:
        out = []
        for token in block.found:
            for number, tokens in by_rarest.get(token, ()):
                if all(t in block.found for t in tokens):
                    slots, f = block.count(tokens)
                    if len(slots):
                        out.append((number, slots, f))
        if out:
            yield made(now, block, out)

    for b in it:
        parts, blocks, tokens = (b.column(c).to_pylist() for c in ("part", "block", "token"))
        counts = b.column("n").to_pylist()
        slots, freqs, positions, ids = (b.column(c) for c in ("slots", "freqs", "positions", "ids"))
        for k, key in enumerate(zip(parts, blocks, strict=True)):
            if key != now:
                yield from hits()
                now, block = key, Block()
            if tokens[k] == "":
                block.ids, block.sizes = ids[k].values, np.frombuffer(positions[k].as_buffer(), np.int32)
            else:
                block.found[tokens[k]] = unpacked(counts[k], *(x[k].as_buffer() for x in (slots, freqs, positions)))
    yield from hits()


def _all_hits(key: tuple, block: Block, found: Found) -> pa.RecordBatch:
    number = np.concatenate([np.full(len(s), k) for k, s, _ in found])
    slots, f = np.concatenate([s.astype(np.int32) for _, s, _ in found]), np.concatenate([f.astype(np.int64) for _, _, f in found])
    n = len(slots)
    columns = [pa.array(number), block.ids.take(pa.array(slots)), pa.array(block.sizes[slots]), pa.array(f), pa.array([key[0]] * n, pa.string()), pa.array(np.full(n, key[1])), pa.array(slots)]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in HITS.split(", ")])


def _counts(key: tuple, block: Block, found: Found) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in found], pa.int64()), pa.array([len(s) for _, s, _ in found], pa.int64())], ["phrase_no", "n"])


def _best_of_block(idf: dict[int, float], first: dict[int, int], mean: float, top: int):
    """For each query the `top` best documents of a block. first: a query's first phrase, by phrase."""
    def made(key: tuple, block: Block, found: Found) -> pa.RecordBatch:
        by_query, out = defaultdict(list), []
        for number, slots, f in found:
            by_query[first[number]].append((slots, idf[number] * _share(f.astype(np.float64), block.sizes[slots], mean)))
        ids = block.ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        for number, some in by_query.items():
            slots, weights = (np.concatenate(x) for x in zip(*some, strict=True))
            which = np.unique(slots)
            score = np.bincount(slots, weights, len(ids))[which]
            if len(which) > top:
                order = np.lexsort((ids[which], -np.round(score, 9)))[:top]
                which, score = which[order], score[order]
            out.append((np.full(len(which), number), which.astype(np.int64), score))
        number, slots, score = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(number), block.ids.take(pa.array(slots)), pa.array(score)], ["phrase_no", "doc_id", "score"])

    return made


@dataclass
class Asked:
    """A bounded number of phrases: (number, query id, tokens)."""

    phrases: list[tuple[int, object, tuple[str, ...]]]
    kind: str

    def tokens(self, spark: SparkSession, only=None) -> DataFrame:
        return spark.createDataFrame([(t,) for t in sorted({t for _, _, ts in self.phrases for t in ts if only is None or t in only})], "token string")

    def names(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(n, q) for n, q, _ in self.phrases], f"phrase_no long, query_id {self.kind}")


def _asked(phrases: DataFrame) -> Iterator[Asked]:
    """The different phrases of each query, QUERIES_AT_ONCE at a time."""
    kind, block, number = phrases.schema["query_id"].dataType.simpleString(), [], 0
    for r in phrases.filter(F.size("tokens") > 0).select("query_id", "tokens").distinct().toLocalIterator(prefetchPartitions=True):
        block.append((number, r.query_id, tuple(r.tokens)))
        number += 1
        if len(block) == QUERIES_AT_ONCE:
            yield Asked(block, kind)
            block = []
    if block:
        yield Asked(block, kind)


def _known(index: Index, asked: Asked) -> dict[str, int]:
    """In how many documents each token stands."""
    rows = index.postings(asked.tokens(index.spark)).groupBy("token").agg(F.sum("n").alias("n"))
    return {r.token: r.n for r in rows.collect()}


def _of_blocks(index: Index, asked: Asked, known: dict[str, int], made: Callable, schema: str, only: DataFrame | None = None) -> DataFrame:
    """What `made` gives of each block with hits of the phrases; only: part, block, if not all blocks are wanted."""
    by_rarest: dict[str, list] = defaultdict(list)
    for number, _, tokens in asked.phrases:
        if all(t in known for t in tokens):
            by_rarest[min(tokens, key=lambda t: (known[t], t))].append((number, tokens))
    placed: dict[str, bool] = {"": True}
    for some in by_rarest.values():
        for _, ts in some:
            for t in ts:
                placed[t] = placed.get(t, False) or len(ts) > 1
    # places are sent of those tokens only that stand in a phrase with others
    rows = index.postings().join(F.broadcast(index.spark.createDataFrame(list(placed.items()), "token string, placed boolean")), "token")
    if only is not None:
        rows = rows.join(only, ["part", "block"], "left_semi")
    rows = rows.withColumn("positions", F.when(F.col("placed"), F.col("positions")).otherwise(F.lit(b"")))
    # dealt by a column of its own: a join on the same columns before would make Spark take its partitions, and perhaps split them
    rows = rows.withColumn("deal", F.xxhash64("part", "block")).repartition("deal").sortWithinPartitions("part", "block", "token")
    rows = rows.select("part", "block", "token", "n", "slots", "freqs", "positions", "ids")
    by_rarest = dict(by_rarest)
    return rows.mapInArrow(lambda it: _matches(it, by_rarest, made), schema)


def _hits(index: Index, asked: Asked, known: dict[str, int]) -> DataFrame:
    """Hits of the phrases, with their query_id."""
    return _of_blocks(index, asked, known, _all_hits, HITS).join(F.broadcast(asked.names(index.spark)), "phrase_no")


def _best_of_blocks(index: Index, asked: Asked, known: dict[str, int], numbers: dict[int, int], top: int, only: DataFrame | None = None) -> DataFrame:
    """query_id, doc_id, score: the `top` best documents of each query in each block, the others of which can't be among the best of
    all. asked has its queries whole; numbers: in how many documents each phrase stands."""
    state = index.state()
    mean = state["n_tokens"] / max(state["n_docs"], 1) or 1.0
    idf = {k: max(log((state["n_docs"] - n + 0.5) / (n + 0.5)), 0.0) or FLOOR for k, n in numbers.items()}
    of_query: dict[object, int] = {}
    first = {number: of_query.setdefault(q, number) for number, q, _ in asked.phrases}
    asked = Asked([p for p in asked.phrases if p[0] in numbers], asked.kind)
    found = _of_blocks(index, asked, known, _best_of_block(idf, first, mean, top), "phrase_no long, doc_id long, score double", only)
    names = index.spark.createDataFrame([(number, q) for q, number in of_query.items()], f"phrase_no long, query_id {asked.kind}")
    return found.join(F.broadcast(names), "phrase_no").select("query_id", "doc_id", "score")


def _written(index: Index, rows: DataFrame) -> DataFrame:
    """A search's rows, a few for each query, made with small Arrow batches: one of them holds a few tokens' places in a block, not all."""
    before = _for_writing(index.spark)
    try:
        return written(rows, "found")
    finally:
        _reset(index.spark, before)


def _none(index: Index, phrases: DataFrame) -> DataFrame:
    return index.spark.createDataFrame([], f"{HITS}, query_id {phrases.schema['query_id'].dataType.simpleString()}")


def phrase_hits(index: Index, phrases: DataFrame) -> DataFrame:
    """phrases: query_id, tokens (array); equal phrases of a query count once. For each document that has all tokens in a
    row: query_id, phrase_no (of this call), doc_id, n_tokens, f (how often), and the document's place in the index."""
    every = None
    for asked in _asked(phrases):
        found = _hits(index, asked, _known(index, asked))
        every = found if every is None else every.unionByName(found)
    return _none(index, phrases) if every is None else every


def _scores(index: Index, hits: DataFrame, found: DataFrame) -> DataFrame:
    """query_id, doc_id, score: the sum over a query's phrases. found: phrase_no and n, in how many documents it stands."""
    state = index.state()
    mean = state["n_tokens"] / max(state["n_docs"], 1) or 1.0
    n = F.col("n")
    idf = F.log((state["n_docs"] - n + 0.5) / (n + 0.5))
    one = F.when(idf <= 0, FLOOR).otherwise(idf) * _share(F.col("f"), F.col("n_tokens"), mean)
    each = hits.join(found, "phrase_no").withColumn("one", one)
    return each.groupBy("query_id", "part", "block", "slot", "doc_id").agg(F.sum("one").alias("score")).select("query_id", "doc_id", "score", "part", "block")


def _share(f, size, mean: float):
    return f * (K1 + 1) / (f + K1 * (1 - B + B * size / mean))


def scores(index: Index, phrases: DataFrame) -> DataFrame:
    """query_id, doc_id, score of every document that has one of a query's phrases; greater is better."""
    hits = phrase_hits(index, phrases)
    return _scores(index, hits, hits.groupBy("phrase_no").agg(F.count("*").alias("n"))).select("query_id", "doc_id", "score")


def search(index: Index, phrases: DataFrame, top: int = 10) -> DataFrame:
    """query_id, doc_id, score, rank: the best documents of each query, its phrases joined by OR; ties by doc_id.

    Phrases of several tokens are counted in all blocks first; then each block is scored where it is read, and sends its best only.
    A query's phrases are never divided between passes.
    """
    kind, every = phrases.schema["query_id"].dataType.simpleString(), None
    for queries in _whole_queries(phrases, kind, single=False):
        known = _known(index, queries)
        there = [p for p in queries.phrases if all(t in known for t in p[2])]
        numbers = {number: known[ts[0]] for number, _, ts in there if len(ts) == 1}
        if long := [p for p in there if len(p[2]) > 1]:
            counts = _of_blocks(index, Asked(long, kind), known, _counts, "phrase_no long, n long").groupBy("phrase_no").agg(F.sum("n").alias("n"))
            numbers |= {r.phrase_no: r.n for r in _written(index, counts).collect()}  # QUERIES_AT_ONCE or so at most
        found = _written(index, best(_best_of_blocks(index, queries, known, numbers, top), top))
        every = found if every is None else every.unionByName(found)
    return every if every is not None else index.spark.createDataFrame([], f"query_id {kind}, doc_id long, score double, rank int")


def blocks_wanted(index: Index, asked: Asked, known: dict[str, int], top: int) -> tuple[DataFrame, DataFrame]:
    """For queries of single tokens: query_id, part, block of all blocks with one of the tokens, and of those among them
    that can hold one of the `top` best documents.

    A block's bound is the sum of its tokens' bounds. The FIRST blocks of a query by their bounds are searched; if they
    have `top` documents, the score of the last of these is one that every further document must reach.
    """
    spark, state = index.spark, index.state()
    mean = state["n_tokens"] / max(state["n_docs"], 1) or 1.0
    idf = {t: max(log((state["n_docs"] - n + 0.5) / (n + 0.5)), 0.0) or FLOOR for t, n in known.items()}
    terms = spark.createDataFrame([(q, ts[0], idf[ts[0]]) for _, q, ts in asked.phrases if ts[0] in idf], f"query_id {asked.kind}, token string, idf double")
    meta = index.postings(asked.tokens(spark)).select("token", "part", "block", "max_f", "min_size").join(F.broadcast(terms), "token")
    bound = F.sum(F.col("idf") * _share(F.col("max_f"), F.col("min_size"), mean)).alias("bound")
    bounds = meta.groupBy("query_id", "part", "block").agg(bound)
    ranked = bounds.withColumn("k", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "part", "block")))
    first = ranked.filter(F.col("k") <= FIRST).select("query_id", "part", "block")
    reached = best(_word_scores(index, asked, known, first, top), top).filter(F.col("rank") == top).select("query_id", F.col("score").alias("least"))
    may = bounds.join(reached, "query_id", "left").filter(F.col("least").isNull() | (F.col("bound") >= F.col("least") - 1e-8))
    return bounds.select("query_id", "part", "block"), may.select("query_id", "part", "block")


def _word_scores(index: Index, asked: Asked, known: dict[str, int], pairs: DataFrame, top: int) -> DataFrame:
    numbers = {n: known[ts[0]] for n, _, ts in asked.phrases if ts[0] in known}
    return _best_of_blocks(index, asked, known, numbers, top, pairs.select("part", "block").distinct())


def search_words(index: Index, words: DataFrame, top: int = 10) -> DataFrame:
    """As search(), for queries of single tokens (query_id, tokens: one array): blocks that can't matter are left out.

    A query's tokens are never divided between passes, so each pass ranks its queries whole.
    """
    kind, every = words.schema["query_id"].dataType.simpleString(), None
    for queries in _whole_queries(words, kind):
        known = _known(index, queries)
        _, pairs = blocks_wanted(index, queries, known, top)
        found = _written(index, best(_word_scores(index, queries, known, pairs, top), top))
        every = found if every is None else every.unionByName(found)
    return every if every is not None else index.spark.createDataFrame([], f"query_id {kind}, doc_id long, score double, rank int")


def _whole_queries(rows: DataFrame, kind: str, single: bool = True) -> Iterator[Asked]:
    """About QUERIES_AT_ONCE phrases at a time; single: each token of a row is a phrase, else all tokens of a row are one."""
    if single:
        each = rows.select("query_id", F.explode("tokens").alias("t")).select("query_id", F.array("t").alias("tokens"))
    else:
        each = rows.select("query_id", "tokens").filter(F.size("tokens") > 0)
    gathered = each.groupBy("query_id").agg(F.sort_array(F.collect_set("tokens")).alias("phrases"))
    block, number = [], 0
    for r in gathered.toLocalIterator(prefetchPartitions=True):
        for ts in r.phrases:
            block.append((number, r.query_id, tuple(ts)))
            number += 1
        if len(block) >= QUERIES_AT_ONCE:
            yield Asked(block, kind)
            block = []
    if block:
        yield Asked(block, kind)


def search_cards(index: Index, phrases: DataFrame, cards: DataFrame, top: int = 8) -> DataFrame:
    """query_id, doc_id, score, rank: the best of the cards (doc_id, confidence) that the caller's filters left; scores
    are those of the whole collection. Order: score, confidence, id. A query without phrases gets all cards at score 0.

    phrases: query_id, tokens; a query without phrases has a row of empty tokens.
    """
    met = scores(index, phrases).join(cards.select("doc_id", "confidence"), "doc_id")
    order = (F.desc(F.round("score", 9)), F.desc("confidence"), "doc_id")
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).filter(F.col("rank") <= top)
    told = phrases.groupBy("query_id").agg(F.max(F.size("tokens")).alias("most")).filter("most <= 0").select("query_id")
    first = cards.orderBy(F.desc("confidence"), "doc_id").limit(top).agg(F.collect_list(F.struct("confidence", "doc_id")).alias("c"))  # `top` rows
    order = lambda a, b: F.when(a.confidence > b.confidence, -1).when(a.confidence < b.confidence, 1).when(a.doc_id < b.doc_id, -1).otherwise(1)
    listed = first.select(F.posexplode(F.array_sort("c", order)).alias("rank", "c"))
    plain = told.join(F.broadcast(listed)).select("query_id", F.col("c.doc_id").alias("doc_id"), F.lit(0.0).alias("score"), (F.col("rank") + 1).alias("rank"))
    return ranked.select("query_id", "doc_id", "score", "rank").unionByName(plain)
