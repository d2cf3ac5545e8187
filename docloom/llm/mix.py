"""Operator 4, mixing sources to target weights (native): a low-discrepancy schedule of equal-token blocks.

1. targets(): each source's share of the mix by weight, capped at `most` times its size, the excess
   shared again by weight.
2. Every source's documents, in hash order, are one stream of words, cut into blocks of
   `block` words. The stream repeats when the target is larger than the source.
3. schedule(): slot i of the mix sits at frac(i * golden ratio) and falls into the source whose part
   of the cumulative weights covers that point. A source's slots are ranked, and its r-th slot takes
   the r-th block of the repeated stream; the last one takes what is left up to the target.
4. pieces(): slots meet the documents of their block: (slot, document, first word, words).

5. corpus(): the documents with the slots that their words fill.

No step puts a source into one task: prefix sums run over hash buckets of documents and over chunks
of slots, and only their sums are windowed by source. Reruns agree: the order is a hash of doc_id.

Defined results: null or empty texts have size 0 and take 0; null source: a source of its own, last;
repeated rows count each; an empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import free_name, table, word_count, written

WEIGHTS, SHARE, MOST, BLOCK = (5, 2, 1), 1.5, 2.0, 1024
GOLDEN = 0.6180339887498949  # fixed value: the golden ratio's fractional part
CHUNK = 65_536  # slots that are ranked together
CELLS, FEW_SOURCES = 4096, 50_000  # parts of the unit interval; sources whose rows (about 5 MB) may be broadcast
BUCKET_HEX = 3  # documents of a source are summed in 16 ** 3 buckets


def sized(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, source, size (words), the shuffled order (a bucket and a hash within it) and a row number; whole: and doc, all columns of docs.

    Written once, so that words are counted once and the row numbers stay.
    """
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    doc = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if whole else []
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mark.alias("mark"), F.substring(mark, 1, BUCKET_HEX).alias("bucket"), F.monotonically_increasing_id().alias("row"), *doc)


def targets(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target: the level L with sum(min(most * size, L * weight)) = share * all sizes.

    Sources are few, and this holds one row for each.
    """
    w = Window.orderBy(F.col("source").asc_nulls_last())
    by_source = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(w) - 1) % len(weights) + 1))
    by_source = by_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    left_total = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left_weight = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    level = by_source.withColumn("level", left_total / left_weight)
    # the first source, by cap / weight, that stays below its cap sets the level of all that follow
    free = F.min(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)
    return level.select("source", "source_size", "weight", F.least("cap", F.coalesce(free["level"] * F.col("weight"), F.col("cap"))).alias("target"))


def streams(docs: DataFrame) -> DataFrame:
    """Adds start: the first word's place in the source's stream. docs: sized()."""
    sums = docs.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source", "bucket").orderBy("mark", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return docs.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).select("doc_id", "source", "size", "row", (F.col("ahead") + F.col("within")).alias("start"))


def plan_of(goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds words (the target, whole), blocks (of the source) and slots (that the target needs)."""
    words = F.floor(F.col("target") + 0.5).cast("long")
    size = F.col("source_size")
    return goals.withColumns({"words": words, "blocks": F.ceil(size / block).cast("long")}).withColumn(
        "slots", F.when(size > 0, F.floor(F.col("words") / F.greatest(size, F.lit(1))) * F.col("blocks") + F.ceil((F.col("words") % F.greatest(size, F.lit(1))) / block)).otherwise(0).cast("long"))


def schedule(spark: SparkSession, plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """slot, source, block, offset (words before, in the repeated stream), n (words that the slot takes)."""
    up = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    plan = plan.filter("slots > 0").withColumns({"up_to": F.sum("slots").over(up)})
    plan = plan.withColumn("all_slots", F.max("up_to").over(Window.partitionBy()))
    ranges = plan.select("source", "source_size", "words", "blocks", "slots", "all_slots", ((F.col("up_to") - F.col("slots")) / F.col("all_slots")).alias("low"), (F.col("up_to") / F.col("all_slots")).alias("high"))
    total = plan.agg(F.coalesce(F.max("all_slots"), F.lit(0))).first()[0]
    point = (F.col("id") + 1) * F.lit(GOLDEN)
    points = spark.range(total).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("at"))
    # a point meets only the ranges of its cell: equal parts of the interval, as many as sources at least
    sources = plan.count()
    few, cells = sources <= FEW_SOURCES, F.lit(float(max(CELLS, 4 * sources)))
    cell = lambda x: F.floor(F.least(x, F.lit(1 - 1e-12)) * cells)
    spread = ranges.select("source", "slots", "low", "high", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))).alias("cell"))
    points = points.withColumn("cell", cell(F.col("at")))
    hit = points.join(F.broadcast(spread) if few else spread, "cell").filter((F.col("at") >= F.col("low")) & (F.col("at") < F.col("high"))).drop("cell")
    hit = hit.withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    per = hit.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    ahead = per.withColumn("ahead", F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ahead = ahead.select(F.col("source").alias("s"), F.col("chunk").alias("c"), "ahead")
    ranked = hit.withColumn("i", F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")))
    ranked = ranked.join(ahead, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
    ranked = ranked.withColumn("rank", F.col("ahead") + F.col("i") - 1).filter("rank < slots").select("slot", "source", "rank")
    # The points give each source its slots but for a few; those follow at the end.
    got = per.groupBy(F.col("source").alias("s")).agg(F.sum("n").alias("got"))
    short = ranges.join(got, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got < slots")
    rest = short.select("source", F.explode(F.sequence(F.col("got"), F.col("slots") - 1)).alias("rank"), "all_slots").select((F.col("all_slots") + F.col("rank")).alias("slot"), "source", "rank")
    facts = ranges.select(F.col("source").alias("s"), "source_size", "words", "blocks")
    every = ranked.unionByName(rest).join(F.broadcast(facts) if few else facts, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    at = (F.col("rank") % F.col("blocks")).alias("block")
    every = every.select("slot", "source", at, (F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + (F.col("rank") % F.col("blocks")) * block).alias("offset"), "words", "source_size")
    n = F.least(F.lit(block).cast("long"), F.col("source_size") - F.col("block") * block, F.col("words") - F.col("offset"))
    return every.withColumn("n", n).select("slot", "source", "block", "offset", "n")


def pieces(spark: SparkSession, docs: DataFrame, goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix, a row for each slot and document in it: slot, row, doc_id, source, size, first (word of the document), n. Documents of no slot: null slot, n 0. docs: sized()."""
    slots = schedule(spark, plan_of(goals, block), block).select(F.col("source").alias("s"), F.col("block").alias("b"), "slot", F.col("n").alias("slot_n"))
    spread = streams(docs.filter("size > 0")).withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
    met = spread.join(slots, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left")
    low = F.greatest(F.col("block") * block, F.col("start"))
    n = F.when(F.col("slot").isNotNull(), F.greatest(F.lit(0), F.least(F.col("block") * block + F.col("slot_n"), F.col("start") + F.col("size")) - low))
    return met.select("slot", "row", "doc_id", "source", "size", (low - F.col("start")).alias("first"), F.coalesce(n, F.lit(0)).cast("long").alias("n"))


def _with_facts(rows: DataFrame, goals: DataFrame) -> DataFrame:
    facts = goals.select(F.col("source").alias("s"), "source_size", "target")
    return rows.join(F.broadcast(facts) if goals.count() <= FEW_SOURCES else facts, F.col("source").eqNullSafe(F.col("s"))).drop("s")


def mixed(spark: SparkSession, documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for each document."""
    docs = written(sized(documents), "sized")
    goals = written(targets(docs, weights, share, most), "goals")
    taken = pieces(spark, docs, goals, block).groupBy("doc_id", "source", "size", "row").agg(F.sum("n").alias("taken")).drop("row")
    none = docs.filter("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken"))
    return _with_facts(taken.unionByName(none), goals)


def corpus(spark: SparkSession, documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """The documents with all their columns, and their part of the mix: size, source_size, target, taken and slots.

    slots: by slot, which words of the text (first, n) stand there; the mix is the words of all documents by slot and first.
    What documents call size, source_size, target, taken or slots keeps its name, and ours get an underscore before it.
    """
    docs = written(sized(documents, whole=True), "sized")
    goals = written(targets(docs.drop("doc"), weights, share, most), "goals")
    every = pieces(spark, docs.drop("doc"), goals, block).filter("n > 0")
    mine = every.groupBy("row").agg(F.sum("n").alias("taken"), F.sort_array(F.collect_list(F.struct("slot", "first", "n"))).alias("slots"))  # as many as a text has blocks
    rows = docs.select("row", "source", "size", "doc").join(mine, "row", "left")
    none = F.array().cast("array<struct<slot:bigint,first:bigint,n:bigint>>")
    rows = _with_facts(rows.withColumns({"taken": F.coalesce("taken", F.lit(0).cast("long")), "slots": F.coalesce("slots", none)}), goals)
    return rows.select("doc.*", *[F.col(c).alias(free_name(c, documents.columns)) for c in ("size", "source_size", "target", "taken", "slots")])


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark, table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _capped(k: int) -> str:
    """One round of the sharing, in SQL: sources above their cap stop there, and the rest share what is left."""
    return f"""
c{k} as (select source, source_size, weight, cap, done or target > cap as done,
  case when done or target > cap then cap else target end as held from t{k - 1}),
t{k} as (select source, source_size, weight, cap, done,
  case when done then cap else weight * (1.5 * sum(source_size) over () - coalesce(sum(held) filter (done) over (), 0)) / nullif(sum(weight) filter (not done) over (), 0) end as target from c{k})"""


ROUNDS = 40
ORACLE = rf"""
with d as (select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as mark,
    cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, [5.0, 2.0, 1.0][1 + (row_number() over (order by source nulls last) - 1) % 3]::double as weight, 2.0 * source_size::double as cap from s),
t0 as (select source, source_size, weight, cap, false as done, weight * 1.5 * sum(source_size) over () / sum(weight) over () as target from w),
{",".join(_capped(k) for k in range(1, ROUNDS + 1))},
g as (select source, source_size, target, cast(floor(target + 0.5) as bigint) as words from t{ROUNDS}),
p as (select d.doc_id, d.size, g.source_size, g.target, g.words,
    coalesce(sum(d.size) over (partition by d.source order by mark, doc_id, size rows between unbounded preceding and 1 preceding), 0) as start
  from d join g on d.source is not distinct from g.source)
select doc_id, size, source_size, target,
  cast(case when size = 0 then 0 else (words // source_size) * size + greatest(0, least(size, words % source_size - start)) end as bigint) as taken from p
"""
QUERIES = {"op4_mix_sources": op4_mix_sources}
SQL = {"op4_mix_sources": ORACLE}
