"""Rule labels, kinds, quantities, windows and chunks of texts; all but the chunks are functions of a column."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.functions.measures import meeting
from docloom.operators.claims import once

NEAR = 24  # characters between the two cues of a rule
#: label: two cues that must come near each other, in any order
PROBLEMS = {
    "power_consumption": ("power|energy", "consum|high|increas"),
    "data_transfer_latency": ("latency|delay|slow", "data|transfer|read|write"),
    "bandwidth_limit": ("bandwidth|throughput", "limit|insufficient|low"),
    "reliability_issue": ("reliab|endurance", "degrad|poor|declin"),
    "performance_limit": ("performance|speed", "limit|degrad|poor"),
    "error_risk": ("error|fault", "occur|rate|risk|more"),
    "data_loss_risk": ("data|record", "lost|loss|corrupt"),
    "resource_overhead": ("memory|area|resource|cost", "overhead|waste|large"),
}
EFFECTS = {
    "power_reduction": ("power|energy", "reduc|sav|less"),
    "bandwidth_increase": ("bandwidth|throughput", "increas|improv|high"),
    "latency_reduction": ("latency|delay", "reduc|short|less"),
    "reliability_improvement": ("reliab|endurance", "improv|increas|better"),
    "performance_improvement": ("performance|speed", "improv|increas|better"),
    "error_reduction": ("error|fault", "reduc|prevent|fewer"),
    "data_recovery": ("data|record", "recover|restor"),
    "resource_reduction": ("memory|area|resource|cost", "reduc|sav|less"),
}
# The problem that an effect answers.
DERIVED = {
    "power_reduction": "power_consumption",
    "bandwidth_increase": "bandwidth_limit",
    "latency_reduction": "data_transfer_latency",
    "reliability_improvement": "reliability_issue",
    "performance_improvement": "performance_limit",
    "error_reduction": "error_risk",
    "data_recovery": "data_loss_risk",
    "resource_reduction": "resource_overhead",
}
#: kinds by rank: the first that a text names is its primary one
KINDS = {"device": "device|apparatus|machine|engine", "system": "system|network", "method": "method|approach|way", "process": "process|procedure|step"}
QUANTITY = r"[0-9]+(?:\.[0-9]+)? ?(?:%|mm|nm|km|ms|MHz|GHz|kB|MB|GB)|[0-9]+-[0-9]+"


def near(a: str, b: str) -> str:
    return f"(?i)(?:{a}).{{0,{NEAR}}}(?:{b})|(?:{b}).{{0,{NEAR}}}(?:{a})"


def matched(text: Column, rules: dict[str, tuple[str, str]]) -> Column:
    """The labels whose rule a text meets, in the order of the rules; none for null."""
    return meeting(text, {name: near(*cues) for name, cues in rules.items()})


def of_kind(kind: str, found: Column) -> Column:
    """Labels with the name of their kind."""
    return F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("label")))  # a second argument of the function would be the index


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, problems, effects: without a problem of its own a text has those that its effects answer, 4 at most."""
    rows = once(docs.select("doc_id", "text"), own=matched(F.col("text"), PROBLEMS), effects=matched(F.col("text"), EFFECTS)).drop("text")
    answers = F.create_map(*[F.lit(x) for pair in DERIVED.items() for x in pair])
    derived = F.slice(F.array_distinct(F.transform("effects", lambda e: answers[e])), 1, 4)
    return rows.select("doc_id", F.when(F.size("own") > 0, F.col("own")).otherwise(derived).alias("problems"), "effects")


def kinds(text: Column, head: int = 260) -> tuple[Column, Column]:
    """Primary and secondary kinds named in the head of a text; null and none where it names no kind."""
    start = F.substring(text, 1, head)
    found = F.array_compact(F.array(*[F.when(start.rlike(f"(?i){cue}"), name) for name, cue in KINDS.items()]))
    return F.get(found, F.lit(0)), F.slice(found, 2, len(KINDS))


def quantities(text: Column, most: int = 30) -> Column:
    """The distinct numbers with units and ranges, in the order of the text."""
    return F.slice(F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(QUANTITY), F.lit(0))), 1, most)


def window_of(text: Column, cue: str, before: int = 160, after: int = 900) -> Column:
    """The text around the first match of a cue; null without a match."""
    at = F.regexp_instr(text, F.lit(cue))
    start = F.greatest(at - before, F.lit(1))
    return F.when(at > 0, tx.collapse_space(F.substring(text, start, at + after - start)))


def chunks(parts: DataFrame, budget: int) -> DataFrame:
    """conv_id, chunk_no, first_turn, last_turn, n_chars: turns in order, packed into chunks of up to `budget` characters.

    A turn begins a chunk if the present one has no room for it and a separator. Keys go to partitions and their
    turns stream by in order; only a counter is kept, so a key of any length is no burden on memory.
    """
    schema = "conv_id long, turn long, n long, chunk_no int"

    def run(it):
        key, used, chunk = None, 0, 0
        for b in it:
            numbers = []
            for k, n in zip(b.column("conv_id").to_pylist(), b.column("n").to_pylist(), strict=True):
                if k != key or not chunk:
                    key, used, chunk = k, n, 1
                elif used + 1 + n > budget:
                    used, chunk = n, chunk + 1
                else:
                    used += 1 + n
                numbers.append(chunk)
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), b.column("n"), pa.array(numbers, pa.int32())], ["conv_id", "turn", "n", "chunk_no"])

    sized = parts.select("conv_id", "turn", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"))
    numbered = sized.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "n").mapInArrow(run, schema)
    return numbered.groupBy("conv_id", "chunk_no").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), (F.sum("n") + F.count("*") - 1).alias("n_chars"))


def flag_report(cards: DataFrame, examples: int = 12) -> DataFrame:
    """flag, n, examples: how many documents have each flag, and the first ids that have it."""
    rows = cards.select(F.col("doc_id"), F.explode(F.filter(F.split("qc_flags", ","), lambda x: x != "")).alias("flag"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(64))  # a flag that most documents have is no single task's sort
    first = rows.withColumn("i", F.row_number().over(Window.partitionBy("flag", part).orderBy("doc_id"))).filter(F.col("i") <= examples)
    first = first.withColumn("i", F.row_number().over(Window.partitionBy("flag").orderBy("doc_id"))).filter(F.col("i") <= examples)
    shown = first.groupBy("flag").agg(F.array_join(F.transform(F.sort_array(F.collect_list("doc_id")), lambda x: x.cast("string")), ",").alias("examples"))
    return rows.groupBy("flag").agg(F.count("*").alias("n")).join(shown, "flag")
