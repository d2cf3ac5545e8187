"""Claims: blocks of a text, parents, quality, choice, and the flags of a pack. Each measure is taken once per text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import rules
from docloom.functions import text as tx
from docloom.functions.measures import measured


def once(rows: DataFrame, **measures: Column) -> DataFrame:
    """rows with columns that are computed once, however often the next step names them (explode() is not inlined)."""
    box = F.explode(F.array(F.struct(*[c.alias(k) for k, c in measures.items()])))
    return rows.withColumn("_once", box).select(*rows.columns, *[F.col(f"_once.{k}").alias(k) for k in measures])


def _named(flags: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(on, name) for name, on in flags.items()]))


def blocks(docs: DataFrame, mark: str = r"(?m)^\s*(\d{1,3})\s*[.、]\s+") -> DataFrame:
    """doc_id, claim_no, text: numbered blocks, each from its number to the next one's."""
    cut = F.split(F.regexp_replace("text", mark, "\u0001$1\u0002"), "\u0001")
    each = docs.select("doc_id", F.posexplode(F.slice(cut, F.lit(2), F.greatest(F.size(cut) - 1, F.lit(0)))).alias("i", "b"))
    return each.select("doc_id", (F.col("i") + 1).alias("block_no"), F.substring_index("b", "\u0002", 1).alias("claim_no"), tx.collapse_space(F.substring_index("b", "\u0002", -1)).alias("text"))


def parent(country: Column, text: Column) -> Column:
    """Number of the claim that a claim refers to, by the first pattern of its country that matches; null for none."""
    def first(patterns):
        return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns])

    return F.when(country == "CN", first(rules.PARENTS["CN"])).when(country == "KR", first(rules.PARENTS["KR"])).otherwise(first(rules.PARENTS[""]))


def audited(claims: DataFrame) -> DataFrame:
    """claims (text, claim_type) with flags, severity and bucket; flags of structure weigh less in a substantive claim."""
    patterns = {"starts": rules.CLAIM_START, "words": rules.CLAIM_WORD, "front": rules.FIGURE_OR_FRONT, "flow": rules.FLOW_STEP, "gibberish": rules.GIBBERISH}
    counted = {"spaces": " ", "marks": r"[^\p{L} ]", "digits": r"\p{Nd}", "bars": r"\|", "dashes": "[—-]"}  # few in a text: each match costs
    rows = once(claims, m=measured(F.col("text"), patterns, counted, short=True, clean=True)).select(*claims.columns, "m.*")
    n = F.col("n_clean")
    rows = rows.withColumns({"solid": n - F.col("spaces"), "letters": n - F.col("spaces") - F.col("marks"), "real": F.col("starts") & F.col("words")})
    on = {
        "very_short_claim_text": n < 80,
        "figure_or_frontmatter_text": F.col("front"),
        "flowchart_step_text": F.col("flow"),
        "ocr_gibberish_terms": F.col("gibberish"),
        "high_symbol_ratio": (F.col("solid") - F.col("letters") - F.col("digits")) / F.greatest(F.col("solid"), F.lit(1)) > 0.24,
        "low_letter_ratio": (F.col("letters") / F.greatest(F.col("solid"), F.lit(1)) < 0.48) & (F.col("solid") >= 120),
        "diagram_line_art": (F.col("bars") >= 4) | (F.col("dashes") >= 14),
        "repeated_short_ocr_tokens": F.col("repeated") >= 18,
        "independent_without_claim_keywords": (F.col("claim_type") == "independent") & (n >= 120) & ~F.col("words"),
        "does_not_start_like_claim": (n >= 120) & ~F.col("starts") & F.col("front"),
    }
    rows = once(rows, found=F.when(n == 0, F.array(F.lit("empty_text"))).otherwise(_named(on)))
    full, less = (F.create_map(*[F.lit(x) for k, w in rules.WEIGHTS.items() for x in (k, w[i])]) for i in (0, 1))
    total = F.aggregate("found", F.lit(0), lambda a, x: a + F.when(F.col("real"), less[x]).otherwise(full[x]))
    rows = once(rows, severity=F.when(n == 0, 100).otherwise(total))
    score = F.col("severity")
    bucket = F.when(score >= 70, "severe").when(score >= 45, "high").when(score >= 25, "medium").when(score > 0, "low").otherwise("ok")
    return rows.select(*claims.columns, F.col("found").alias("flags"), "severity", bucket.alias("bucket"))


def audit_report(audit: DataFrame, key: str = "doc_id", samples: int = 3) -> DataFrame:
    """bucket, n, n_keys (distinct), samples: the first keys of each bucket, found without gathering it."""
    first = audit.select("bucket", key).distinct().withColumn("part", F.pmod(F.xxhash64(key), F.lit(64)))
    some = first.withColumn("i", F.row_number().over(Window.partitionBy("bucket", "part").orderBy(key))).filter(F.col("i") <= samples)
    some = some.withColumn("i", F.row_number().over(Window.partitionBy("bucket").orderBy(key))).filter(F.col("i") <= samples)
    shown = some.groupBy("bucket").agg(F.array_join(F.transform(F.sort_array(F.collect_list(key)), lambda x: x.cast("string")), ",").alias("samples"))
    return audit.groupBy("bucket").agg(F.count("*").alias("n"), F.countDistinct(key).alias("n_keys")).join(shown, "bucket")


def worst(audit: DataFrame, key: str = "doc_id", top: int = 30) -> DataFrame:
    return audit.filter("severity > 0").orderBy(F.desc("severity"), key).limit(top)


def with_text_flags(claims: DataFrame) -> DataFrame:
    """claims (raw_text) with text (1,400 characters), text_flags and contaminated."""
    rows = once(claims, text=tx.clip(F.col("raw_text"), 1400))
    rows = once(rows, solid=F.length(F.regexp_replace("text", r"\s+", "")), letters=F.regexp_count("text", F.lit(r"\p{L}")), digits=F.regexp_count("text", F.lit(r"\p{Nd}")),
                starts=F.col("text").rlike(rules.CLAIM_START), words=F.col("text").rlike(rules.PACK_WORD), front=F.col("text").rlike(rules.FRONT), figure=F.col("text").rlike(rules.FIGURE))
    ratio = lambda c: c / F.greatest(F.col("solid"), F.lit(1))
    flags = {
        "very_short_claim_text": F.col("solid") < 80,
        "frontmatter_in_claim_text": F.col("front"),
        "figure_text_in_claim_text": F.col("figure"),
        "ocr_gibberish_in_claim_text": F.col("text").rlike(rules.GIBBERISH),
        "low_letter_ratio_claim_text": (F.col("solid") >= 120) & (ratio(F.col("letters")) < 0.42),
        "high_symbol_ratio_claim_text": (F.col("solid") >= 120) & (ratio(F.col("solid") - F.col("letters") - F.col("digits")) > 0.28),
        "does_not_start_like_claim": ~F.col("starts") & (F.col("front") | F.col("figure")),
    }
    rows = once(rows, text_flags=F.when(F.col("text") == "", F.array(F.lit("empty_claim_text"))).otherwise(_named(flags)))
    has = lambda name: F.array_contains("text_flags", name)
    real = F.col("starts") & F.col("words")
    bad = (has("empty_claim_text") | has("ocr_gibberish_in_claim_text") | (has("does_not_start_like_claim") & (F.col("front") | F.col("figure")))
           | (F.col("front") & F.col("figure") & ~real) | (has("low_letter_ratio_claim_text") & has("high_symbol_ratio_claim_text") & ~real))
    return rows.select(*claims.columns, "text", "text_flags", bad.alias("contaminated"))


def packs(cards: DataFrame, claims: DataFrame) -> DataFrame:
    """Per card: independent, strong and missing claim numbers and quality flags.

    cards: patent_id, title, source_language, claim_nos, evidence_ids (comma-joined), solution_labels, effect_labels, confidence, qc_flags.
    claims: patent_id, claim_no, claim_type, raw_text. A patent's claims are few, and gathered by patent.
    """
    flagged = with_text_flags(claims)
    known = flagged.groupBy("patent_id").agg(F.sort_array(F.collect_list(F.struct(
        F.coalesce(F.col("claim_no").try_cast("int"), F.lit(0)).alias("order"), "claim_no", "claim_type", "contaminated",
        ((F.col("claim_type") == "dependent") | F.col("text").rlike(rules.DEPENDENT)).alias("leans")))).alias("c"))
    split = lambda c: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), ","), lambda x: x != "")
    rows = cards.join(known, "patent_id", "left").withColumn("c", F.coalesce("c", F.array().cast(known.schema["c"].dataType)))
    rows = once(rows, own=split("claim_nos"), evidence=F.filter(F.transform(split("evidence_ids"), lambda x: F.regexp_extract(x, "(?i)^claim_(.+)$", 1)), lambda x: x != ""))
    numbers = lambda f: F.transform(F.filter("c", f), lambda x: x["claim_no"])
    rows = once(rows, leaning=numbers(lambda x: x["leans"]), dirty=numbers(lambda x: x["contaminated"]), here=numbers(lambda x: F.lit(True)), parsed=numbers(lambda x: x["claim_type"] == "independent"))
    rows = once(rows, independent=F.array_except(F.array_distinct(F.concat("own", "parsed")), "leaning"))
    rows = once(rows, strong=F.slice(F.array_except(F.array_intersect("independent", "here"), "dirty"), 1, 8),
                support=F.slice(F.array_except(F.array_intersect(F.array_except(F.array_distinct(F.concat("evidence", "own")), "independent"), "here"), "dirty"), 1, 8),
                missing=F.array_except("independent", "here"), dropped=F.array_intersect("independent", "dirty"), clean=clean_title(F.col("title")))
    expected = F.create_map(*[F.lit(x) for x in ("cn", "zh", "us", "en", "kr", "ko")])[F.lower(F.substring("patent_id", 1, 2))]
    flags = {
        "minimal_title_repaired": title_needs_repair(F.col("title")),
        "missing_clean_title": F.col("clean") == "",
        "missing_strong_independent_claim_text": F.size("strong") == 0,
        "missing_some_independent_claim_text": F.size("missing") > 0,
        "contaminated_independent_claim_text_excluded": F.size("dropped") > 0,
        "minimal_independent_claim_nos_corrected": (F.size("independent") > 0) & (F.col("independent") != F.col("own")),
        "strong_claim_not_confirmed_independent": F.size(F.array_except("strong", "parsed")) > 0,
        "has_dependent_support_claims": F.size("support") > 0,
        "missing_solution_labels": F.coalesce("solution_labels", F.lit("")) == "",
        "missing_effect_labels": F.coalesce("effect_labels", F.lit("")) == "",
        "low_minimal_confidence": F.col("confidence") < 0.7,
        "source_language_mismatch": F.coalesce(F.col("source_language"), F.lit("")) != expected,
    }
    every = F.array_distinct(F.concat(_named(flags), F.transform(split("qc_flags"), lambda x: F.concat(F.lit("minimal_qc:"), x))))
    joined = lambda c: F.array_join(c, ",")
    return rows.select("patent_id", F.col("clean").alias("clean_title"), *[joined(c).alias(f"{c}_nos") for c in ("independent", "strong", "support", "missing", "dropped")], joined(every).alias("quality_flags"))


def clean_title(title: Column) -> Column:
    """The part before a stop word, without marks at its ends; '' if that is shorter than 8 characters."""
    head = F.btrim(F.get(F.split(tx.clip(title, 700), rules.TITLE_STOP, 2), F.lit(0)), F.lit(" -:;,."))
    return F.when(F.length(head) >= 8, head).otherwise("")


def title_needs_repair(title: Column) -> Column:
    t = tx.collapse_space(title)
    return (t == "") | (F.length(t) > 180) | t.rlike(rules.NOISE) | t.rlike(rules.TITLE_DIRT)


def country(name: Column, text: Column) -> Column:
    """By the beginning of a file name, else by cues of the text."""
    low = F.lower(name)
    return (F.when(low.startswith("cn"), "CN").when(low.startswith("kr"), "KR").when(low.startswith("us"), "US")
            .when(text.contains("国家知识产权局") | text.contains("发明专利"), "CN").when(text.contains("대한민국특허청"), "KR")
            .when(text.contains("United States Patent") | text.contains("What is claimed is"), "US").otherwise("UNKNOWN"))
