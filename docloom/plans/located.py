"""Tables of rules and of keys, applied to all texts of `documents`; the rules and keys come from `benchmark`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import rules as fixed
from docloom.functions import text as tx
from docloom.functions.measures import meeting
from docloom.operators import dictionary, locate
from docloom.operators.claims import once
from docloom.plans.indexed import TOKENS, items
from docloom.plans.registry import Registry
from docloom.sources.readers import table

here = Registry()
query = here.query
CLEAN = r"trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))"
NAMES = ("core_item_", "generic_memory_operation", "item_", "ect_data_labeling")
RULES = rf"""i as (select item_id, {TOKENS} as t from benchmark),
made as (select 2 * item_id as rule_no, case item_id % 4 when 0 then 'core_item_' || item_id when 1 then 'generic_memory_operation' when 2 then 'item_' || item_id else 'ect_data_labeling' end as label,
    t[1] || ' ' || t[2] || '|' || t[3] || '.{{0,12}}' || t[4] as pattern from i where len(t) >= 9
  union all select 2 * item_id + 1, 'late_' || item_id, t[5] || '.{{0,20}}' || t[6] || '|' || t[7] || ' (?:' || t[8] || '|' || t[9] || ')' from i where len(t) >= 9)"""
FIXED = "fixed_rules as (select * from (values " + ", ".join(f"({k}, '{label}', '{p}')" for k, (label, p) in enumerate(fixed.REPLACEMENTS)) + ") as v(rule_no, label, pattern))"


def met_sql(rules: str, name: str) -> str:
    """The labels of each document, each rule a search of its own."""
    return (f"{name} as (select doc_id, coalesce(list_distinct_in_order, []) as found from (select d.doc_id, list(label order by first) as list_distinct_in_order from docs d "
            f"join (select doc_id, label, min(rule_no) as first from docs join {rules} on regexp_matches(text, pattern, 'i') group by all) m using (doc_id) group by 1))")


def rules_of(spark, d) -> DataFrame:
    """Two rules from each item of nine tokens or more."""
    def t(k: int):
        return F.col("t")[k - 1]

    i, n = items(spark, d).filter(F.size("t") >= 9), F.col("query_id")
    name = F.when(n % 4 == 0, F.concat(F.lit("core_item_"), n)).when(n % 4 == 1, "generic_memory_operation").when(n % 4 == 2, F.concat(F.lit("item_"), n)).otherwise("ect_data_labeling")
    one = i.select((2 * n).alias("rule_no"), name.alias("label"), F.concat(t(1), F.lit(" "), t(2), F.lit("|"), t(3), F.lit(".{0,12}"), t(4)).alias("pattern"))
    two = i.select((2 * n + 1).alias("rule_no"), F.concat(F.lit("late_"), n).alias("label"), F.concat(t(5), F.lit(".{0,20}"), t(6), F.lit("|"), t(7), F.lit(" (?:"), t(8), F.lit("|"), t(9), F.lit(")")).alias("pattern"))
    return one.unionByName(two)


DOCS = f"docs as materialized (select doc_id, {CLEAN} as text from documents)"


@query(f"with {DOCS}, {RULES}, {met_sql('made', 'm')} select doc_id, coalesce(array_to_string(found, ','), '') as labels from documents left join m using (doc_id)")
def label_dictionary(spark, d):
    """A table of rules over all texts, in one pass of each."""
    found = dictionary.labelled(table(spark, d, "documents"), rules_of(spark, d), "doc_id")
    return found.select("doc_id", F.array_join("labels", ",").alias("labels"))


@query(f"""with {DOCS}, {FIXED}, {RULES}, {met_sql('fixed_rules', 'f')}, {met_sql("(select * from made where label not like 'late%')", 'm')},
a as (select doc_id, coalesce(m.found, []) as own, coalesce(f.found, case lang when 'en' then ['method_feature_extraction'] when 'de' then ['system_feature_extraction'] when 'fr' then ['device_feature_extraction'] else [] end)[1:6] as instead
  from documents left join m using (doc_id) left join f using (doc_id)),
b as (select *, list_filter(own, lambda x: x not in ('ect_data_labeling', 'ect_data_labeling_platform', 'composite_electrode_preparation')) as left_ from a),
c as (select *, list_filter(left_, lambda x: x not in ('generic_memory_operation', 'general_data_processing') and not regexp_matches(x, '^(core_|claimed_|safe_)')) as specific from b)
select doc_id, array_to_string(instead, ',') as replacements, array_to_string(case when len(specific) > 0 then specific when len(instead) > 0 then instead else left_ end, ',') as labels from c""")
def label_quality(spark, d):
    """Labels that say something, or those of the context, or those of the claims' kind (here the language stands for it)."""
    docs, rules = table(spark, d, "documents"), dictionary.table_of(rules_of(spark, d).filter("not startswith(label, 'late')"))
    kinds = F.when(F.col("lang") == "en", F.array(F.lit("method"))).when(F.col("lang") == "de", F.array(F.lit("system"))).when(F.col("lang") == "fr", F.array(F.lit("device"))).otherwise(F.array().cast("array<string>"))
    text = tx.collapse_space(F.col("text"))
    context = {label: f"(?i){pattern}" for label, pattern in fixed.REPLACEMENTS}  # few and fixed: RE2 reads a text faster for each than Python's automaton for all
    both = once(docs.select("doc_id", kinds.alias("kinds"), text.alias("clean")), own=dictionary.labels(F.col("clean"), rules), context=meeting(F.col("clean"), context)).drop("clean")
    both = both.withColumn("instead", dictionary.replacements(F.col("context"), F.col("kinds")))
    return both.select("doc_id", F.array_join("instead", ",").alias("replacements"), F.array_join(dictionary.of_quality(F.col("own"), F.col("instead")), ",").alias("labels"))


PAGES = r"""pages_ as (select doc_id, page_no, trim(regexp_replace(array_to_string(lines[(page_no - 1) * 20 + 1:page_no * 20], ' '), '\s+', ' ', 'g')) as text
  from (select doc_id, lines, unnest(range(1, (len(lines) + 39) // 20)) as page_no from (select doc_id, string_split(text, chr(10)) as lines from documents where text is not null)))"""


@query(f"""with {PAGES}, k as (select item_id as key_id, substring({CLEAN}, 1, 30) as key from benchmark)
select key_id, doc_id, min(page_no)::integer as first_page, max(page_no)::integer as last_page from k join pages_ on key <> '' and contains(pages_.text, key) group by all""")
def key_pages(spark, d):
    """First and last page of each document that holds the first 30 characters of an item."""
    keys = table(spark, d, "benchmark").select(F.col("item_id").alias("key_id"), "text")
    return locate.first_and_last(keys, locate.pages_of(table(spark, d, "documents")))


@query(f"""with {PAGES}, l as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as n from (select doc_id, string_split(text, chr(10)) as lines from documents where text is not null)),
k as (select doc_id, n as key_id, substring(trim(regexp_replace(line, '\\s+', ' ', 'g')), 1, 30) as key from l)
select key_id::integer as key_id, k.doc_id, min(page_no)::integer as first_page, max(page_no)::integer as last_page from k join pages_ using (doc_id) where key <> '' and contains(pages_.text, key) group by all""")
def line_pages(spark, d):
    """First and last page of a document that holds the beginning of each of its lines."""
    return locate.pages_of_lines(table(spark, d, "documents"))
