"""Queries of a patent collection and their SQL, by name: over the small tables of fixtures.py, and over documents."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from docloom.functions import rules
from docloom.functions import text as tx
from docloom.operators import claims as cl
from docloom.operators import relations
from docloom.plans.fixtures import fixture, values
from docloom.sources.readers import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = re.sub(r"\{\{(\w+)\}\}", lambda m: values(m[1]), sql)
        return f

    return add


def _relation(name: str):
    return lambda spark, d: relations.run(spark, name, **{t: fixture(spark, t) for t in relations.tables_of(name)})


for _name, _sql in relations.OPERATORS.items():
    QUERIES[_name] = _relation(_name)
    _sql = relations.AGG.sub(lambda m: f"string_agg(cast({m[2]} as varchar), '{' ' if m[1] else ','}' order by {m[3]})", _sql)
    SQL[_name] = re.sub(r"\{(\w+)\}", lambda m: values(m[1]), _sql)


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def flag_list(flags: dict[str, str]) -> str:
    return "list_filter([" + ", ".join(f"case when {on} then '{name}' end" for name, on in flags.items()) + "], lambda x: x is not null)"


CLEAN = r"trim(regexp_replace(coalesce({}, ''), '\s+', ' ', 'g'))"
MEASURES = r"length(regexp_replace(t, '\s+', '', 'g')) as solid, len(regexp_extract_all(t, '\p{L}')) as letters, len(regexp_extract_all(t, '\p{Nd}')) as digits, " + f"regexp_matches(t, {q(rules.CLAIM_START)}) as starts, regexp_matches(t, {q(rules.CLAIM_WORD)}) as words"
PACK_MEASURES = MEASURES.replace(q(rules.CLAIM_WORD), q(rules.PACK_WORD))
AUDIT_FLAGS = {
    "very_short_claim_text": "length(t) < 80", "figure_or_frontmatter_text": "front", "flowchart_step_text": f"regexp_matches(t, {q(rules.FLOW_STEP)})", "ocr_gibberish_terms": f"regexp_matches(t, {q(rules.GIBBERISH)})",
    "high_symbol_ratio": "(solid - letters - digits)::double / greatest(solid, 1) > 0.24", "low_letter_ratio": "letters::double / greatest(solid, 1) < 0.48 and solid >= 120",
    "diagram_line_art": r"len(regexp_extract_all(t, '\|')) >= 4 or len(regexp_extract_all(t, '[—-]')) >= 14", "repeated_short_ocr_tokens": "repeated >= 18",
    "independent_without_claim_keywords": "claim_type = 'independent' and length(t) >= 120 and not words", "does_not_start_like_claim": "length(t) >= 120 and not starts and front",
}
AUDIT = rf"""with c as materialized (select doc_id, case when doc_id % 2 = 0 then 'independent' else 'dependent' end as claim_type, {CLEAN.format('text')} as t from documents),
s as (select doc_id, w, count(*) as n from (select doc_id, unnest(list_filter(string_split_regex(lower(t), '[^\p{{L}}\p{{N}}_]+'), lambda x: regexp_full_match(x, '[a-z]{{1,3}}'))) as w from c) group by 1, 2),
r as (select doc_id, sum(n) as repeated from s where n >= 8 group by 1),
m as materialized (select c.*, coalesce(r.repeated, 0) as repeated, {MEASURES}, regexp_matches(t, {q(rules.FIGURE_OR_FRONT)}) as front from c left join r using (doc_id)),
f as (select doc_id, starts and words as substantive, case when t = '' then ['empty_text'] else {flag_list(AUDIT_FLAGS)} end as flags from m),
v as (select doc_id, flags, case when flags = ['empty_text'] then 100 else coalesce(list_sum(list_transform(flags, lambda x: case when substantive then (map {{{', '.join(f"'{k}': {w[1]}" for k, w in rules.WEIGHTS.items())}}})[x] else (map {{{', '.join(f"'{k}': {w[0]}" for k, w in rules.WEIGHTS.items())}}})[x] end)), 0) end as severity from f),
a as (select doc_id, array_to_string(flags, ',') as flags, cast(severity as int) as severity, case when severity >= 70 then 'severe' when severity >= 45 then 'high' when severity >= 25 then 'medium' when severity > 0 then 'low' else 'ok' end as bucket from v) """


def _audited(spark, d):
    return cl.audited(table(spark, d, "documents").select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, "independent").otherwise("dependent").alias("claim_type")))


@query(AUDIT + "select * from a")
def claim_audit(spark, d):
    return _audited(spark, d).select("doc_id", F.array_join("flags", ",").alias("flags"), "severity", "bucket")


@query(AUDIT + ", k as (select *, row_number() over (partition by bucket order by doc_id) as i from a) select bucket, count(*) as n, count(distinct doc_id) as n_keys, string_agg(doc_id::varchar, ',' order by doc_id) filter (i <= 3) as samples from k group by 1")
def claim_audit_report(spark, d):
    return cl.audit_report(_audited(spark, d))


@query(AUDIT + "select doc_id, severity, flags from a where severity > 0 order by severity desc, doc_id limit 30")
def claim_audit_worst(spark, d):
    return cl.worst(_audited(spark, d)).select("doc_id", "severity", F.array_join("flags", ",").alias("flags"))


TEXT_FLAGS = {
    "very_short_claim_text": "solid < 80", "frontmatter_in_claim_text": "front", "figure_text_in_claim_text": "figure", "ocr_gibberish_in_claim_text": "gibberish",
    "low_letter_ratio_claim_text": "solid >= 120 and letters::double / greatest(solid, 1) < 0.42", "high_symbol_ratio_claim_text": "solid >= 120 and (solid - letters - digits)::double / greatest(solid, 1) > 0.28",
    "does_not_start_like_claim": "not starts and (front or figure)",
}


def _text_flags(source: str) -> str:
    return rf"""c as (select *, left({CLEAN.format('raw_text')}, 1400) as t from {source}), m as (select *, {PACK_MEASURES}, regexp_matches(t, {q(rules.FRONT)}) as front, regexp_matches(t, {q(rules.FIGURE)}) as figure, regexp_matches(t, {q(rules.GIBBERISH)}) as gibberish from c),
f as (select *, case when t = '' then ['empty_claim_text'] else {flag_list(TEXT_FLAGS)} end as flags from m),
g as (select *, t = '' or gibberish or (not starts and (front or figure)) or (front and figure and not (starts and words)) or (list_contains(flags, 'low_letter_ratio_claim_text') and list_contains(flags, 'high_symbol_ratio_claim_text') and not (starts and words)) as contaminated from f)"""


@query("with " + _text_flags("{{claims}}") + " select patent_id, claim_no, array_to_string(flags, ',') as flags, contaminated from g")
def claim_text_flags(spark, d):
    return cl.with_text_flags(fixture(spark, "claims")).select("patent_id", "claim_no", F.array_join("text_flags", ",").alias("flags"), "contaminated")


@query("with " + _text_flags("(select doc_id, text as raw_text from documents)") + " select doc_id, array_to_string(flags, ',') as flags, contaminated from g")
def document_text_flags(spark, d):
    return cl.with_text_flags(table(spark, d, "documents").select("doc_id", F.col("text").alias("raw_text"))).select("doc_id", F.array_join("text_flags", ",").alias("flags"), "contaminated")


def _title(column: str) -> str:
    head = rf"trim(regexp_split_to_array(left({CLEAN.format(column)}, 700), {q(rules.TITLE_STOP)})[1], ' -:;,.')"
    return f"case when length({head}) >= 8 then {head} else '' end"


def _repair(column: str) -> str:
    t = CLEAN.format(column)
    return f"({t} = '' or length({t}) > 180 or regexp_matches({t}, {q(rules.NOISE)}) or regexp_matches({t}, {q(rules.TITLE_DIRT)}))"


@query("with " + _text_flags("{{claims}}") + rf""", k as (select patent_id, list(claim_no order by coalesce(try_cast(claim_no as int), 0), claim_no, claim_type) as here,
  coalesce(list(claim_no order by coalesce(try_cast(claim_no as int), 0), claim_no) filter (claim_type = 'independent'), []) as parsed, coalesce(list(claim_no) filter (contaminated), []) as dirty,
  coalesce(list(claim_no) filter (claim_type = 'dependent' or regexp_matches(t, {q(rules.DEPENDENT)})), []) as leaning from g group by 1),
j as (select d.*, coalesce(here, []) as here, coalesce(parsed, []) as parsed, coalesce(dirty, []) as dirty, coalesce(leaning, []) as leaning, list_filter(string_split(coalesce(claim_nos, ''), ','), lambda x: x <> '') as own,
  list_filter(list_transform(string_split(coalesce(evidence_ids, ''), ','), lambda x: regexp_extract(x, '(?i)^claim_(.+)$', 1)), lambda x: x <> '') as evidence from {{{{cards}}}} d left join k using (patent_id)),
i as (select *, list_filter(list_concat(own, list_filter(parsed, lambda x: not list_contains(own, x))), lambda x: not list_contains(leaning, x)) as independent from j),
s as (select *, list_filter(independent, lambda x: list_contains(here, x) and not list_contains(dirty, x))[1:8] as strong, list_filter(list_concat(evidence, list_filter(own, lambda x: not list_contains(evidence, x))), lambda x: list_contains(here, x) and not list_contains(dirty, x) and not list_contains(independent, x))[1:8] as support,
  list_filter(independent, lambda x: not list_contains(here, x)) as missing, list_filter(independent, lambda x: list_contains(dirty, x)) as dropped, {_title('title')} as clean_title from i)
select patent_id, clean_title, array_to_string(independent, ',') as independent_nos, array_to_string(strong, ',') as strong_nos, array_to_string(support, ',') as support_nos, array_to_string(missing, ',') as missing_nos, array_to_string(dropped, ',') as dropped_nos,
  concat_ws(',', case when {_repair('title')} then 'minimal_title_repaired' end, case when clean_title = '' then 'missing_clean_title' end, case when len(strong) = 0 then 'missing_strong_independent_claim_text' end, case when len(missing) > 0 then 'missing_some_independent_claim_text' end,
  case when len(dropped) > 0 then 'contaminated_independent_claim_text_excluded' end, case when len(independent) > 0 and independent <> own then 'minimal_independent_claim_nos_corrected' end, case when len(list_filter(strong, lambda x: not list_contains(parsed, x))) > 0 then 'strong_claim_not_confirmed_independent' end,
  case when len(support) > 0 then 'has_dependent_support_claims' end, case when coalesce(solution_labels, '') = '' then 'missing_solution_labels' end, case when coalesce(effect_labels, '') = '' then 'missing_effect_labels' end, case when confidence < 0.7 then 'low_minimal_confidence' end,
  case when coalesce(source_language, '') <> (map {{'cn': 'zh', 'us': 'en', 'kr': 'ko'}})[lower(left(patent_id, 2))] then 'source_language_mismatch' end, case when coalesce(qc_flags, '') <> '' then 'minimal_qc:' || qc_flags end) as quality_flags from s""")
def pack_flags(spark, d):
    return cl.packs(fixture(spark, "cards"), fixture(spark, "claims"))


@query(f"select patent_id, {_title('title')} as clean_title, {_repair('title')} as needs_repair from {{{{patents}}}}")
def title_cleaning(spark, d):
    return fixture(spark, "patents").select("patent_id", cl.clean_title(F.col("title")).alias("clean_title"), cl.title_needs_repair(F.col("title")).alias("needs_repair"))


def _first(patterns) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract(raw_text, {q(p)}, 1), '')" for p in patterns) + ", null)"


@query(f"select c.patent_id, c.claim_no, case p.country when 'CN' then {_first(rules.PARENTS['CN'])} when 'KR' then {_first(rules.PARENTS['KR'])} else {_first(rules.PARENTS[''])} end as parent from {{{{claims}}}} c join {{{{patents}}}} p using (patent_id)")
def claim_parents(spark, d):
    rows = fixture(spark, "claims").join(fixture(spark, "patents").select("patent_id", "country"), "patent_id")
    return rows.select("patent_id", "claim_no", cl.parent(F.col("country"), F.col("raw_text")).alias("parent"))


TEXT_OF_CLAIMS = "1. A device comprising a cell.\n2. The device of claim 1,\nwherein it counts.\n 10. A method of reading.\nNo 3. here"


@query(rf"""with d as (select doc_id, case when doc_id = 1 then {q(TEXT_OF_CLAIMS)} when doc_id = 2 then 'none' end as text from (values (1), (2), (3)) as t(doc_id)),
b as (select doc_id, string_split(regexp_replace(text, '(?m)^\s*(\d{{1,3}})\s*[.、]\s+', chr(1) || '\1' || chr(2), 'g'), chr(1))[2:] as b from d where text is not null), e as (select doc_id, generate_subscripts(b, 1) as i, unnest(b) as x from b)
select doc_id, cast(i as int) as block_no, string_split(x, chr(2))[1] as claim_no, {CLEAN.format("string_split(x, chr(2))[2]")} as text from e""")
def claim_blocks(spark, d):
    rows = spark.createDataFrame([(1, TEXT_OF_CLAIMS), (2, "none"), (3, None)], "doc_id int, text string")
    return cl.blocks(rows)


@query("select patent_id, case when contains(text, '国家知识产权局') or contains(text, '发明专利') then 'CN' when contains(text, '대한민국특허청') then 'KR' when contains(text, 'United States Patent') or contains(text, 'What is claimed is') then 'US' else 'UNKNOWN' end as country from {{pages}} where line_no = 1")
def country_by_text(spark, d):
    return fixture(spark, "pages").filter("line_no = 1").select("patent_id", cl.country(F.lit("scan.pdf"), F.col("text")).alias("country"))


@query("select patent_id, case lower(left(patent_id, 2)) when 'cn' then 'CN' when 'kr' then 'KR' when 'us' then 'US' else 'UNKNOWN' end as country from {{jobs}}")
def country_by_name(spark, d):
    return fixture(spark, "jobs").select("patent_id", cl.country(F.col("patent_id"), F.lit("")).alias("country"))


ASKED = ("SSD accelerator with page buffer", "how does the word line work", "Garbage Collection", "페이지 버퍼 동작", "")
ASKED_ROWS = "(values " + ", ".join(f"({i}, {q(x)})" for i, x in enumerate(ASKED)) + ") as t(query_no, question)"


def _expanded() -> str:
    each = ", ".join(f"case when contains(lower(question), {q(k.lower())}) then [{', '.join(map(q, v))}] else [] end" for k, v in rules.ALIASES.items())
    return f"list_filter(flatten([[{CLEAN.format('question')}], {each}]), lambda x: x <> '')"


@query(f"with e as (select query_no, {_expanded()} as l from {ASKED_ROWS}), u as (select query_no, list_filter(l, lambda x, i: list_position(l, x) = i) as l from e) select query_no, array_to_string(list_transform(l, lambda x: '\"' || replace(x, '\"', '\"\"') || '\"'), ' OR ') as fts, len(l)::bigint as n from u")
def alias_expansion(spark, d):
    rows = spark.createDataFrame(list(enumerate(ASKED)), "query_no int, question string")
    terms = tx.expanded(F.col("question"))
    quoted = F.transform(terms, lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"')))
    return rows.select("query_no", F.array_join(quoted, " OR ").alias("fts"), F.size(terms).cast("long").alias("n"))


def _generic(column: str) -> str:
    return f"regexp_matches({CLEAN.format(column)}, {q(rules.GENERIC)})"


@query(f"select p_partkey, {_generic('p_name')} as generic, p_name from part union all select -1, {_generic(q('Memory  Device'))}, 'Memory  Device'")
def generic_subjects(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_name").union(spark.createDataFrame([(-1, "Memory  Device")], "p bigint, n string"))
    return rows.select("p_partkey", tx.collapse_space(F.col("p_name")).rlike(rules.GENERIC).alias("generic"), "p_name")
