"""Joins, counts, picks and changes of a patent collection, as SQL over given DataFrames.

{name} stands for a table; [[agg x | order]] for x as text, comma-joined in that order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

CARD_OK = "coalesce(qc_flags, '') = ''"
WEAK = """select patent_id, case k when 1 then case when coalesce(problem_labels, '') = '' then 'empty_problem_labels' end when 2 then case when coalesce(effect_labels, '') = '' then 'empty_effect_labels' end
  when 3 then case when coalesce(solution_labels, '') = '' then 'empty_solution_labels' end else case when coalesce(fallback, '') <> '' then 'fallback_output' end end as reason
  from {cards} cross join (select n as k from {numbers} where n <= 4) k"""
EVIDENCE = "select c.patent_id, n.n as i, split_part(c.evidence_ids, ',', n.n) as id from {cards} c join {numbers} n on n.n <= length(c.evidence_ids) - length(replace(c.evidence_ids, ',', '')) + 1"

OPERATORS: dict[str, str] = {
    # filters and picks
    "card_point_lookup": "select patent_id, title, confidence from {cards} where patent_id = 'us1000002p'",
    "card_filters": f"select patent_id, claim_type, confidence from {{cards}} where source_language = 'en' and claim_type = 'device' and {CARD_OK}",
    "card_filters_with_flags": "select patent_id, claim_type, confidence from {cards} where source_language = 'en' and claim_type = 'device'",
    "card_label_filter": f"select c.patent_id from {{cards}} c where {CARD_OK} and exists (select 1 from {{terms}} t where contains(replace(lower(coalesce(c.solution_labels, '')), '_', ' '), t.term))",
    "card_search_order": "select patent_id, cast(row_number() over (order by confidence desc, patent_id) as int) as rank from {cards} where " + CARD_OK,
    "card_compact": "select patent_id, substring(coalesce(title, ''), 1, 20) as title, coalesce(nullif(split_part(coalesce(solution_labels, ''), ',', 1), ''), '-') as first_label, round(confidence, 2) as confidence from {cards}",
    "weak_cards": WEAK.join(("select * from (", ") w where reason is not null")),
    "weak_cards_unseen": WEAK.join(("select w.patent_id, [[agg w.reason | w.reason]] as reasons from (", ") w left join {seen} s on s.patent_id = w.patent_id and s.reason = w.reason and s.made >= 50 where w.reason is not null and s.patent_id is null group by w.patent_id")),
    "card_validity": "select patent_id, concat_ws(',', case when coalesce(title, '') = '' then 'title' end, case when coalesce(claim_nos, '') = '' then 'claim_nos' end, case when coalesce(solution_labels, '') = '' then 'solution_labels' end, case when confidence <= 0 then 'confidence' end) as missing from {cards}",
    "front_matter": "select patent_id, substring([[aggw text | page_no, line_no]], 1, 5000) as front from {pages} where page_no <= 2 group by patent_id",
    "description_after_claims": "select p.patent_id, p.page_no, p.text from {pages} p join (select patent_id, max(page_end) as last_page from {claims} group by patent_id) c on c.patent_id = p.patent_id where p.page_no > c.last_page and length(trim(p.text)) between 40 and 800",
    "independent_first_four": "select patent_id, claim_no, i from (select patent_id, claim_no, cast(row_number() over (partition by patent_id order by claim_no) as int) as i from {claims} where claim_type = 'independent') r where i <= 4",
    "claims_in_order": "select patent_id, claim_no, cast(row_number() over (partition by patent_id order by coalesce(try_cast(claim_no as int), 0), claim_no) as int) as i, substring(coalesce(raw_text, ''), 1, 1400) as text from {claims}",
    "figures_capped": "select patent_id, figure_no, caption, page_no from (select *, row_number() over (partition by patent_id, figure_no order by page_no) as i from {figures} where coalesce(caption, '') <> '') r where i <= 3",
    "jobs_selected": "select patent_id, status from (select *, row_number() over (order by updated, patent_id) as i from {jobs} where status in ('queued', 'failed')) r where i > 1 and i <= 3",
    "failed_jobs": "select patent_id, updated from {jobs} where status = 'failed'",
    "evidence_bundle": "select p.patent_id, p.title, coalesce(c.n, 0) as n_claims, coalesce(c.k, 0) as n_independent, coalesce(f.n, 0) as n_figures, coalesce(r.n, 0) as n_refs from {patents} p left join (select patent_id, count(*) as n, count(*) filter (where claim_type = 'independent') as k from {claims} group by patent_id) c on c.patent_id = p.patent_id left join (select patent_id, count(*) as n from {figures} group by patent_id) f on f.patent_id = p.patent_id left join (select patent_id, count(distinct ref_no) as n from {refs} group by patent_id) r on r.patent_id = p.patent_id",
    "evidence_compact": "select patent_id, claim_no, substring(coalesce(raw_text, ''), 1, 90) as text from (select *, row_number() over (partition by patent_id order by coalesce(try_cast(claim_no as int), 0), claim_no) as i from {claims}) r where i <= 4",
    # joins
    "jobs_with_patents": "select j.patent_id, j.status, p.country from {jobs} j join {patents} p on p.patent_id = j.patent_id",
    "title_override": "select p.patent_id, coalesce(nullif(c.title, ''), p.title, '') as title from {patents} p left join {cards} c on c.patent_id = p.patent_id",
    "cards_else_light": "select p.patent_id, coalesce(c.source_language, case p.country when 'US' then 'en' when 'KR' then 'ko' when 'CN' then 'zh' else '' end) as language, c.patent_id is null or c.title is null as light from {patents} p left join {cards} c on c.patent_id = p.patent_id",
    "evidence_claims": f"select e.patent_id, e.i, c.claim_no from ({EVIDENCE}) e join {{claims}} c on c.patent_id = e.patent_id and lower(e.id) = 'claim_' || c.claim_no where e.i <= 8",
    "evidence_figures": f"select e.patent_id, f.figure_no, f.page_no from ({EVIDENCE}) e join (select *, row_number() over (partition by patent_id, figure_no order by page_no) as k from {{figures}}) f on f.patent_id = e.patent_id and lower(e.id) = 'fig_' || f.figure_no where f.k <= 3",
    "evidence_ids_checked": f"select e.patent_id, [[agg e.id | e.i]] as valid from ({EVIDENCE}) e left join {{claims}} c on c.patent_id = e.patent_id and e.id = 'claim_' || c.claim_no left join (select distinct patent_id, figure_no from {{figures}}) f on f.patent_id = e.patent_id and e.id = 'fig_' || f.figure_no where c.claim_no is not null or f.figure_no is not null group by e.patent_id",
    "claim_refs_once": "select patent_id, claim_no, ref_no, page_no from (select *, row_number() over (partition by patent_id, ref_no, page_no order by coalesce(claim_no, '~'), coalesce(label, '~')) as i from {refs}) r where i = 1",
    "page_refs": "select distinct p.patent_id, p.page_no, r.ref_no from {pages} p join {refs} r on r.patent_id = p.patent_id and r.page_no = p.page_no union select distinct p.patent_id, p.page_no, 'fig ' || f.figure_no from {pages} p join {figures} f on f.patent_id = p.patent_id and f.page_no = p.page_no",
    "term_containment": "select t.term, u.unit_id from {units} u join {terms} t on contains(lower(u.text), t.term)",
    "element_overlap": "select unit_id, hits from (select u.unit_id, count(*) as hits, row_number() over (order by count(*) desc, u.unit_id) as i from {units} u join {terms} t on contains(lower(u.text), t.term) group by u.unit_id) r where i <= 3",
    # counts
    "ref_frequency": "select patent_id, coalesce(claim_no, '') as claim_no, ref_no, count(*) as n from {refs} group by 1, 2, 3",
    "ref_sections": "select ref_no, coalesce(label, '') as label, section, page_no, count(*) as n from {refs} group by 1, 2, 3, 4",
    "most_common_refs": "select ref_no, n from (select ref_no, count(*) as n, row_number() over (order by count(*) desc, ref_no) as i from {refs} group by ref_no) r where i <= 2",
    "table_counts": "select 'patents' as name, count(*) as n from {patents} union all select 'claims', count(*) from {claims} union all select 'figures', count(*) from {figures} union all select 'refs', count(*) from {refs} union all select 'jobs', count(*) from {jobs}",
    "claim_pages": "select patent_id, [[agg n | n]] as pages from (select distinct c.patent_id, n.n from {claims} c join {numbers} n on n.n between c.page_start and c.page_end) r group by patent_id",
    "brief_merge": "select patent_id, round(avg(confidence), 4) as confidence, cast(sum(n_labels) as bigint) as n_labels, cast(max(n_labels) as int) as most from {repairs} where status = 'ok' group by patent_id",
    "labeler_comparison": "select labeler, count(*) as n, round(avg(confidence), 4) as mean, count(*) filter (where quality_pass) as passed, count(*) filter (where n_labels = 0) as empty from {repairs} group by labeler",
    "repair_summary": "select count(*) filter (where status = 'ok') as success, count(*) filter (where status = 'failed') as failed, count(*) filter (where n_labels > 0) as nonempty, count(*) filter (where quality_pass) as passed, count(distinct patent_id) as patents from {repairs}",
    "card_inspection": "select count(*) as n, count(*) filter (where coalesce(title, '') = '') as invalid, count(*) filter (where fallback is not null) as weak, count(*) filter (where confidence >= 0.7) as sure from {cards}",
    # sets
    "unique_ignoring_case": "select patent_id, [[agg label | i]] as labels from (select patent_id, i, label, row_number() over (partition by patent_id, lower(label) order by i) as k from (select c.patent_id, n.n as i, split_part(c.solution_labels, ',', n.n) as label from {cards} c join {numbers} n on n.n <= length(c.solution_labels) - length(replace(c.solution_labels, ',', '')) + 1) s where label <> '') r where k = 1 group by patent_id",
    "risk_labels": "select label from (select effect_labels as label from {cards} where effect_labels is not null) a intersect select term from {terms}",
    "support_minus_strong": "select patent_id, claim_no from {claims} where claim_type is not null except select patent_id, claim_no from {claims} where claim_type = 'independent'",
    "pending_merged": "select dedupe_key, min(id) as id, count(*) as n, [[agg pid | pid]] as patent_ids from (select distinct a.dedupe_key, a.id, split_part(coalesce(a.patent_ids, ''), ',', n.n) as pid from {actions} a join {numbers} n on n.n <= length(coalesce(a.patent_ids, '')) - length(replace(coalesce(a.patent_ids, ''), ',', '')) + 1 where a.status = 'pending') r group by dedupe_key",
    "pending_ids_once": "select dedupe_key, [[agg pid | pid]] as patent_ids from (select distinct a.dedupe_key, split_part(a.patent_ids, ',', n.n) as pid from {actions} a join {numbers} n on n.n <= length(a.patent_ids) - length(replace(a.patent_ids, ',', '')) + 1 where a.status = 'pending') r group by dedupe_key",
    "monitor_rules": "select rule, n from (select 'failed_jobs' as rule, count(*) as n from {jobs} where status = 'failed' union all select 'retried_often', count(*) from {jobs} where retry_count >= 3 union all select 'invalid_cards', count(*) from {cards} where coalesce(title, '') = '' union all select 'low_confidence', count(*) from {cards} where confidence < 0.7) r where n > 0",
    # changes
    "reset_patent": "select patent_id, claim_no from {claims} c where not exists (select 1 from (select 'us1000001p' as patent_id) t where t.patent_id = c.patent_id)",
    "upsert_jobs": "select patent_id, status, coalesce(retry_count, 0) as retry_count, updated from (select *, row_number() over (partition by patent_id order by updated desc) as i from (select * from {jobs} union all select u.patent_id, u.status, coalesce(u.retry_count, j.retry_count), u.updated from {updates} u left join {jobs} j on j.patent_id = u.patent_id) x) r where i = 1",
    "replace_last_wins": "select patent_id, status from (select *, row_number() over (partition by patent_id order by updated desc) as i from {updates}) r where i = 1",
    "ignore_first_wins": "select patent_id, ref_no, coalesce(label, '') as label from (select *, row_number() over (partition by patent_id, ref_no, label, section, page_no order by claim_no) as i from {refs}) r where i = 1 or label is null",
    "job_failed_again": "select patent_id, case when retry_count + 1 >= 3 then 'quarantined' else 'failed' end as status, retry_count + 1 as retry_count from {jobs} where status in ('failed', 'running')",
    "backup_claims": "select 'run-7' as run_id, c.patent_id, c.claim_no, c.raw_text from {claims} c join (select distinct patent_id from {cards} where confidence < 0.75) t on t.patent_id = c.patent_id",
    "replace_artifacts": "select c.patent_id, c.claim_no, 1 as version from {claims} c left join (select distinct patent_id from {updates}) u on u.patent_id = c.patent_id where u.patent_id is null union all select patent_id, '1', 2 from (select distinct patent_id from {updates}) n",
    "queue_snapshot": "select status, [[agg patent_id | patent_id]] as patent_ids, count(*) as n from {jobs} group by status",
    # ranks
    "unit_scores": """select unit_id, patent_id, round(least(5.0, 0.7 * hits) + case when unit_type = 'claim' then 2.0 else 0.0 end + case when independent and not leans then 1.4 when unit_type = 'claim' and leans then -1.6 else 0.0 end
  + case unit_type when 'minimal_summary' then 0.7 when 'figure' then -0.5 else 0.0 end + greatest(0.0, least(2.0, coalesce(-bm25 / 4.0, 0.0))) + 0.4 * source_weight + least(0.8, greatest(0.0, confidence - 0.5)) - 0.6 * n_flags - 0.8 * n_qc, 6) as score
  from (select u.unit_id, u.patent_id, u.unit_type, u.independent, u.leans, u.n_flags, u.source_weight, u.confidence, u.n_qc, u.bm25, count(t.term) as hits from {units} u left join {terms} t on contains(lower(u.text), t.term) group by 1, 2, 3, 4, 5, 6, 7, 8, 9, 10) h""",
    "title_pick": "select patent_id, title from (select *, row_number() over (partition by patent_id order by penalty, priority, length(title)) as i from (select patent_id, title, 1 as priority, case when contains(title, 'ABSTRACT') then 5 else 0 end as penalty from {cards} where title is not null union all select patent_id, title, 2, 0 from {patents} where title is not null) c) r where i = 1",
    "term_fit": "select c.patent_id, round(cast(sum(case when contains(lower(coalesce(c.title, '')), t.term) then 1.6 else 0.0 end + case when contains(replace(lower(concat_ws(' ', c.problem_labels, c.solution_labels, c.effect_labels)), '_', ' '), t.term) then 1.3 else 0.0 end + case when contains(lower(coalesce(k.claims, '')), t.term) then 0.45 else 0.0 end) as double), 4) as fit from {cards} c cross join {terms} t left join (select patent_id, [[aggw raw_text | claim_no]] as claims from {claims} where raw_text is not null group by patent_id) k on k.patent_id = c.patent_id group by c.patent_id",
    "mission_fusion": """select patent_id, n_hits, round(total + 0.8 * n_hits - missing * 2.0 - dirty * 1.5 - low * 0.8, 4) as score from (select patent_id, count(*) as n_hits, sum(case when i = 1 then part else part * 0.35 end) as total,
  max(case when flags = 'missing_strong_independent_claim_text' then 1 else 0 end) as missing, max(case when flags = 'contaminated_independent_claim_text_excluded' then 1 else 0 end) as dirty, max(case when flags = 'low_minimal_confidence' then 1 else 0 end) as low
  from (select *, score + greatest(0.0, 2.0 - 0.15 * rank) as part, row_number() over (partition by patent_id order by query_no) as i from {hits}) h group by patent_id) f""",
    "pack_audit": "select patent_id, max(score) as best, count(*) as n from {hits} group by patent_id",
}
# the patents' ranks are sums over their best units
OPERATORS["patent_ranks"] = f"select patent_id, round(sum(score) filter (where i <= 4) + 0.3 * ln(1 + count(*)), 4) as rank_score, count(*) as n_units from (select *, row_number() over (partition by patent_id order by score desc, unit_id) as i from ({OPERATORS['unit_scores']}) s) r group by patent_id"

AGG = re.compile(r"\[\[agg(w?) (.+?) \| (.+?)\]\]")


def tables_of(name: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", OPERATORS[name])))


def run(spark: SparkSession, name: str, **tables: DataFrame) -> DataFrame:
    """The operator over the given tables, by name."""
    sql = AGG.sub(lambda m: f"listagg(cast({m[2]} as string), '{' ' if m[1] else ','}') within group (order by {m[3]})", OPERATORS[name])
    return spark.sql(sql, **{t: tables[t] for t in tables_of(name)})
