"""Labels, kinds, quantities, windows and chunks: queries and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import labels as lb
from docloom.sources.readers import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _matched(rules: dict) -> str:
    each = ", ".join(f"case when regexp_matches(text, '{lb.near(*cues)}') then '{name}' end" for name, cues in rules.items())
    return f"list_filter([{each}], lambda x: x is not null)"


LABELS = f"with l as (select doc_id, {_matched(lb.PROBLEMS)} as own, {_matched(lb.EFFECTS)} as effects from documents)"
ANSWERS = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in lb.DERIVED.items()) + "}"


@query(LABELS + ", r as (select doc_id, 'problem' as kind, unnest(own) as label from l union all select doc_id, 'effect', unnest(effects) from l) select doc_id, kind, label from r")
def label_rules(spark, d):
    docs = table(spark, d, "documents")
    sets = (("problem", lb.PROBLEMS), ("effect", lb.EFFECTS))
    both = F.concat(*[lb.of_kind(kind, lb.matched(F.col("text"), rules)) for kind, rules in sets])
    return docs.select("doc_id", F.explode(both).alias("x")).select("doc_id", "x.kind", "x.label")


@query(LABELS + f""", r as (select doc_id, own, effects, list_transform(effects, lambda e: {ANSWERS}[e]) as a from l)
select doc_id, array_to_string(case when len(own) > 0 then own else list_filter(a, lambda x, i: list_position(a, x) = i)[1:4] end, ',') as problems, array_to_string(effects, ',') as effects from r""")
def label_derive(spark, d):
    rows = lb.labelled(table(spark, d, "documents"))
    return rows.select("doc_id", F.array_join("problems", ",").alias("problems"), F.array_join("effects", ",").alias("effects"))


KIND_LIST = ", ".join(f"case when regexp_matches(left(text, 260), '(?i){cue}') then '{name}' end" for name, cue in lb.KINDS.items())


@query(f"""with k as (select conv_id, turn, role, list_filter([{KIND_LIST}], lambda x: x is not null) as f from conversations)
select conv_id, turn, role, f[1] as primary_kind, array_to_string(f[2:], ',') as secondary_kinds from k""")
def claim_kinds(spark, d):
    primary, secondary = lb.kinds(F.col("text"))
    return table(spark, d, "conversations").select("conv_id", "turn", "role", primary.alias("primary_kind"), F.array_join(secondary, ",").alias("secondary_kinds"))


@query(f"""with q as (select doc_id, regexp_extract_all(coalesce(text, ''), '{lb.QUANTITY}') as l from documents),
f as (select doc_id, list_filter(l, lambda x, i: list_position(l, x) = i)[1:30] as l from q)
select doc_id, array_to_string(l, '|') as quantities, len(l)::bigint as n from f""")
def numbers_conditions(spark, d):
    q = lb.quantities(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.array_join(q, "|").alias("quantities"), F.size(q).cast("long").alias("n"))


CUE = "license|warranty|copyright"


@query(rf"""with a as (select doc_id, text, instr(text, regexp_extract(text, '{CUE}')) as pos from documents where regexp_matches(text, '{CUE}'))
select doc_id, trim(regexp_replace(substring(text, greatest(pos - 160, 1), pos + 900 - greatest(pos - 160, 1)), '\s+', ' ', 'g')) as snippet from a""")
def snippet_windows(spark, d):
    docs = table(spark, d, "documents").filter(F.col("text").rlike(CUE))
    return docs.select("doc_id", lb.window_of(F.col("text"), CUE).alias("snippet"))


@query("""with recursive p as materialized (select conv_id, turn, coalesce(length(text), 0) as n, row_number() over (partition by conv_id order by turn, coalesce(length(text), 0)) as i from conversations),
r(conv_id, i, turn, n, chunk_no, used) as (select conv_id, i, turn, n, 1, n from p where i = 1
  union all select p.conv_id, p.i, p.turn, p.n, case when r.used + 1 + p.n > 500 then r.chunk_no + 1 else r.chunk_no end, case when r.used + 1 + p.n > 500 then p.n else r.used + 1 + p.n end
  from r join p on p.conv_id = r.conv_id and p.i = r.i + 1)
select conv_id, chunk_no, min(turn) as first_turn, max(turn) as last_turn, cast(sum(n) + count(*) - 1 as bigint) as n_chars from r group by 1, 2""")
def greedy_chunks(spark, d):
    return lb.chunks(table(spark, d, "conversations"), 500)
