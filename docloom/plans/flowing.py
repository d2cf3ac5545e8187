"""Documents through a flow of stages: taken in two lots, with failures that wait and are tried again."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.operators import claims
from docloom.plans import patents
from docloom.plans.registry import Registry
from docloom.sources.flows import Flow
from docloom.sources.readers import table
from docloom.sources.store import new_name, shared_folder

here = Registry()
query = here.query
SHORT = 200  # characters; a document with fewer than this is not taken for one with evidence


def lines(rows):
    """The lines of a document that hold text; a document without one, or with too little text, fails."""
    text = F.coalesce(F.col("text"), F.lit(""))
    some = rows.withColumn("error", F.when(~text.rlike(r"[^ \t-\r]"), "no text").when(F.length(text) < SHORT, "too short"))
    cut = F.when(F.col("error").isNull(), F.split("text", "\n")).otherwise(F.array(F.lit("")))
    out = some.select("doc_id", "_part", "error", F.posexplode(cut).alias("line_no", "line"))
    return out.filter(F.col("error").isNotNull() | F.col("line").rlike(r"[^ \t-\r]"))


def audited(rows):
    """Lines, each with its severity as a claim's text; a document with a severe line fails."""
    audit = claims.audited(rows.select("doc_id", "_part", "line_no", F.col("line").alias("text"), F.lit(None).cast("string").alias("claim_type")))
    return audit.select("doc_id", "_part", "line_no", "severity", F.when(F.col("bucket") == "severe", "severe line").alias("error"))


def counted(rows):
    return rows.groupBy("doc_id", "_part").agg(F.count("*").alias("n_lines"), F.sum("severity").alias("severity"))


def flowed(spark, d) -> Flow:
    """English documents first, then all; what fails is tried once more."""
    flow = Flow(spark, f"{shared_folder(spark)}/{new_name('flow')}", "doc_id", [("lines", lines), ("audited", audited), ("counted", counted)], parts=32, at_once=32, tries=2)
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    flow.take(docs.filter("lang = 'en'"))
    flow.run()
    flow.take(docs)
    flow.run()
    flow.retry()
    flow.run()
    return flow


LINES = rf"""with t as (select doc_id, coalesce(text, '') as text from documents),
e as (select doc_id, text, case when not regexp_matches(text, '[^ \t-\r]') then 'no text' when length(text) < {SHORT} then 'too short' end as error from t)"""


@query(rf"""{LINES}, l as (select doc_id, unnest(string_split(text, chr(10))) as line from e where error is null)
select doc_id, count(*) as n_lines, sum(length(line)) as n_chars from l where regexp_matches(line, '[^ \t-\r]') group by 1""")
def flow_lines(spark, d):
    """Per document that passed the first stage: its lines with text and their characters."""
    return flowed(spark, d).table("lines").groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


DOCS_AS_CLAIMS = f"select doc_id, case when doc_id % 2 = 0 then 'independent' else 'dependent' end as claim_type, {patents.CLEAN.format('text')} as t from documents"
LINES_AS_CLAIMS = f"select id as doc_id, null::varchar as claim_type, {patents.CLEAN.format('line')} as t from l"
AUDIT = patents.AUDIT.removeprefix("with ").replace(DOCS_AS_CLAIMS, LINES_AS_CLAIMS)


@query(rf"""{LINES}, u as (select doc_id, string_split(text, chr(10)) as lines from e where error is null), n as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as k from u),
l as (select doc_id as doc, doc_id || ':' || k as id, line from n where regexp_matches(line, '[^ \t-\r]')), {AUDIT},
d as (select doc, count(*) as n_lines, sum(severity)::bigint as severity, bool_or(bucket = 'severe') as bad from l join a on a.doc_id = l.id group by 1)
select doc as doc_id, case when bad then 'audited' else 'counted' end as stage, case when bad then 'failed' else 'done' end as status, case when bad then 'severe line' end as error, case when bad then 2 end as tries,
  case when not bad then n_lines end as n_lines, case when not bad then severity end as severity from d
union all select doc_id, 'lines', 'failed', error, 2, null, null from e where error is not null""")
def flow_status(spark, d):
    """Every document with the stage it reached: done, or failed with its error and how often it was tried."""
    flow = flowed(spark, d)
    done = flow.table("counted").select("doc_id", F.lit("counted").alias("stage"), F.lit("done").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("int").alias("tries"), "n_lines", "severity")
    return done.unionByName(flow.quarantine().withColumn("status", F.lit("failed")), allowMissingColumns=True)
