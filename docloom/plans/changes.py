"""Changes of `orders` and `lineitem` as one, with backups; each query shows the tables after it."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.plans.registry import Registry
from docloom.sources.readers import table
from docloom.sources.store import new_name, shared_folder
from docloom.sources.versioned import Database

here = Registry()
query = here.query


def loaded(spark, d) -> Database:
    """Both tables in a new folder, dealt by the order."""
    db = Database(spark, f"{shared_folder(spark)}/{new_name('tables')}")
    change = db.change().create("orders", table(spark, d, "orders"), ["o_orderkey"], buckets=16, shuffle=False)
    change.create("lineitem", table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_orderkey"], 16, shuffle=False).commit()
    return db


@query("""with gone as (select o_orderkey from orders where o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '2-HIGH'))
select o_orderkey, count(l_orderkey) as n_lines, round(coalesce(sum(l_quantity), 0), 2) as quantity from orders left join lineitem on l_orderkey = o_orderkey where o_orderkey not in (select o_orderkey from gone) group by 1""")
def orders_reset(spark, d):
    """Some orders and all of their lines are removed in one change."""
    db = loaded(spark, d)
    gone = table(spark, d, "orders").filter("o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '2-HIGH')").select("o_orderkey")
    db.change().delete("orders", gone).delete("lineitem", gone.withColumnRenamed("o_orderkey", "l_orderkey")).commit()
    lines = db.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    left = db.table("orders").select("o_orderkey").join(lines, "o_orderkey", "left")
    return left.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("n_lines"), F.round(F.coalesce("q", F.lit(0.0)), 2).alias("quantity"))


@query("""with new as (select o_orderkey, o_custkey, null::varchar as o_orderstatus, o_totalprice * 2 as o_totalprice from orders where o_orderpriority = '5-LOW'
  union all select o_orderkey + 1000000000, o_custkey, 'N', o_totalprice from orders where o_orderpriority = '1-URGENT')
select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey, coalesce(n.o_custkey, o.o_custkey) as o_custkey, coalesce(n.o_orderstatus, o.o_orderstatus) as o_orderstatus, round(coalesce(n.o_totalprice, o.o_totalprice), 2) as o_totalprice
from orders o full join new n on n.o_orderkey = o.o_orderkey""")
def orders_upserted(spark, d):
    """New orders, and new prices of some, whose status stays; of two rows of a key the later counts."""
    db, orders = loaded(spark, d), table(spark, d, "orders")
    again = orders.filter("o_orderpriority = '5-LOW'").withColumns({"o_orderstatus": F.lit(None).cast("string"), "o_totalprice": F.col("o_totalprice") * 2})
    early = again.withColumn("o_totalprice", F.lit(0.0))
    more = orders.filter("o_orderpriority = '1-URGENT'").withColumns({"o_orderkey": F.col("o_orderkey") + 1_000_000_000, "o_orderstatus": F.lit("N")})
    rows = again.withColumn("made", F.lit(2)).unionByName(early.withColumn("made", F.lit(1))).unionByName(more.withColumn("made", F.lit(1)))
    db.change().upsert("orders", rows, "made", ("o_orderstatus",)).commit()
    return db.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"))


@query("""with which as (select distinct l_orderkey from lineitem where l_returnflag = 'R' and l_linenumber = 1), old as (select * from lineitem where l_orderkey in (select l_orderkey from which)),
new as (select l_orderkey, 1 as l_linenumber, sum(l_quantity) as l_quantity from old group by 1)
select 'lineitem' as tbl, l_orderkey, l_linenumber, round(l_quantity, 2) as l_quantity, '' as run_id from lineitem where l_orderkey not in (select l_orderkey from which)
union all select 'lineitem', l_orderkey, l_linenumber, round(l_quantity, 2), '' from new union all select 'backup', l_orderkey, l_linenumber, round(l_quantity, 2), 'run-1' from old""")
def lines_replaced(spark, d):
    """The lines of some orders become one line each; what they were is kept under the run's name."""
    db, lines = loaded(spark, d), table(spark, d, "lineitem")
    which = lines.filter("l_returnflag = 'R' and l_linenumber = 1").select("l_orderkey").distinct()
    change = db.change().backup("lineitem", "backup", which, "run-1")
    old = change.table("backup").filter("run_id = 'run-1'")
    rest = [F.first(c).alias(c) for c in lines.columns if c not in ("l_orderkey", "l_linenumber", "l_quantity")]
    new = old.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("l_quantity"), *rest).withColumn("l_linenumber", F.lit(1).cast(lines.schema["l_linenumber"].dataType))
    change.replace("lineitem", which, new).commit()
    shown = [db.table(t).withColumn("tbl", F.lit(t)) for t in ("lineitem", "backup")]
    both = shown[0].withColumn("run_id", F.lit("")).unionByName(shown[1])
    return both.select("tbl", "l_orderkey", "l_linenumber", F.round("l_quantity", 2).alias("l_quantity"), "run_id")
