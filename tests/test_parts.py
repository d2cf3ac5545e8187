"""Parts of documents made where they are read, against units() that gathers lines by document."""

from pyspark.sql import functions as F

from docloom.operators import evidence


def test_parts_are_the_units_without_a_shuffle(spark):
    line = lambda k, n=50: f"line {k} " + "x" * n
    texts = [None, "", "\n\n" + line(1), "\n".join(line(k) for k in range(30)), "title\n" + "\n".join([line(1), line(1), line(2, 900), line(3), " " + line(1) + "  "]), "\n".join("a" * 180 + str(k) for k in range(5))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = evidence.parts(docs)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    unit = F.concat(F.col("doc_id").cast("string"), F.when(F.col("line_no") == 0, ":title").otherwise(F.concat(F.lit(":line_"), F.col("line_no").cast("string"))))
    got = sorted(map(tuple, found.select(unit, "text").collect()))
    assert got == sorted(map(tuple, evidence.units(docs).select("unit_id", "text").collect())) and len(got) > 15
