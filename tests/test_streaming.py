from pyspark.sql import functions as F

from tallywing.functions.text import replace_control
from tallywing.operators.filters import in_domain
from tallywing.operators.ranking import counts


def test_row_operators_and_counts_accept_a_stream(spark, table, tmp_path):
    table([("a\nb", "click"), ("c", "view"), ("d", "other")], "text string, kind string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("text string, kind string").parquet(str(tmp_path / "in"))
    cleaned = in_domain(stream.withColumn("text", replace_control(F.col("text"), " ")), "kind", ["click", "view"])
    query = (
        counts(cleaned, "text").writeStream.format("memory").queryName("counted").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "state")).start()
    )
    query.processAllAvailable()
    query.stop()
    assert sorted(tuple(r) for r in spark.table("counted").collect()) == [("a b", 1), ("c", 1)]
