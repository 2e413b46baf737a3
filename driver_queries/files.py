"""Sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from driver_queries.feedback import RAW, raw_feedback
from driver_queries.registry import query, r6, table
from tallywing.operators.ranking import top_per_group
from tallywing.session import scratch_path, settle
from tallywing.sources.files import (
    read_country_codes,
    read_countries,
    read_feedback,
    read_inferred,
    read_mixed_encodings,
    read_strings,
    read_typed,
    rows_per_file,
    valid_rows,
)
from tallywing.sources.sinks import materialize, preview, write_csv, write_key_value, write_parquet

RAW_CTE = f"""raw as (select {", ".join(f"{e} as {n}" for n, e in RAW.items())}
        from documents left join labels using (doc_id) cross join (values (0), (1)) c(copy))"""
KEPT = [c for c in RAW if c not in ("text", "_trust", "negativereason_gold")]


def shown(rows):
    return rows.select(
        *KEPT, r6("_trust").alias("_trust"), F.sha2("text", 256).alias("text"),
        F.sha2("negativereason_gold", 256).alias("negativereason_gold"),
    )


SHOWN = f"""select {", ".join(KEPT)}, round(_trust, 6) as _trust, sha256(text) as text,
       sha256(negativereason_gold) as negativereason_gold from raw"""


@query(f"with {RAW_CTE} {SHOWN}")
def csv_scan(spark, sf):
    """Multi-line quoted fields, checked header, one scan of all files."""
    path = scratch_path(spark, "feedback-csv")
    write_csv(raw_feedback(spark, sf), path)
    return shown(read_feedback(spark, path))


@query(f"with {RAW_CTE} {SHOWN}")
def csv_single_file(spark, sf):
    path = scratch_path(spark, "feedback-one-csv")
    write_csv(raw_feedback(spark, sf), path, single_file=True)
    return shown(read_feedback(spark, path))


def named_files(spark, rows, path, names):
    """Write rows (with a column ``file``): each task writes, in a folder of its own, one CSV file for each value, under the name listed for it.

    So no row is shuffled, and neither a file nor a task that writes one grows with the table; the folders become more.
    """
    parts = scratch_path(spark, "parts")
    options = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.withColumn("folder", F.spark_partition_id()).write.partitionBy("folder", "file").options(**options).csv(parts)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in (s.getPath() for s in files.listStatus(hadoop.Path(parts)) if s.isDirectory()):
        to = hadoop.Path(path, folder.getName().replace("=", "-"))
        files.mkdirs(to)
        for value, name in names.items():
            at = hadoop.Path(folder, f"file={value}")
            if files.exists(at):  # a task may have no row of a value
                (found,) = [s.getPath() for s in files.listStatus(at) if s.getPath().getName().endswith(".csv")]
                files.rename(found, hadoop.Path(to, name))


@query(f"with {RAW_CTE} select 'f' || (_unit_id % 5) || '.csv' as file_name, count(*) as rows from raw group by 1")
def csv_rows_per_file(spark, sf):
    """Rows of each file by its name; the combined file is no part of the table."""
    path, rows = scratch_path(spark, "feedback-csv"), raw_feedback(spark, sf)
    named_files(spark, rows.withColumn("file", F.expr("_unit_id % 5")), path, {i: f"f{i}.csv" for i in range(5)})
    named_files(spark, rows.withColumn("file", F.lit(9)), path, {9: "combined_csv.csv"})
    return rows_per_file(read_feedback(spark, f"{path}/*", file_column="file"), "file")


@query(f"with {RAW_CTE} {SHOWN}")
def csv_headers(spark, sf):
    """Files whose headers differ in order and case or have more columns, next to a combined file that repeats all rows."""
    path = scratch_path(spark, "mixed-headers")
    rows = raw_feedback(spark, sf).withColumn("file", F.expr("_unit_id % 4"))
    names = list(RAW)
    layouts = [names, names[::-1], [n.upper() for n in names[13:] + names[:13]], ["extra_first", *names[5:], "_Extra", *names[:5]]]
    for i, layout in enumerate(layouts):
        part = rows.filter(F.col("file") == i).withColumns({"extra_first": F.lit("x, y"), "_Extra": F.col("_unit_id")})
        named_files(spark, part.select(*(F.col(n).alias(n) for n in layout), "file"), path, {i: f"f{i}.csv"})
    named_files(spark, rows.withColumn("file", F.lit(9)), path, {9: "combined_csv.csv"})
    return shown(read_feedback(spark, f"{path}/*"))


@query("""
select o_orderkey, o_orderstatus, o_orderpriority from orders where o_orderkey % 10 <> 0""")
def csv_valid_rows(spark, sf):
    """Rows that lack a field are recognised while parsing."""
    path = scratch_path(spark, "orders-csv")
    whole = F.concat_ws(",", "o_orderkey", "o_orderstatus", F.format_string('"%s"', "o_orderpriority"))
    short = F.concat_ws(",", "o_orderkey", "o_orderstatus")
    lines = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 10 == 0, short).otherwise(whole).alias("value"))
    lines.write.text(path)
    schema = "o_orderkey bigint, o_orderstatus string, o_orderpriority string"
    return valid_rows(read_feedback(spark, path, schema, corrupt_column="_bad", header=False, pattern="*.txt"), "_bad")


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate, o_orderpriority from orders")
def csv_typed(spark, sf):
    path = scratch_path(spark, "typed-csv")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "M/d/yyyy HH:mm:ss").alias("o_orderdate"), "o_orderpriority"
    )
    write_csv(rows, path)
    typed = read_typed(spark, path, "o_orderkey bigint, o_orderdate timestamp, o_orderpriority string")
    return typed.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query("select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, round(c_acctbal, 6) as c_acctbal from customer")
def csv_inferred(spark, sf):
    path = scratch_path(spark, "customer-csv")
    write_csv(table(spark, sf, "customer"), path)
    return read_inferred(spark, path).select(
        F.col("c_custkey").cast("bigint"), "c_name", F.col("c_nationkey").cast("bigint"), r6("c_acctbal").alias("c_acctbal")
    )


@query("""select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey, c_mktsegment,
       round(c_acctbal, 6) as c_acctbal from customer""")
def csv_strings(spark, sf):
    path = scratch_path(spark, "customer-csv")
    write_csv(table(spark, sf, "customer"), path)
    return read_strings(spark, path).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", r6(F.col("c_acctbal").cast("double")).alias("c_acctbal"))


@query("select doc_id, sha256(text) as text, lang from documents")
def csv_mixed_encodings(spark, sf):
    """Texts that ISO-8859-1 can hold go to files of that encoding, the others to UTF-8 files."""
    path = scratch_path(spark, "mixed-csv")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    latin = ~F.col("text").rlike("[^\\x00-\\xff]")
    options = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.filter(latin).write.options(**options, encoding="ISO-8859-1").csv(f"{path}/texts")
    docs.filter(~latin).write.mode("append").options(**options).csv(f"{path}/texts")
    named_files(spark, docs.withColumn("file", F.lit(9)), path, {9: "combined_csv.csv"})
    read = read_mixed_encodings(spark, f"{path}/*", "doc_id bigint, text string, lang string")
    return read.select("doc_id", F.sha2("text", 256).alias("text"), "lang")


@query("""
select cast(n_nationkey as bigint) as id, n_name as name, 'N' || n_nationkey as iso3,
       round(n_nationkey + 0.5e0, 6) as latitude, round(-n_nationkey - 0.25e0, 6) as longitude from nation""")
def json_countries(spark, sf):
    """A JSON array with nested fields that are not read."""
    path = scratch_path(spark, "countries-json")
    country = F.expr("""to_json(struct(n_nationkey as id, n_name as name, concat('N', n_nationkey) as iso3,
        concat(n_nationkey, '.5') as latitude, concat('-', n_nationkey, '.25') as longitude,
        array(struct('UTC' as zone)) as timezones, map('de', n_name) as translations))""")
    one = table(spark, sf, "nation").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(country)), F.lit("]")))
    one.write.text(path)
    return read_countries(spark, path)


@query("select 'N' || n_nationkey as code, n_name || ', the' as name from nation")
def tsv_codes(spark, sf):
    path = scratch_path(spark, "codes-tsv")
    table(spark, sf, "nation").selectExpr("concat('N', n_nationkey, '\t', n_name, ', the') as value").write.text(path)
    return read_country_codes(spark, path)


@query("select o_orderpriority, count(*) as n from orders group by all")
def materialize_once(spark, sf):
    """The second call finds the finished table and does not build."""
    path = scratch_path(spark, "summary")

    def build():
        return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))

    def never():
        raise AssertionError("built twice")

    materialize(spark, path, build)
    return materialize(spark, path, never)


@query("""
select 'first' as build, o_orderpriority, count(*) as n from orders group by all
union all select 'same', o_orderpriority, count(*) from orders group by all
union all select 'options', o_orderpriority, count(*) from orders where o_orderstatus = 'F' group by all
union all select 'inputs', o_orderpriority, 2 * count(*) from orders where o_orderstatus = 'F' group by all""")
def materialize_changes(spark, sf):
    """Reused while inputs and options are the same; built again when an option or an input file is another."""
    source, path = scratch_path(spark, "orders"), scratch_path(spark, "summary")
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus")
    orders.write.parquet(source)
    parts = []

    def state(name, status, may_build=True):
        def build():
            if not may_build:
                raise AssertionError("built without need")
            rows = spark.read.parquet(source)
            rows = rows.filter(F.col("o_orderstatus") == status) if status else rows
            return rows.groupBy("o_orderpriority").agg(F.count("*").alias("n"))

        found = materialize(spark, path, build, [source], {"status": status})
        parts.append(settle(found.select(F.lit(name).alias("build"), "*")))

    state("first", None)
    state("same", None, may_build=False)
    state("options", "F")
    orders.write.mode("append").parquet(source)
    state("inputs", "F")
    return reduce(DataFrame.union, parts)


@query("""
with c as (select p_brand, p_type, count(*) n from part group by all),
m as (select p_brand, n, max(p_type) p_type from c group by p_brand, n),
r as (select *, row_number() over (partition by p_brand order by n desc) rk from m)
select p_brand || chr(9) || p_type || '_' || n as line from r where rk <= 5""")
def key_value_text(spark, sf):
    path = scratch_path(spark, "reasons-text")
    top = top_per_group(table(spark, sf, "part"), "p_brand", "p_type", 5, one_per_count=True)
    write_key_value(top, "p_brand", "p_type", "n", path=path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("select s_suppkey, s_name from supplier")
def replace_output(spark, sf):
    """A second write leaves nothing of the first."""
    path = scratch_path(spark, "replaced")
    write_parquet(table(spark, sf, "customer"), path)
    write_parquet(table(spark, sf, "supplier").select("s_suppkey", "s_name"), path)
    return spark.read.parquet(path)


@query("select o_orderkey, o_orderpriority from orders order by o_orderkey desc limit 5")
def preview_rows(spark, sf):
    return preview(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").orderBy(F.desc("o_orderkey")))
