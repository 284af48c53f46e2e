"""What the sources and sinks of the library give back, over the tables written out and read again."""

from pyspark.sql import functions as F

from tessera.operators.work import new_folder
from tessera.plans.base import query, table
from tessera.sources import bson, readers, workbooks, writers


@query("SELECT lower(lpad(printf('%x', doc_id), 24, '0')) AS _id, doc_id, source, n_chars, text FROM documents WHERE doc_id >= 100 AND lang <> 'en' AND source IS NOT NULL")
def dump_ranges(spark, sf_dir):
    """Documents as a dump with key ranges, of which a filter on the key opens some."""
    folder = new_folder(spark, "dump")
    d = bson.documents_of(table(spark, sf_dir, "documents"), "doc_id").repartitionByRange(8, "_id").sortWithinPartitions("_id")
    bson.write_dump(d, f"{folder}/dump")
    bson.index_dump(spark, f"{folder}/dump", f"{folder}/index", 1_000_000)
    back = bson.read_dump(spark, f"{folder}/dump", f"{folder}/index", "_id string, doc_id long, source string, n_chars long, text string, lang string")
    return back.where((F.col("_id") >= f"{100:024x}") & (F.col("lang") != "en") & F.col("source").isNotNull()).drop("lang")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents WHERE text IS NOT NULL AND text <> ''")
def csv_round_trip(spark, sf_dir):
    """Texts with line ends and quotes through quoted CSV and back, in two files of a pattern, too."""
    folder = new_folder(spark, "csv")
    writers.csv(table(spark, sf_dir, "documents").where("text <> ''").repartition(2), f"{folder}/part")
    back = readers.csv_tolerant(spark, f"{folder}/pa*", ["doc_id", "text", "lang", "source", "n_chars"])
    return back.select(F.col("doc_id").cast("long"), "text", "lang", "source", F.col("n_chars").cast("long"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def csv_glob_round_trip(spark, sf_dir):
    folder, o = new_folder(spark, "glob"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    for k in range(2):
        writers.csv(o.where(F.col("o_orderkey") % 2 == k), f"{folder}/orders{k}")
    back = readers.csv_glob(spark, f"{folder}/orders*")
    return back.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), "o_orderstatus", "o_orderpriority")


@query("SELECT conv_id, turn, role, text FROM conversations")
def json_round_trip(spark, sf_dir):
    folder, c = new_folder(spark, "json"), table(spark, sf_dir, "conversations")
    writers.json(c, f"{folder}/rows")
    return spark.read.schema(c.schema).json(f"{folder}/rows")


@query("SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN value END AS value FROM events")
def parquet_parts(spark, sf_dir):
    """Files of unlike columns as one table; what a file lacks is null."""
    folder, e = new_folder(spark, "parts"), table(spark, sf_dir, "events")
    writers.parquet(e.where("event_id % 2 = 0").select("event_id", "user_id"), f"{folder}/a")
    writers.parquet(e.where("event_id % 2 = 1").select("event_id", "user_id", "value"), f"{folder}/b")
    return readers.parquet_parts(spark, f"{folder}/a", f"{folder}/b").select("event_id", "user_id", "value")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def deleted_by_keys(spark, sf_dir):
    """A table without the keys that another one names."""
    gone = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return writers.without(table(spark, sf_dir, "orders").select("o_orderkey"), gone, "o_orderkey")


@query("SELECT c_custkey, c_mktsegment FROM customer")
def appended_once(spark, sf_dir):
    """Batches that overlap, appended to one table: each key once."""
    folder, c = new_folder(spark, "append"), table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    for batch in (c.where("c_custkey % 3 < 2"), c.where("c_custkey % 3 > 0"), c):
        writers.append_new(batch, f"{folder}/table", "c_custkey")
    return spark.read.parquet(f"{folder}/table")


@query("SELECT conv_id, turn, role, text, role AS sheet FROM conversations WHERE text <> ''")
def workbook_round_trip(spark, sf_dir):
    """Conversations as workbooks with a sheet for each role, and all sheets read again."""
    folder, c = new_folder(spark, "books"), table(spark, sf_dir, "conversations").where("text <> ''")
    workbooks.write_workbook(c.withColumn("feuille", F.col("role")).repartition(2), f"{folder}/books", sheet_column="feuille")
    return workbooks.read_workbook(spark, f"{folder}/books", "conv_id long, turn long, role string, text string, _sheet string").withColumnRenamed("_sheet", "sheet")
