from pyspark.sql import functions as F

from conftest import SF_DIR
from sonoloom.functions import text as tx
from sonoloom.operators import tables


def test_row_functions_apply_to_a_stream(spark):
    batch = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stream = spark.readStream.schema(batch.schema).option("pathGlobFilter", "documents.parquet").parquet(SF_DIR)

    def steps(df):
        df = tables.where_equal(df, "lang", "fr")
        return df.select("doc_id", tables.if_not_empty(tx.normalise_or_empty(F.col("text"), "fr")).alias("text"))

    query = steps(stream).writeStream.format("memory").queryName("rows").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted(spark.table("rows").collect()) == sorted(steps(batch).collect())
