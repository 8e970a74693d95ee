"""Removal of long repeats: query. Tests compare it with a table of all windows."""

from pyspark.sql import functions as F

from gazetick.llm.queries.registry import query, table
from gazetick.llm.repeats import remove_repeats


@query("op9_repeats")
def op9_repeats(spark, sf):
    found = remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
