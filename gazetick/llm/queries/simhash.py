"""SimHash near-dedup: query. DuckDB has no XXH64 with a seed; tests compare with all pairs by brute force."""

from pyspark.sql import functions as F

from gazetick.llm.queries.registry import query, table
from gazetick.llm.simhash import near_duplicates


@query("op3_simhash")
def op3_simhash(spark, sf):
    found = near_duplicates(table(spark, sf, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), hexed.alias("fingerprint"), F.col("root").alias("component_id"))
