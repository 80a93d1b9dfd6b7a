"""User functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkweave.functions import udfs as U
from sparkweave.operators import limits as R
from sparkweave.operators import text as X
from sparkweave.operators import vectors as V
from sparkweave.plans.common import SQL_CRC_TABLE, n_rows, sql_crc32, sql_units
from sparkweave.plans.q_streams import MINUTE, instants, sql_token_bucket
from sparkweave.plans.q_text import SQL_WORDS, sql_word_chunks
from sparkweave.plans.registry import query


@query("U01_sql_functions", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_discount, 0) AS ratio, round(l_extendedprice * 100) / 100 AS dollars FROM lineitem")
def _(t):
    U.register_sql_functions(t.spark)
    t.register("lineitem")
    return t.spark.sql("""
        SELECT l_orderkey, l_linenumber, l_partkey, ratio_or_null(l_extendedprice, l_discount) AS ratio,
               cents_to_dollars(round(l_extendedprice * 100)) AS dollars FROM lineitem""")


@query("U02_vectorised_scalar", rf"SELECT doc_id, len({SQL_WORDS.format('text')})::BIGINT AS n_words, true AS agrees FROM documents")
def _(t):
    native = F.size(X.words("text")).cast("bigint")
    both = t.spread("documents").select("doc_id", U.word_count("text").alias("n_words"), native.alias("native"))
    return both.select("doc_id", "n_words", (F.col("n_words") == F.col("native")).alias("agrees"))


@query("U03_user_aggregate", """
SELECT event_type, count(*) AS n, round(var_samp(value), 4) AS variance FROM events GROUP BY 1""")
def _(t):
    return U.variance_by(t.events, "event_type", "value").withColumn("variance", F.round("variance", 4))


@query("U04_table_function", f"SELECT doc_id, chunk_no, md5(chunk) AS chunk FROM ({sql_word_chunks(300, 50)})")
def _(t):
    t.spark.udtf.register("chunk_words", U.ChunkWords)
    t.register("documents")
    return t.spark.sql("SELECT doc_id, c.chunk_no, md5(c.chunk) AS chunk FROM documents, LATERAL chunk_words(text, 300, 50) c")


@query("U05_grouped_map", f"""WITH {sql_token_bucket(5, 30 * MINUTE)}
SELECT user_id, count(*) FILTER (WHERE allowed) AS allowed, count(*) AS n FROM s GROUP BY 1""")
def _(t):
    e = instants(t).withColumn("minute", F.floor(F.col("at") / MINUTE))
    out = R.token_bucket(e, "user_id", "at", "event_id", capacity=5, refill=30 * MINUTE, bin_col="minute")
    return out.groupBy("user_id").agg(F.count_if(F.col("allowed")).alias("allowed"), n_rows().alias("n"))


@query("U06_stateful_function", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1")
def _(t):
    from sparkweave.plans.q_streams import events
    from sparkweave.streaming import runs as G
    from sparkweave.streaming import state as Z

    with G.rocksdb_state(t.spark):
        log = G.to_batches(Z.latest_values(events(t).select("user_id", "event_id", "props"), "user_id", "event_id", "props"), "state", "update")
    return log.groupBy("user_id").agg(F.max("event_id").alias("event_id"))


@query("U07_batch_embedding", f"""
WITH RECURSIVE {SQL_CRC_TABLE}, w AS (SELECT DISTINCT doc_id, unnest({SQL_WORDS.format('lower(text)')}) AS w FROM documents),
s AS (SELECT doc_id, count(DISTINCT {sql_crc32('x')} % 64) AS filled FROM (SELECT doc_id, hex(encode(w)) AS x FROM w), crc_table GROUP BY 1)
SELECT doc_id, 64::INTEGER AS dims, coalesce(filled, 0)::INTEGER AS filled, CASE WHEN filled IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS norm FROM documents LEFT JOIN s USING (doc_id)""")
def _(t):
    vectors = U.embed_batches(t.spread("documents"), "doc_id", "text", U.hash_embedder(64), batch_size=32, retries=2)
    filled = F.size(F.filter("embedding", lambda x: x != 0))
    return vectors.select("doc_id", F.size("embedding").alias("dims"), filled.alias("filled"), F.round(V.norm(F.col("embedding")), 3).alias("norm"))
