"""Schemas of the tables that readers and writers exchange."""

from pyspark.sql import types as T

ARTICLES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)
SHARD_LINES = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("shard", T.IntegerType()),
    ]
)
VOCAB = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("piece", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("kind", T.StringType()),
    ]
)
TOKEN_BLOCKS = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.IntegerType())),
    ]
)
