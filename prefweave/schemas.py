"""Explicit schemas. Every read in the library passes one of these."""

from pyspark.sql import types as T

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])
CONVERSATION = T.ArrayType(MESSAGE)

PAIR = T.StructType([
    T.StructField("pair_id", T.LongType()),
    T.StructField("chosen", CONVERSATION),
    T.StructField("rejected", CONVERSATION),
])

# A pair as turns, a row each (``operators.flat_turns``).
FLAT_PAIR = T.StructType([
    T.StructField("pair_id", T.LongType()),
    T.StructField("side", T.StringType()),
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
])

# The reference's triplet has exactly three strings; we keep the pair key next
# to them because a DataFrame has no "row 0" to preview or split by.
TRIPLET = T.StructType([
    T.StructField("pair_id", T.LongType()),
    T.StructField("prompt", T.StringType()),
    T.StructField("chosen", T.StringType()),
    T.StructField("rejected", T.StringType()),
])

PROMPT = T.StructType([
    T.StructField("pos", T.LongType()),
    T.StructField("prompt", T.StringType()),
])

LOGPROB = T.StructType([
    T.StructField("step", T.LongType()),
    T.StructField("pair_id", T.LongType()),
    T.StructField("pol_c", T.DoubleType()),
    T.StructField("pol_r", T.DoubleType()),
    T.StructField("ref_c", T.DoubleType()),
    T.StructField("ref_r", T.DoubleType()),
])

ANSWER = T.StructType([
    T.StructField("question_id", T.LongType()),
    T.StructField("turn", T.IntegerType()),
    T.StructField("model", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

JUDGEMENT = T.StructType([
    T.StructField("question_id", T.LongType()),
    T.StructField("model_a", T.StringType()),
    T.StructField("model_b", T.StringType()),
    T.StructField("winner", T.StringType()),
])

SCORE = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("turn", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

# Driver-provided tables (only the ones this library reads).
TABLES = {
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]),
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType()),
    ]),
    "benchmark": T.StructType([
        T.StructField("item_id", T.LongType()),
        T.StructField("text", T.StringType()),
    ]),
    "embeddings": T.StructType([
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]),
}
