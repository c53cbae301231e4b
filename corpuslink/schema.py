"""Fixed schemas (never inferred)."""

from pyspark.sql import types as T

BOOKS = T.StructType([
    T.StructField("book_id", T.IntegerType(), False),
    T.StructField("book_number", T.IntegerType(), False),
    T.StructField("book_name", T.StringType(), False),
    T.StructField("testament", T.StringType(), False),
    T.StructField("expected_chapters", T.IntegerType(), True),
])

# One element of a chapter payload file: a JSON list of these objects.
PAYLOAD_ITEM = T.StructType([
    T.StructField("verse", T.LongType(), True),
    T.StructField("text", T.StringType(), True),
])
