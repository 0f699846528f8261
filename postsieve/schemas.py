"""Schemas of the tables that pass between the stages."""

from pyspark.sql import types as T

# Column names and their order.
MAIL_CONTAINER = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("encoding", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("from", T.StringType()),
    T.StructField("to", T.StringType()),
    T.StructField("cc", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("body", T.BinaryType()),
    T.StructField("nbr_files", T.IntegerType()),
    T.StructField("files", T.ArrayType(T.StringType())),
    T.StructField("message_id", T.StringType()),
    T.StructField("tmstmp", T.TimestampType()),
    T.StructField("cte", T.StringType()),
    T.StructField("umid", T.StringType()),
    T.StructField("specfiles", T.ArrayType(T.StringType())),
    T.StructField("nbr_specfiles", T.IntegerType()),
])

#: columns the corpus build does not need
CONTAINER_EXTRAS = (
    "mid", "type", "to", "cc", "nbr_files", "files", "umid", "tmstmp", "cte",
)

MAIL_CORPUS_COLUMNS = (
    "date", "time", "from", "subject", "body", "message_id", "specfiles",
    "nbr_specfiles", "body_clean",
)

CAPTURE_CORPUS_COLUMNS = (
    "batchklasse", "batchcontent", "batchid", "docid", "doctype", "confidence",
    "autoclass", "pagecount", "doccount", "inputchannel", "sourcesystem",
    "nbr_doctypes", "body_clean",
)

#: fields of a message header
HEADER = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("to", "from", "cc", "bcc", "sub", "date_raw", "date", "time",
                 "ctype", "cte", "umid")
])
