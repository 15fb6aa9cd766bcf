"""Fixed schemas shared by the operators.

The key/value entry follows the row / column family / qualifier / timestamp ->
value model of the Bigtable paper (Chang et al., OSDI 2006).  The exact shape
is our decision: the reference only names its entry classes.
"""

from pyspark.sql import types as T

ENTRY_COLUMNS = ["table_name", "row_key", "family", "qualifier", "ts", "value"]
ENTRY_KEY = ["table_name", "row_key", "family", "qualifier"]
ENTRY_DDL = ("table_name string, row_key string, family string, qualifier string, "
             "ts timestamp_ntz, value string")

ENTRY_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("row_key", T.StringType(), False),
    T.StructField("family", T.StringType(), False),
    T.StructField("qualifier", T.StringType(), False),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("value", T.StringType(), True),
])

QUARANTINE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("failed_at", T.TimestampNTZType(), False),
    T.StructField("reason", T.StringType(), True),
])
