"""Record shapes of the topics and tables."""

from __future__ import annotations

import re

from pyspark.sql import types as T

CHANGE = "`database` string, `table` string, `type` string, data map<string,string>, old map<string,string>, ts bigint"
PAGE_LOG = "page map<string,string>, ts bigint"
DEBEZIUM = (
    "op string, before map<string,string>, after map<string,string>, "
    "source struct<db: string, `table`: string>, ts_ms bigint"
)
DIM_ROUTE = "source_table string, sink_table string, sink_family string, sink_columns string, sink_row_key string"
FACT_ROUTE = "source_table string, source_type string, sink_table string, sink_columns string"
DICTIONARY = "dic_code string, info struct<dic_name: string>"
COMMENT_FACT = ["id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts"]
KEYWORD_WINDOW = ["stt", "edt", "cur_date", "keyword", "keyword_count"]
TRAFFIC_WINDOW = ["stt", "edt", "cur_date", "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum"]

# Topic names.
TOPIC_DB = "topic_db"
TOPIC_LOG = "topic_log"
TOPIC_START = "dwd_traffic_start"
TOPIC_ERR = "dwd_traffic_err"
TOPIC_PAGE = "dwd_traffic_page"
TOPIC_ACTION = "dwd_traffic_action"
TOPIC_DISPLAY = "dwd_traffic_display"
TOPIC_COMMENT = "dwd_interaction_comment_info"
TOPIC_DIM = "dim_all"

# How the source database's column types read in Spark.
_PLAIN_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "tinyint": T.ByteType(),
    "varchar": T.StringType(),
    "text": T.StringType(),
    "datetime": T.TimestampType(),
    "date": T.DateType(),
}


def spark_type(database_type: str) -> T.DataType:
    """Spark type of a column type of the source database, such as ``decimal(16,2)`` or ``varchar(20)``."""
    name, arguments = re.fullmatch(r"\s*(\w+)\s*(?:\(([\d\s,]+)\))?.*", database_type.lower()).groups()
    if name == "decimal":
        precision, *scale = (int(n) for n in (arguments or "10,0").split(","))
        return T.DecimalType(precision, scale[0] if scale else 0)
    if name not in _PLAIN_TYPES:
        raise ValueError(f"no Spark type for database type {database_type!r}")
    return _PLAIN_TYPES[name]


def table_schema(columns: dict[str, str]) -> T.StructType:
    """Schema of a source table from its column names and database types."""
    return T.StructType([T.StructField(name, spark_type(kind)) for name, kind in columns.items()])
