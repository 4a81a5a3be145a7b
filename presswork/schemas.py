"""Explicit schemas; nothing in the package relies on inference."""

from pyspark.sql import types as T

ARTICLE = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("content", T.StringType(), False),
    T.StructField("journalist_id", T.StringType()),
    T.StructField("journalist_name", T.StringType(), False),
    T.StructField("publisher", T.StringType(), False),
    T.StructField("published_at", T.TimestampType(), False),
    T.StructField("naver_url", T.StringType(), False),
    T.StructField("clickbait_score", T.IntegerType()),
    T.StructField("clickbait_explanation", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

JOURNALIST = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("publisher", T.StringType(), False),
    T.StructField("naver_uuid", T.StringType()),
    T.StructField("article_count", T.LongType()),
    T.StructField("avg_clickbait_score", T.DoubleType()),
    T.StructField("max_score", T.IntegerType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

#: The journalist table with its partition column.
JOURNALIST_TABLE = T.StructType([*JOURNALIST, T.StructField("bucket", T.IntegerType())])

#: The side table of stored URLs with its partition column.
STORED_URL = T.StructType([T.StructField("naver_url", T.StringType()), T.StructField("bucket", T.IntegerType())])

BATCH = T.StructType([
    T.StructField("batch_id", T.StringType(), False),
    T.StructField("status", T.StringType()),
    T.StructField("article_count", T.LongType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("completed_at", T.TimestampType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("recovered", T.BooleanType()),
])

SEARCH_ITEM = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("originallink", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("pubDate", T.StringType()),
])

SEARCH_RESPONSE = T.StructType([T.StructField("items", T.ArrayType(SEARCH_ITEM))])

TREND_RESPONSE = T.StructType([
    T.StructField("trending_searches", T.ArrayType(
        T.StructType([T.StructField("query", T.StringType())])
    )),
])

RESULT_LINE = T.StructType([
    T.StructField("custom_id", T.StringType()),
    T.StructField("response", T.StructType([
        T.StructField("body", T.StructType([
            T.StructField("choices", T.ArrayType(T.StructType([
                T.StructField("message", T.StructType([
                    T.StructField("content", T.StringType()),
                ])),
            ]))),
        ])),
    ])),
])
