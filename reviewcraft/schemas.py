"""Declared schemas of the stage tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


CONTEXTS = _struct(
    place_id=T.StringType(),
    llm_input_context=T.StringType(),
    place_name=T.StringType(),
    total_reviews_analyzed=T.LongType(),
    avg_rating=T.DoubleType(),
)

SUMMARIES = _struct(
    place_id=T.StringType(),
    place_name=T.StringType(),
    input_context=T.StringType(),
    target_summary=T.StringType(),
)

CHAT_EXAMPLES = T.StructType(
    [
        T.StructField(
            "messages",
            T.ArrayType(_struct(role=T.StringType(), content=T.StringType())),
            True,
        )
    ]
)
