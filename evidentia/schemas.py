"""Fixed schemas: the archived envelope and the canonical message table."""

from pyspark.sql import types as T

PROJECTION_VERSION = "http-message-v1"
HTTP_KINDS = ("http_backfill", "http_reconciliation")
KINDS = (*HTTP_KINDS, "gateway")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def _texts(names: str) -> list[tuple[str, T.DataType]]:
    return [(name, T.StringType()) for name in names.split()]


PROVENANCE = _struct(
    *_texts("run_id discord_api_version guild_id channel_id operation endpoint"),
    ("pagination", _struct(*_texts("before after"))),
    ("limit", T.IntegerType()),
    *_texts("request_started_at response_completed_at"),
    ("http_status", T.IntegerType()),
    ("capabilities", T.MapType(T.StringType(), T.BooleanType())),
    ("rate_limit", _struct(("limit", T.IntegerType()), ("remaining", T.IntegerType()), ("reset_after_seconds", T.DoubleType()), ("bucket", T.StringType()))),
)
#: payload stays text: its hash is over what was received
ENVELOPE = _struct(*_texts("envelope_version observation_id source_kind observed_at payload"), ("provenance", PROVENANCE))
MESSAGES = T.ArrayType(
    _struct(*_texts("id channel_id"), ("author", _struct(*_texts("id username"), ("bot", T.BooleanType()))), *_texts("content timestamp edited_timestamp"), ("pinned", T.BooleanType()), ("type", T.IntegerType()))
)


def _field(n: int, name: str, kind: T.DataType, required: bool) -> T.StructField:
    return T.StructField(name, kind, not required, {"parquet.field.id": n})


CANONICAL = T.StructType(
    [
        _field(n, name, kind, required)
        for n, (name, kind, required) in enumerate(
            (
                ("message_id", T.StringType(), True),
                ("channel_id", T.StringType(), True),
                ("guild_id", T.StringType(), True),
                ("author_id", T.StringType(), True),
                ("author_username", T.StringType(), False),
                ("author_is_bot", T.BooleanType(), True),
                ("content", T.StringType(), False),
                ("created_at", T.TimestampType(), True),
                ("edited_at", T.TimestampType(), False),
                ("pinned", T.BooleanType(), True),
                ("message_type", T.IntegerType(), True),
                ("observation_id", T.StringType(), True),
                ("observed_at", T.TimestampType(), True),
                ("source_kind", T.StringType(), True),
                ("projection_version", T.StringType(), True),
                ("snowflake_time", T.TimestampType(), True),
            ),
            1,
        )
    ]
)
COLUMNS = CANONICAL.fieldNames()
