"""Message codecs for the raw-data and prediction topics.

Raw-data messages of the source system carry, as value, a JSON string whose
content is the text form of a Python dict, with the time written as
``Timestamp('yyyy-MM-dd HH:mm:ss')``. Decoding is three built-in steps: read
the JSON string, rewrite ``Timestamp('..')`` to a quoted string, parse with
single quotes allowed. Plain JSON objects are accepted as well. A body
that does not parse goes to dead letters (the ``_corrupt`` text is kept).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import schema as S

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
JSON_OPTIONS = {"timestampNTZFormat": TIME_FORMAT}
_PARSE_OPTIONS = {"allowSingleQuotes": "true", "mode": "PERMISSIVE",
                  "columnNameOfCorruptRecord": "_corrupt", "timestampNTZFormat": TIME_FORMAT}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def encode_key(col) -> Column:
    """F16: message key = decimal text of the id."""
    return _c(col).cast("string")


def dict_text(df: DataFrame, fields: list[str] = S.MESSAGE_FIELDS) -> Column:
    """The text form of a Python dict of the given fields (times as Timestamp('..'))."""
    parts = []
    for i, name in enumerate(fields):
        dtype = df.schema[name].dataType
        if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
            val = F.concat(F.lit("Timestamp('"), F.date_format(name, TIME_FORMAT), F.lit("')"))
        elif isinstance(dtype, T.StringType):
            val = F.concat(F.lit("'"), F.col(name), F.lit("'"))
        else:
            val = F.col(name).cast("string")
        parts += [F.lit(("" if i == 0 else ", ") + f"'{name}': "), val]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def json_string(text: Column) -> Column:
    """JSON encoding of a text value (the one field of an object, without the object)."""
    whole = F.to_json(F.struct(text.alias("v")))
    return F.when(text.isNotNull(), F.regexp_extract(whole, r'^\{"v":(.*)\}$', 1))


def encode_raw_messages(df: DataFrame) -> DataFrame:
    """(key, value) rows as the raw-data producer writes them."""
    return df.select(encode_key(S.TX_ID).alias("key"), json_string(dict_text(df)).alias("value"))


def unwrap_body(value) -> Column:
    """F15 steps 1-2: read the JSON string, rewrite Timestamp('..') to '..'; null if the string is broken."""
    v = F.trim(_c(value).cast("string"))
    inner = F.get_json_object(F.concat(F.lit('{"v":'), v, F.lit("}")), "$.v")
    body = F.when(v.startswith('"'), inner).otherwise(v)
    return F.regexp_replace(body, r"Timestamp\('([^']*)'\)", "'$1'")


def decode_raw_messages(msgs: DataFrame, value_col: str = "value",
                        schema: T.StructType = S.MESSAGE_VALUE) -> DataFrame:
    """Parsed fields plus ``_corrupt`` (non-null when the body is malformed).

    The parsed struct leaves a generator, below which Catalyst pushes no filter
    on its fields: each body is parsed once.
    """
    parse_schema = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(unwrap_body(value_col), parse_schema, _PARSE_OPTIONS)
    return msgs.select("*", F.explode(F.array(parsed)).alias("_m")).select(
        *[c for c in msgs.columns], *[F.col(f"_m.{f.name}").alias(f.name) for f in parse_schema.fields])


def split_dead_letters(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters). A body is dead when it does not parse or has no id."""
    bad = F.col("_corrupt").isNotNull() | F.col(S.TX_ID).isNull()
    return decoded.where(~bad).drop("_corrupt"), decoded.where(bad)


def encode_predictions(df: DataFrame, fields: list[str], decimals: int | None = None) -> DataFrame:
    """key = id text, value = JSON object of the given fields.

    With ``decimals`` floating fields are written as fixed-point numbers with
    that many places (no exponent form).
    """
    cols = []
    for name in fields:
        c = F.col(name)
        if decimals is not None and isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            c = c.cast(f"decimal(38,{decimals})")
        cols.append(c.alias(name))
    return df.select(encode_key(S.TX_ID).alias("key"),
                     F.to_json(F.struct(*cols), JSON_OPTIONS).alias("value"))


def extract_paren_time(col) -> Column:
    """the text between the first parentheses, quotes stripped, parsed as a time."""
    inner = F.regexp_extract(_c(col), r"\((.*?)\)", 1)
    return F.to_timestamp_ntz(F.regexp_replace(inner, "['\"]", ""))
