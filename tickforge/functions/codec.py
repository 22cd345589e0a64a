"""JSON text to columns and back."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickforge.functions.columns import as_column


# Fixed value: keeps microseconds, which the default format cuts to milliseconds.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
#: Options under which JSON text keeps NULL fields and whole timestamps.
FAITHFUL = {"ignoreNullFields": "false", "timestampFormat": TIMESTAMP_FORMAT}


def json_text(value) -> Column:
    """Message bytes (or text) as one line of JSON text.

    A raw line break can only be whitespace in JSON, so it is safe to turn it into
    a space; line-based files need that.
    """
    return F.regexp_replace(as_column(value).cast("string"), r"[\r\n]+", " ")


def decode(value, schema: StructType, malformed_text: str | None = None) -> Column:
    """JSON text to one column per field, for use in a select; malformed text gives NULLs.

    With ``malformed_text`` a column of that name holds the text that did not parse.
    The struct is unpacked by a generator: Spark would otherwise copy the parse into
    every filter that it pushes below the projection.
    """
    options = {}
    if malformed_text:
        schema = StructType([*schema.fields, StructField(malformed_text, StringType(), True)])
        options = {"columnNameOfCorruptRecord": malformed_text}
    return F.inline(F.array(F.from_json(as_column(value).cast("string"), schema, options)))


def is_object_text(value) -> Column:
    """True for text that starts a JSON object, after any JSON white space; never NULL."""
    text = F.ltrim(as_column(value).cast("string"), F.lit(" \t\r\n"))
    return F.coalesce(text.startswith("{"), F.lit(False))


def encode(*columns) -> Column:
    """Columns to one JSON object; NULL fields are written as null."""
    return F.to_json(F.struct(*columns), FAITHFUL)
