"""Response columns: content routing, charset, decoding."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from weblattice.runtime import ship_by_value

EXCERPT_CHARS = 1000
DEFAULT_CHARSET = "utf-8"


def is_html(content_type: Column) -> Column:
    """HTML iff ``text/html`` occurs in the content type; an empty or missing one is not."""
    return F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("text/html"))


def excerpt(body: Column) -> Column:
    return F.left(body, F.lit(EXCERPT_CHARS))


def charset(content_type: Column) -> Column:
    """Lower-cased charset parameter of a content type, else utf-8."""
    named = F.lower(F.regexp_extract(content_type, r"(?i);\s*charset\s*=\s*\"?([^\";\s]+)", 1))
    return F.when(F.coalesce(named, F.lit("")) == "", DEFAULT_CHARSET).otherwise(named)


def is_utf8(name: Column) -> Column:
    return name.isin("utf-8", "utf8")


def is_latin1(name: Column) -> Column:
    return name.isin("iso-8859-1", "iso8859-1", "latin-1", "latin1")


def is_ascii(name: Column) -> Column:
    return name.isin("us-ascii", "ascii")


DECODED_TYPE = T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])

ship_by_value(__name__)


@arrow_udf(DECODED_TYPE)
def _decode_other(body: pa.Array, name: pa.Array) -> pa.Array:
    """Decode the charsets the JVM expression set lacks; rows with a null body pass through."""
    texts, errors = [], []
    for raw, label in zip(body.to_pylist(), name.to_pylist()):
        text = error = None
        if raw is not None:
            try:
                text = bytes(raw).decode(label, "replace")
                # Lone surrogates (utf-7, utf-16 variants) cannot travel in an Arrow string.
                text = text.encode("utf-8", "replace").decode("utf-8")
            except Exception as failure:  # an unknown name, a codec that is not a text encoding, or one that does not take "replace"
                text, error = "", str(failure) or type(failure).__name__
        texts.append(text)
        errors.append(error)
    columns = [pa.array(texts, pa.string()), pa.array(errors, pa.string())]
    return pa.StructArray.from_arrays(columns, names=["text", "error"])


def decode_body(body: Column, content_type: Column) -> Column:
    """``struct<text, error>`` of a binary body: bad bytes become U+FFFD, an unknown charset an error.

    utf-8 and Latin-1 stay on the JVM, and so does US-ASCII without bytes above 127; only other bodies are sent to Python. A
    body that cannot be decoded is an error of its row.
    """
    name = charset(content_type)
    ascii_only = is_ascii(name) & (F.octet_length(body) == F.length(F.make_valid_utf8(body.cast("string"))))
    here = is_utf8(name) | is_latin1(name) | ascii_only
    other = _decode_other(F.when(~here, body), name)
    return F.struct(
        F.when(is_utf8(name) | ascii_only, F.make_valid_utf8(body.cast("string")))
        .when(is_latin1(name), F.decode(body, "ISO-8859-1")).otherwise(other["text"]).alias("text"),
        F.when(~here, other["error"]).alias("error"),
    )
