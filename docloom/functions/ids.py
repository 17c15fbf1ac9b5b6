"""Deterministic identities: documents, chunks and vector points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom import constants as K
from docloom.functions.text import col


def uuid5(name, namespace: str = K.DOCUMENT_NAMESPACE) -> Column:
    """RFC 4122 version 5 UUID of a string column, from the built-in SHA-1."""
    raw = F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(col(name), "UTF-8"))
    h = F.sha1(raw)
    variant = F.element_at(
        F.split(F.lit("8 9 a b"), " "),
        (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1,
    )
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def document_id(url) -> Column:
    return uuid5(url)


def hash8(url) -> Column:
    return F.substring(document_id(url), 1, 8)


def content_sha256(text) -> Column:
    return F.sha2(col(text), 256)


def content_sha1(text) -> Column:
    return F.sha1(col(text))


def chunk_id(document, chunk_no) -> Column:
    return F.concat(col(document), F.lit(":"), col(chunk_no).cast("string"))


_UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def point_id(chunk, document, chunk_no, line_no) -> Column:
    """Point identity: UUIDs lower-cased, digit strings kept, all else hashed."""
    c = col(chunk).cast("string")
    derived = uuid5(
        F.concat(
            F.lit("chunk:"),
            F.coalesce(col(document).cast("string"), F.lit("-")),
            F.lit(":"),
            F.coalesce(col(chunk_no).cast("string"), col(line_no).cast("string")),
        )
    )
    digits = F.regexp_replace(c, "^0+(?=[0-9])", "")
    return (
        F.when(c.rlike(_UUID), F.lower(c)).when(c.rlike("^[0-9]+$"), digits).otherwise(derived)
    )


def point_id_is_int(point) -> Column:
    return col(point).rlike("^[0-9]+$")
