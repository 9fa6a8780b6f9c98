"""Point ids: what makes one, how two compare, how one is shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.schema import ID

# The RFC 4122 URL namespace, and the spellings accepted as a UUID
# (plain, urn:uuid: prefixed, wrapped in one character each side, 32 hex digits).
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
_DASHED = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
UUID_PATTERN = (
    f"^(?:{_DASHED}"
    f"|[uU][rR][nN]:[uU][uU][iI][dD]:{_DASHED}"
    rf"|[\x00-\x7F]{_DASHED}[\x00-\x7F]"
    r"|[0-9a-fA-F]{32})\z"
)


def is_uuid(text: Column) -> Column:
    return text.rlike(UUID_PATTERN)


def uuid5(name: Column) -> Column:
    """UUID v5 of the UTF-8 bytes of ``name`` in the URL namespace, all JVM-side."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def arbitrary_id_to_uuid(text: Column) -> Column:
    """A UUID spelling is kept verbatim, any other text is hashed to a UUID.

    Both candidates sit in an array instead of CASE branches: Spark then computes
    the shared digest once per row, where inside a branch it would repeat it for
    every substring.
    """
    return F.get(F.array(uuid5(text), text), is_uuid(text).cast("int"))


def uuid_id(uuid: Column) -> Column:
    """Id that is already a UUID string (native ids are not rehashed)."""
    return F.struct(F.lit(None).cast("decimal(20,0)").alias("num"), uuid.alias("uuid")).cast(ID)


def text_id(text: Column) -> Column:
    return uuid_id(arbitrary_id_to_uuid(text))


def numeric_id(number: Column) -> Column:
    """Unsigned 64-bit id; a negative or larger number stops the job."""
    wide = number.cast("decimal(38,0)")
    checked = F.when(
        (wide < 0) | (wide > F.lit("18446744073709551615").cast("decimal(38,0)")),
        F.raise_error(F.concat(F.lit("not an unsigned 64-bit id: "), wide.cast("string"))),
    ).otherwise(wide)
    return F.struct(
        checked.cast("decimal(20,0)").alias("num"), F.lit(None).cast("string").alias("uuid")
    ).cast(ID)


def binary_key_text(key: Column) -> Column:
    """Sixteen raw bytes read as a UUID, any other byte string as its text."""
    h = F.lower(F.hex(key))
    dashed = F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(F.octet_length(key) == 16, dashed).otherwise(F.decode(key, "UTF-8"))


def key_to_string(key: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.BinaryType):
        return binary_key_text(key)
    return key.cast("string")


def id_sort_columns(id_column: str = "id") -> list[Column]:
    """Total order of ids: missing first, then numbers by value, then UUIDs as text."""
    return [
        F.col(id_column).isNotNull().asc(),
        F.coalesce(F.col(id_column)["uuid"], F.lit("")).asc(),
        F.col(id_column)["num"].asc(),
    ]


def id_sort_key(point_id: Column) -> Column:
    """Text that sorts as the ids do, so that key ranges can be planned over ids."""
    number = F.concat(F.lit("0"), F.lpad(point_id["num"].cast("string"), 20, "0"))
    return F.coalesce(F.concat(F.lit("1"), point_id["uuid"]), number)


def id_text(point_id: Column) -> Column:
    return F.coalesce(point_id["uuid"], point_id["num"].cast("string"))
