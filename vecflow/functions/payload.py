"""Payload objects: JSON-like fields as ``map<string,variant>`` until packed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecflow.functions.ids import binary_key_text
from vecflow.schema import FIELDS

# Number spellings taken as numbers; Spark's own cast is laxer
# (it trims blanks and reads a trailing "d"). An underscore may separate digits.
_DIGITS = "[0-9](?:_?[0-9])*"
_HEX = "[0-9a-fA-F](?:_?[0-9a-fA-F])*"
DECIMAL_NUMBER = (
    rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\z"
)
HEX_NUMBER = rf"^[+-]?0[xX]_?(?:{_HEX}(?:\.(?:{_HEX})?)?|\.{_HEX})[pP][+-]?{_DIGITS}\z"
SPECIAL_NUMBER = r"^(?:[nN][aA][nN]|[+-]?[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)\z"
SHORT_INTEGER = r"^[+-]?[0-9]{1,18}\z"
LONG_INTEGER = r"^[+-]?0*[0-9]{1,38}\z"
INT64_BOUNDS = ("-9223372036854775808", "9223372036854775807")
RFC3339_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"


def rfc3339(ts: Column, data_type: T.DataType | None = None) -> Column:
    """Second-precision timestamp text with zone offset; zoneless time counts as UTC."""
    if isinstance(data_type, T.TimestampNTZType):
        return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return F.date_format(ts, RFC3339_FORMAT)


def sanitize(column: Column, data_type: T.DataType) -> Column:
    """Rewrite a typed column so that every leaf is a payload-safe value.

    Types follow the schema, so the recursion runs once on the driver and leaves
    plain expressions. Decimals become plain decimal text, other unknown types
    their text form.
    """
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return rfc3339(column, data_type)
    if isinstance(data_type, T.DateType):
        return F.concat(F.date_format(column, "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    if isinstance(data_type, T.BinaryType):
        return binary_key_text(column)
    if isinstance(
        data_type,
        (T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.StringType, T.VariantType),
    ):
        return column
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda x: sanitize(x, data_type.elementType))
    if isinstance(data_type, T.MapType) and isinstance(data_type.keyType, T.StringType):
        return F.transform_values(column, lambda _, v: sanitize(v, data_type.valueType))
    if isinstance(data_type, T.StructType):
        fields = [sanitize(column[f.name], f.dataType).alias(f.name) for f in data_type]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.NullType):
        return column.cast("string")
    return column.cast("string")


def to_variant(column: Column, data_type: T.DataType) -> Column:
    """Any sanitised column as a variant."""
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_variant_object(column)
    return column.cast("variant")


def pack_columns(columns: dict[str, Column]) -> Column:
    """Payload object with exactly these fields; a null column becomes JSON null."""
    if not columns:
        return F.parse_json(F.lit("{}"))
    return F.to_variant_object(F.struct(*[c.alias(name) for name, c in columns.items()]))


def object_fields(payload: Column) -> Column:
    return F.variant_get(payload, "$", FIELDS)


def pack_fields(fields: Column) -> Column:
    return F.to_variant_object(fields)


def empty_fields() -> Column:
    return F.create_map().cast(FIELDS)


def drop_fields(fields: Column, *names: str) -> Column:
    return F.map_filter(fields, lambda k, _: ~k.isin(*names))


def put_field(fields: Column, name: str, value: Column, condition: Column | None = None) -> Column:
    """Set one field, replacing any field of that name, where ``condition`` holds."""
    written = F.map_concat(
        drop_fields(fields, name), F.create_map(F.lit(name), value.cast("variant"))
    )
    return written if condition is None else F.when(condition, written).otherwise(fields)


def with_id_field(fields: Column, name: str, original_id: Column, document_wins: bool) -> Column:
    """Keep the source's own id in the payload; on a clash one side gives way."""
    if document_wins:
        return put_field(fields, name, original_id, ~F.map_contains_key(fields, name))
    return put_field(fields, name, original_id)


def with_document(fields: Column, name: str, text: Column) -> Column:
    """Attach the document text unless it is missing or empty."""
    return put_field(fields, name, text, F.coalesce(text != "", F.lit(False)))


def parse_json_object(text: Column, strict: bool = True) -> Column:
    """JSON object text to a payload. Anything else stops the job, or is null if not strict."""
    parsed = F.parse_json(text) if strict else F.try_parse_json(text)
    # What parses and opens with a brace is an object.
    is_object = text.rlike(r"^[ \t\r\n]*\{")
    otherwise = F.lit(None).cast("variant")
    if strict:
        otherwise = F.when(
            text.isNotNull(), F.raise_error(F.concat(F.lit("not a JSON object: "), text))
        ).cast("variant")
    return F.when(is_object, parsed).otherwise(otherwise)


def as_number(text: Column) -> Column:
    """Text as a double when it spells a number in full, else null."""
    plain = F.replace(text, F.lit("_"), F.lit(""))
    spelled = text.rlike(DECIMAL_NUMBER) | text.rlike(HEX_NUMBER)
    value = F.when(spelled, plain.try_cast("double"))
    in_range = F.when(F.abs(value) < F.lit(float("inf")), value)
    return F.coalesce(in_range, F.when(text.rlike(SPECIAL_NUMBER), text.try_cast("double")))


def parse_field(attribute_type: Column, text: Column) -> Column:
    """NUMERIC text as a double, unreadable NUMERIC and everything else as text."""
    number = F.when(attribute_type == "NUMERIC", as_number(text))
    return F.when(text.isNotNull(), F.coalesce(number.cast("variant"), text.cast("variant")))


def narrow_number(text: Column) -> Column:
    """Number text as int64 if it fits, else double, else the text itself."""
    # Up to 18 digits always fit. Longer text is compared as a decimal, since a
    # cast that fails costs an exception per row.
    wide = F.when(text.rlike(LONG_INTEGER), text.try_cast("decimal(38,0)"))
    low, high = [F.lit(bound).cast("decimal(38,0)") for bound in INT64_BOUNDS]
    integer = F.when(text.rlike(SHORT_INTEGER), text.cast("bigint")).when(
        wide.between(low, high), wide.cast("bigint")
    )
    return F.coalesce(
        integer.cast("variant"), as_number(text).cast("variant"), text.cast("variant")
    )


def narrow_numbers(column: Column, data_type: T.DataType) -> Column:
    """``narrow_number`` on every text leaf of a nested column; a variant is returned."""
    if isinstance(data_type, T.StringType):
        return narrow_number(column)
    if isinstance(data_type, T.ArrayType):
        return F.to_variant_object(
            F.transform(column, lambda x: narrow_numbers(x, data_type.elementType))
        )
    if isinstance(data_type, T.MapType):
        return F.to_variant_object(
            F.transform_values(column, lambda _, v: narrow_numbers(v, data_type.valueType))
        )
    if isinstance(data_type, T.StructType):
        fields = [narrow_numbers(column[f.name], f.dataType).alias(f.name) for f in data_type]
        return F.when(column.isNotNull(), F.to_variant_object(F.struct(*fields)))
    return to_variant(sanitize(column, data_type), data_type)
