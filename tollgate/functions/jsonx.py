"""Strict JSON over VARIANT, with the document parsed once per row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.session import configure

# How ``schema_of_variant`` begins the names of the number types: BIGINT, DECIMAL, DOUBLE.
NUMBER_PREFIXES = ("BIG", "DEC", "DOU")

ONE_BYTE_CHARS = r"\A[\x00-\xFF]*\z"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def once(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Add columns whose expressions run exactly once per row.

    A filter on a projected column is pushed below the projection and its expression is then
    evaluated twice, which for a JSON parse doubles the cost of the job. Filters on generator
    output stay above the generator, so the columns are produced by a one-element ``explode``:
    no shuffle, and it stays inside whole-stage code generation.
    """
    packed = F.struct(*[_column(e).alias(name) for name, e in columns.items()])
    return df.select("*", F.explode(F.array(packed)).alias("_once")).select("*", "_once.*").drop("_once")


def _column(expression: Column | str) -> Column:
    return F.expr(expression) if isinstance(expression, str) else expression


def decode_utf8(data: Column) -> Column:
    """The text of a payload, or NULL if the bytes are not UTF-8."""
    return F.try_validate_utf8(data.cast("string"))


# Key of the object that closes a guarded document; not a legal Avro field name.
_GUARD = "$digest"


def with_document(df: DataFrame, shape: str, text: str = "_text") -> DataFrame:
    """Add ``_is_json`` and ``_cells``: is the text exactly one JSON value, and that value.

    Spark's JSON readers stop after the first value and ignore what follows. The text is
    therefore parsed as the first element of a two-element array whose second element holds
    the text's own digest: that digest can only close the array if the text is a single value.

    ``_cells`` has the type ``shape``, a struct or map of variants, and is NULL for a document
    that is not an object. A member is SQL NULL if its key is absent and a variant null if the
    key holds ``null``.
    """
    configure(df.sparkSession)
    guarded = f"""concat('[', {text}, ',{{"{_GUARD}":"', _digest, '"}}]')"""
    df = once(
        df.selectExpr("*", f"md5({text}) AS _digest"),
        _array=f"try_cast(try_parse_json({guarded}) AS array<{shape}>)",
    )
    closing = f"try_cast(get(_array, 1)[r'{_GUARD}'] AS string)"
    return df.selectExpr(
        "*",
        f"coalesce(size(_array) = 2 AND {closing} = _digest, false) AS _is_json",
        "get(_array, 0) AS _cells",
    ).drop("_array", "_digest")


def with_cells(df: DataFrame, names: Iterable[str], text: str = "_text") -> DataFrame:
    """``with_document`` for the named members of an object."""
    members = "".join(f"{quoted(name)}: variant, " for name in names)
    return with_document(df, f"struct<{members}{quoted(_GUARD)}: variant>", text)


def with_members(df: DataFrame, text: str = "_text") -> DataFrame:
    """``with_document`` for all members of an object, as a map."""
    return with_document(df, "map<string, variant>", text)


def chunks(items: list, size: int = 6) -> list[list]:
    """Runs of at most ``size`` items.

    The expressions between two ``once`` columns are compiled into one method, and the JVM never
    optimises a method over 8,000 bytes. Per-field expressions are therefore added in runs.
    """
    return [items[i : i + size] for i in range(0, len(items), size)]


def cell(name: str) -> str:
    """SQL text of a member of ``_cells``, a variant.

    The expressions over members are SQL text: a schema has many fields, and every operation on
    a Column object is a round trip to the JVM.
    """
    return f"_cells.{quoted(name)}"


def kind(value: str) -> str:
    """The variant's own type; reading a variant *as* a type would convert silently."""
    return f"schema_of_variant({value})"


def is_null(value: str) -> str:
    """True for an absent key and for an explicit null."""
    return f"({value} IS NULL OR is_variant_null({value}))"


def is_number(value: str) -> str:
    return f"substring({kind(value)}, 1, 3) IN {NUMBER_PREFIXES}"


def mismatch(value: str, base: str) -> str:
    """True if a value is present, not null, and not of the base type; never converts.

    An absent key has no kind, so the comparison is NULL, which no check takes for true.
    """
    prefix = f"substring({kind(value)}, 1, 3)"
    if base == "double":
        return f"{prefix} NOT IN {(*NUMBER_PREFIXES, 'VOI')}"
    if base == "moment":
        return f"{prefix} NOT IN {(*NUMBER_PREFIXES, 'STR', 'VOI')}"
    expected = {"string": "STRING", "bytes": "STRING", "long": "BIGINT", "int": "BIGINT", "boolean": "BOOLEAN"}
    wrong = f"{kind(value)} NOT IN ('{expected[base]}', 'VOID')"
    if base == "int":
        return f"({wrong} OR try_cast({value} AS bigint) NOT BETWEEN {-(2**31)} AND {2**31 - 1})"
    if base == "bytes":
        # One byte per character, so only the first 256 code points can occur.
        return f"({wrong} OR NOT rlike(try_cast({value} AS string), r'{ONE_BYTE_CHARS}'))"
    return wrong


def is_falsy(value: str) -> str:
    """Absent, null, empty text, zero, false, empty array or empty object."""
    return f"""(CASE WHEN {is_null(value)} THEN true
      WHEN {kind(value)} = 'STRING' THEN try_cast({value} AS string) = ''
      WHEN {is_number(value)} THEN try_cast({value} AS double) = 0
      WHEN {kind(value)} = 'BOOLEAN' THEN NOT try_cast({value} AS boolean)
      WHEN {kind(value)} LIKE 'ARRAY%' THEN try_variant_get({value}, '$[0]', 'variant') IS NULL
      ELSE {kind(value)} = 'OBJECT<>' END)"""
