"""Reading raw user documents.

Leaves stay VARIANT because the flattening rules tell a missing key from a JSON
null and a number from its text, which plain struct fields do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def results(body: Column) -> Column:
    """The `results` list of a response body, NULL unless the body is a JSON object with one.

    The body is parsed as the value of a wrapping object, so text after the end of
    the document makes the whole parse fail instead of being skipped.
    """
    wrapped = F.concat(F.lit('{"document":'), body, F.lit("}"))
    schema = "document struct<results:array<variant>>"
    return F.from_json(wrapped, schema, {"allowSingleQuotes": "false"})["document"]["results"]


def _kind(leaf: Column) -> Column:
    return F.schema_of_variant(leaf)


def _text(leaf: Column) -> Column:
    """The cases of `plain` but the last, the usual ones first."""
    text, kind = leaf.cast("string"), _kind(leaf)
    return (
        F.when(kind.isin("STRING", "BIGINT"), text)
        .when(leaf.isNull(), F.lit(""))
        # Integers read as BIGINT up to 18 digits, so a shorter DECIMAL had a decimal point.
        .when(kind.rlike(r"^DECIMAL\((\d|1[0-8]),0\)$"), F.concat(text, F.lit(".0")))
    )


def plain(leaf: Column) -> Column:
    """The text of a leaf: empty when it is missing, NULL for a JSON null.

    A whole number written with a decimal point keeps one digit after it.
    """
    return _text(leaf).otherwise(leaf.cast("string"))


def spelled(number: Column) -> Column:
    """The text of a floating-point number: the shortest digits that give it back, and an exponent of
    two digits or more below 0.0001 and from 1e16 on; infinity is `inf`.

    One conversion finds the digits. It writes an exponent below 0.001 and from 1e7 on, where the point is
    moved or the exponent spelled anew; between them, where nearly all numbers lie, its text is the answer.
    Only from 1e16 on, where Java 17 writes digits that are not needed, are 15 to 17 digits tried.
    """
    text = number.cast("string")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    part = lambda text, mark, at: F.ltrim(F.substring_index(text, mark, at), F.lit("-"))
    power = F.substring_index(text, "E", -1).cast("int")
    digits = F.replace(part(text, "E", 1), F.lit("."), F.lit(""))
    after = F.rtrim(F.substring(digits, power + 2, F.lit(20)), F.lit("0"))
    tries = [F.format_string(f"%.{n}e", number) for n in (14, 15, 16)]
    large = F.coalesce(*[F.when(t.cast("double") == number, t) for t in tries[:2]], tries[2])
    bare = lambda mantissa: F.rtrim(F.rtrim(mantissa, F.lit("0")), F.lit("."))
    return (
        F.when(text.endswith("y"), F.concat(sign, F.lit("inf")))
        .when(~text.contains("E"), text)
        .when(power >= 16, F.concat(sign, bare(part(large, "e", 1)), F.lit("e"), F.substring_index(large, "e", -1)))
        .when(power < -4, F.concat(
            sign, bare(part(text, "E", 1)), F.lit("e-"), F.when(power > -10, F.lit("0")).otherwise(F.lit("")), F.abs(power).cast("string")
        ))
        .when(power < 0, F.concat(sign, F.lit("0.000"), F.rtrim(digits, F.lit("0"))))
        .otherwise(F.concat(
            sign, F.rpad(F.left(digits, power + 1), power + 1, "0"), F.lit("."),
            F.when(after == "", F.lit("0")).otherwise(after),
        ))
    )


def printed(leaf: Column) -> Column:
    """The text of a leaf as it prints inside a sentence.

    As `plain`, but a JSON null prints as `None`, booleans are capitalised, and a
    number with a point or an exponent is spelled as the floating-point number it is.
    """
    text, kind = leaf.cast("string"), _kind(leaf)
    # Integers read as BIGINT up to 18 digits and as DECIMAL without a fraction up to 38.
    floating = (kind == "DOUBLE") | kind.rlike(r"^DECIMAL\((\d+,[1-9]\d*|(\d|1[0-8]),0)\)$")
    return (
        F.when(kind.isin("STRING", "BIGINT"), text)
        .when(leaf.isNull(), F.lit(""))
        .when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(text))
        .when(floating, spelled(leaf.cast("double")))
        .otherwise(text)
    )
