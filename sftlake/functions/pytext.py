"""The text Python's ``str`` gives for a JSON value, as JVM-side Column functions.

Objects are parsed once, into variants, which tell a missing key from an explicit null and keep
the type of every value. Only a value that is neither a string, a boolean nor null is looked up a
second time, for its own digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftlake.functions.text import _col


def typed_fields(line, names: list[str]) -> Column:
    """A struct of one variant a field, from the text of a JSON object. A missing key is null, an
    explicit null a variant null; a malformed line fails the query."""
    return F.from_json(_col(line), ", ".join(f"`{n}` variant" for n in names), {"mode": "FAILFAST"})


def is_present(value) -> Column:
    """True where the key was in the object, with a null value too."""
    return _col(value).isNotNull()


def python_text(value, line, name: str) -> Column:
    """``str(value)`` of field ``name`` of the object ``line``, whose variant is ``value``; null
    for a null or a missing key. Integers of any size keep their digits. An object or array is
    given as its JSON text, not as Python would write it."""
    v = _col(value)
    kind = F.schema_of_variant(v)
    own = F.from_json(_col(line), "map<string,string>")[name]
    boolean = F.when(F.try_variant_get(v, "$", "boolean"), F.lit("True")).otherwise(F.lit("False"))
    return (
        F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("string"))
        .when(kind == "STRING", F.try_variant_get(v, "$", "string"))
        .when(kind == "BOOLEAN", boolean)
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), own)
        .when(own.rlike("^-?[0-9]+$"), F.when(own == "-0", F.lit("0")).otherwise(own))
        .otherwise(python_float(F.replace(own, F.lit('"'), F.lit("")).cast("double")))  # out of range: "Infinity"
    )


def python_float(x) -> Column:
    """``str`` of a double: the fewest digits that give it back, positional for exponents of ten
    from -4 to 15, else with an exponent of two digits or more.

    Numbers of up to 15 digits are exactly Python's text. Of longer ones Java before 19 doesn't
    always name the nearest of the shortest texts, so the last digit may be a neighbour of
    Python's, or one digit more be given; the text still gives the same double. (Below 2.3e-308 there may be more digits
    than needed.)"""
    # One-element arrays bind a value once, so that no text is built twice.
    def bind(value: Column, body) -> Column:
        return F.transform(F.array(value), body)[0]

    def written(c: Column) -> Column:
        exact = c.cast("string")
        for digits in (16, 15, 14):  # after the point; the fewest come last and win
            shorter = F.format_string(f"%.{digits}e", c)
            exact = F.when(shorter.cast("double") == c, shorter).otherwise(exact)
        return F.upper(exact)

    def parts(text: Column) -> Column:
        mantissa = F.ltrim(F.regexp_extract(text, "^-?([^E]*)", 1))
        whole = F.regexp_extract(mantissa, r"^([0-9]*)", 1)
        power = F.coalesce(F.nullif(F.regexp_extract(text, r"E\+?(-?[0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
        digits = F.replace(mantissa, F.lit("."), F.lit(""))
        lead = F.length(digits) - F.length(F.ltrim(digits, F.lit("0")))
        return F.struct(
            F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")).alias("sign"),
            F.btrim(digits, F.lit("0")).alias("d"),
            (F.length(whole) + power - lead).alias("point"),  # the value is 0.d times ten to this
        )

    def layout(p: Column) -> Column:
        d, point, n = p["d"], p["point"], F.length(p["d"])
        power = point - 1
        two = F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit(""))
        tail = F.when(n > 1, F.concat(F.lit("."), F.substring(d, F.lit(2), n))).otherwise(F.lit(""))
        scientific = F.concat(
            F.substring(d, 1, 1), tail, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), two, F.abs(power).cast("string")
        )
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), d)
        large = F.concat(d, F.repeat(F.lit("0"), point - n), F.lit(".0"))
        inside = F.concat(F.substring(d, F.lit(1), point), F.lit("."), F.substring(d, point + 1, n))
        body = (
            F.when(d == "", F.lit("0.0"))
            .when((power < -4) | (power >= 16), scientific)
            .when(point <= 0, small)
            .when(n <= point, large)
            .otherwise(inside)
        )
        return F.concat(p["sign"], body)

    c = _col(x)
    special = F.when(F.isnan(c), F.lit("nan")).when(c == float("inf"), F.lit("inf")).when(c == float("-inf"), F.lit("-inf"))
    finite = bind(written(c), lambda text: bind(parts(text), layout))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(special, finite))
