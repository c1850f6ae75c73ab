"""Scalar cleaning and arithmetic. Everything stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# kWh per GWh and per TWh.
KWH_PER_GWH = 1e6
KWH_PER_TWH = 1e9

# Texts read as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_name(name: str) -> str:
    """snake_case header: trimmed, lower case, no quotes, parentheses or commas."""
    kept = name.strip().lower().replace(" ", "_")
    return "".join(ch for ch in kept if ch not in "'(),")


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_name(c) for c in df.columns])


def _string_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip white space (tabs and line ends too) from every text column; NULL stays NULL."""
    text = _string_columns(df)
    return df.select(
        *[F.regexp_replace(c, r"^\s+|\s+$", "").alias(c) if c in text else F.col(c) for c in df.columns]
    )


def nullify_tokens(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """Texts that mean "missing" become NULL."""
    text = _string_columns(df)
    return df.select(
        *[
            F.when(~F.col(c).isin(*tokens), F.col(c)).alias(c) if c in text else F.col(c)
            for c in df.columns
        ]
    )


#: Decimal numbers; a cast alone would also take type suffixes such as `12d`.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def try_number(c: Column | str) -> Column:
    """Text to DOUBLE; text that is not a decimal number becomes NULL."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def try_integer(c: Column | str) -> Column:
    """Text to BIGINT; `2015.0` is 2015, a fractional or unparsable text is NULL."""
    text = F.trim(_col(c))
    number = try_number(c)
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(text.try_cast("bigint"), whole)


def decimal_comma(c: Column | str) -> Column:
    """`160724,5,,` to 160724.5: trailing commas go, the comma left over is the decimal mark."""
    text = F.regexp_replace(F.trim(_col(c)), r",+$", "")
    return try_number(F.replace(text, F.lit(","), F.lit(".")))


def month_date(year: Column | str, month: Column | str) -> Column:
    """First day of the month as DATE; an impossible year or month is NULL, row by row."""
    one, zero = F.lit(1), F.lit(0)
    made = F.try_make_timestamp(
        _col(year).try_cast("int"), _col(month).try_cast("int"), one, zero, zero, zero
    )
    return made.cast("date")


def parse_date(c: Column | str, fmt: str = "d/M/yyyy") -> Column:
    """Text to DATE; days and months of one or two digits, anything else is NULL."""
    return F.try_to_date(F.trim(_col(c)), fmt)


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c).cast("date"), "MM")


def guarded_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """numerator / denominator where the denominator is positive, else NULL."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d > 0, F.try_divide(n.cast("double"), d.cast("double")))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Zero denominators give NULL."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def log10_positive(c: Column | str) -> Column:
    """log10 of positive values, NULL elsewhere."""
    x = _col(c)
    return F.when(x > 0, F.log10(x))


def signed_log(c: Column | str) -> Column:
    x = _col(c)
    return F.signum(x.cast("double")) * F.log1p(F.abs(x))


def to_gwh(c: Column | str) -> Column:
    return _col(c) / F.lit(KWH_PER_GWH)


def to_twh(c: Column | str) -> Column:
    return _col(c) / F.lit(KWH_PER_TWH)
