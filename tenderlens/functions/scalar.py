"""Scalar helpers: R-compatible arithmetic, text clean-up, parsing, flags and bands."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INF = float("inf")


# ---------------------------------------------------------------- arithmetic


def r_div(num: Column, den: Column) -> Column:
    """Division that keeps x/0 as signed infinity and turns 0/0 into NULL."""
    num, den = num.cast("double"), den.cast("double")
    return (
        F.when(den != 0, F.try_divide(num, den))
        .when((den == 0) & (num > 0), F.lit(INF))
        .when((den == 0) & (num < 0), F.lit(-INF))
    )


def pct(num: Column, den: Column) -> Column:
    return r_div(num, den) * 100


def round_even(c: Column, digits: int) -> Column:
    """Round half to even."""
    return F.bround(c, digits)


def row_mean(cols: Sequence[Column]) -> Column:
    """Mean across columns of one row; NULL when any of them is NULL."""
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total / F.lit(float(len(cols)))


def is_multiple_of(c: Column, unit: float) -> Column:
    return (c % F.lit(float(unit)) == 0) & (c > 0)


def log10_positive(c: Column) -> Column:
    """log10 of positive values, NULL otherwise."""
    return F.when(c > 0, F.log10(c))


# ---------------------------------------------------------------- predicates


def in_set(c: Column, values: Iterable) -> Column:
    """Membership test that is FALSE, not NULL, for NULL input."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def flag(cond: Column) -> Column:
    """1/0 flag; NULL stays NULL."""
    return F.when(cond, 1).when(~cond, 0)


def band(c: Column, cuts: Sequence[float], labels: Sequence[str], closed: str = "left") -> Column:
    """Label by increasing thresholds; the last label takes the rest, NULL included.

    ``closed='left'`` means a value equal to a cut falls in the upper band.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cuts")
    out = None
    for cut, label in zip(cuts, labels):
        cut = cut if isinstance(cut, Column) else F.lit(float(cut))
        test = c < cut if closed == "left" else c <= cut
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def recode_regex(c: Column, rules: Sequence[tuple[str, object]]) -> Column:
    """First matching pattern wins; no match gives NULL."""
    out = None
    for pattern, code in rules:
        out = F.when(c.rlike(pattern), F.lit(code)) if out is None else out.when(c.rlike(pattern), F.lit(code))
    return out


# ---------------------------------------------------------------- text


def remove_all(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


def remove_first(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, f"(?s)^(.*?)(?:{pattern})", "$1")


def nth_part(c: Column, sep: str, n: int) -> Column:
    """n-th piece (from 1) of a delimited string, '' when there are fewer pieces."""
    return F.split_part(c, F.lit(sep), F.lit(n))


def cut_before_note(c: Column) -> Column:
    """Text before the first '/', '|' or '('."""
    return F.substring_index(F.translate(c, "|(", "//"), "/", 1)


def split_place(c: Column, sep: str = " - ") -> tuple[Column, Column]:
    """'Department - Place' to (department, place); no separator gives (NULL, text)."""
    at = F.instr(c, sep)
    dept = F.when(at > 0, F.substring(c, F.lit(1), at - 1))
    place = F.when(at > 0, F.substring(c, at + len(sep), F.length(c))).otherwise(c)
    return dept, place


def digits_only(c: Column) -> Column:
    return remove_all(c, "[^0-9]")


def letters_only(c: Column) -> Column:
    return remove_all(c, r"[^\p{IsAlphabetic}]")


def _accent_pairs() -> tuple[str, str]:
    """Accented Latin letters and their base letter, derived from Unicode decomposition."""
    src, dst = [], []
    for code in range(0x00C0, 0x0250):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            src.append(chr(code))
            dst.append(base)
    return "".join(src), "".join(dst)


_ACCENTED, _PLAIN = _accent_pairs()


def fold_accents(c: Column) -> Column:
    plain = F.regexp_replace(F.translate(c, _ACCENTED, _PLAIN), r"\p{M}", "")
    return F.replace(plain, F.lit("ß"), F.lit("ss"))


def name_key(c: Column) -> Column:
    """Comparison key of a name: no accents, upper case."""
    return F.upper(fold_accents(c))


def place_key(c: Column) -> Column:
    """Comparison key of a place: no accents, punctuation or space, upper case."""
    return F.upper(remove_all(fold_accents(c), r"[\p{P}\p{IsWhite_Space}]"))


def paste(sep: str, *cols: Column) -> Column:
    """Concatenate; a missing piece reads 'NA'."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def truncate_label(c: Column, width: int) -> Column:
    return F.when(F.length(c) > width, F.concat(F.left(c, F.lit(width - 3)), F.lit("..."))).otherwise(c)


def fixed2(c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string("%.2f", c))


def prefix_by(c: Column, selector: Column, prefixes: Mapping[str, str]) -> Column:
    """Prefix a value according to the category in ``selector``."""
    out = None
    for category, prefix in prefixes.items():
        test = selector == category
        value = F.concat(F.lit(prefix), c)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(c)


# ---------------------------------------------------------------- parsing


def to_double(c: Column) -> Column:
    """Text to double; what is not a plain decimal number (as ``12D`` or ``Infinity``) is NULL."""
    text = F.trim(c)
    return F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))


def parse_locale_number(c: Column) -> Column:
    """'1.234,5' to 1234.5."""
    plain = remove_all(c, r"\.")
    return to_double(F.regexp_replace(plain, r"^([^,]*),", "$1."))


def scale_units(value: Column, unit: Column, factors: Mapping[str, float]) -> Column:
    """Multiply by the factor of the unit; a NULL unit gives NULL."""
    out = None
    for name, factor in factors.items():
        scaled = value * F.lit(float(factor))
        out = F.when(unit == name, scaled) if out is None else out.when(unit == name, scaled)
    return out.when(unit.isNotNull(), value)


def parse_ymd(c: Column) -> Column:
    """Year-month-day text with '-', '/' or no separator to date; bad text is NULL."""
    compact = F.regexp_replace(c, r"[-/. ]", "")
    return F.when(
        F.length(compact) == 8,
        F.try_to_date(compact, "yyyyMMdd"),
    ).otherwise(F.try_to_date(F.regexp_replace(c, r"[/. ]", "-"), "y-M-d"))


def term_days(term: Column, unit: Column, month_unit: str = "M", month_limit: int = 120) -> Column:
    """Contract term in days: months below the limit count 30 days each."""
    return F.when(unit == month_unit, F.when(term < month_limit, term * 30).otherwise(term)).when(
        unit.isNotNull(), term
    )


def extension_days(days: Column, months: Column) -> Column:
    return days + months * 30


# ---------------------------------------------------------------- whole-frame helpers


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = ("int", "bigint", "smallint", "tinyint", "double", "float")
    return [n for n, t in df.dtypes if t in kinds or t.startswith("decimal")]


def fill_non_finite(df: DataFrame, value: float = 0, cols: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL, NaN and +infinity; -infinity stays."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    types = dict(df.dtypes)
    out = {}
    for name in cols:
        c = F.col(name)
        if types[name] in ("double", "float"):
            bad = c.isNull() | F.isnan(c) | (c == F.lit(INF))
        else:
            bad = c.isNull()
        out[name] = F.when(bad, F.lit(value).cast(types[name])).otherwise(c)
    return df.withColumns(out)


def across(df: DataFrame, cols: Sequence[str], fn) -> DataFrame:
    """Apply one column function to many columns."""
    return df.withColumns({name: fn(F.col(name)) for name in cols})


def select_matching(df: DataFrame, regex: str, *keep: str) -> DataFrame:
    """Keep ``keep`` and every column whose name contains the pattern."""
    import re

    hits = [n for n in df.columns if re.search(regex, n) and n not in keep]
    return df.select(*keep, *hits)


def normalize_na(df: DataFrame, tokens: Sequence[str] = ("", "NA")) -> DataFrame:
    """Turn NA tokens of text columns into NULL."""
    text = [n for n, t in df.dtypes if t == "string"]
    return across(df, text, lambda c: F.when(~c.isin(list(tokens)), c))
