"""Column expressions for turning text into tokens.

Everything here (but :func:`tokens`, which explodes them) is a ``Column`` built from ``pyspark.sql.functions``
only, so tokenization runs JVM-side inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Tokens are runs of ASCII letters and digits; everything else separates.
ALNUM_RUN = "[A-Za-z0-9]+"
NON_ALNUM = "[^A-Za-z0-9]"
# Whitespace as the reference's tokenizer understands it (Java regex \s).
WHITESPACE_RUN = r"\s+"
NON_SPACE_RUN = r"\S+"
# A line of a text value ends as a line of a text file does: at \r\n, \n or a lone \r.
LINE_SEPARATOR = "\r\n|\n|\r"
SEPARATED_LINE = f"(?:{LINE_SEPARATOR})([^\r\n]*)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_alnum(text: Column | str) -> Column:
    """Replace every character outside [A-Za-z0-9] by a space."""
    return F.regexp_replace(_col(text), NON_ALNUM, " ")


def whitespace_tokens(text: Column | str, keep_empty: bool = False) -> Column:
    """Split on whitespace runs.

    ``keep_empty=True`` reproduces the reference tokenizer's edge cases: an
    empty line gives ``[""]``, a line starting with whitespace gives a leading
    ``""``, a whitespace-only line gives ``[]`` and trailing whitespace adds
    nothing. ``keep_empty=False`` drops empty tokens altogether.
    """
    t = _col(text)
    words = F.regexp_extract_all(t, F.lit(NON_SPACE_RUN), 0)
    if keep_empty:
        leading = F.substring(t, 1, 1).rlike(WHITESPACE_RUN) & t.rlike(r"\S")
        return F.when((t == "") | leading, F.concat(F.array(F.lit("")), words)).otherwise(words)
    return words


def alnum_tokens(text: Column | str, lower: bool = False) -> Column:
    """Tokens of the cleaned text: maximal runs of ASCII letters and digits.

    Identical to cleaning non-alphanumerics to spaces and splitting on
    whitespace with empty tokens dropped, but done in one regex pass.
    """
    t = _col(text)
    toks = F.regexp_extract_all(t, F.lit(ALNUM_RUN), 0)
    return F.transform(toks, F.lower) if lower else toks


def tokenize(text: Column | str, clean: bool = True, lower: bool = False,
             keep_empty: bool = False) -> Column:
    """One entry point for every tokenization the jobs use.

    clean=True : alphanumeric runs (case kept unless ``lower``)
    clean=False: raw whitespace tokens, see :func:`whitespace_tokens`
    With ``clean and keep_empty`` the cleaned line is split like a raw one, so
    a line whose cleaned form starts with a space yields a leading ``""``.
    """
    if clean and not keep_empty:
        return alnum_tokens(text, lower=lower)
    base = clean_alnum(text) if clean else _col(text)
    toks = whitespace_tokens(base, keep_empty=keep_empty)
    return F.transform(toks, F.lower) if lower else toks


def tokens(lines: DataFrame, text_col: Column | str, clean: bool = True, lower: bool = False,
           keep_empty: bool = False, keep: tuple[str | Column, ...] = ()) -> DataFrame:
    """One row per token of :func:`tokenize`, column ``word``, beside the columns ``keep``.

    Lower-casing follows the explode, where it is compiled; inside the array it is interpreted token by token.
    """
    words = lines.select(*keep, F.explode(tokenize(text_col, clean=clean, keep_empty=keep_empty)).alias("word"))
    return words.withColumn("word", F.lower("word")) if lower else words


def first_letter(token: Column | str) -> Column:
    """Lower-cased first character; an empty token stays empty."""
    return F.lower(F.substring(_col(token), 1, 1))


def split_lines(text: Column | str) -> Column:
    """Array of lines of a text value (trailing empty line kept, like a file).

    With a separator before it the first line is found like all others, in one regex pass (``split`` takes
    several times as long).
    """
    return F.regexp_extract_all(F.concat(F.lit("\n"), _col(text)), F.lit(SEPARATED_LINE), 1)
