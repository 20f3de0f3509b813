"""Text expressions: normalisation, safe casts, feature names, number formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A cased letter starts or continues a word, anything else ends it.
NOT_CASED = r"([^\p{Lu}\p{Ll}\p{Lt} ])"

# The characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A Unicode noncharacter, which no text holds.
MARK = "\uffff"

# Texts that the CSV loader reads as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Labels of the model quality by R².
QUALITY_LEVELS = ((0.8, "excelente"), (0.6, "buena"))
QUALITY_REST = "moderada"


def strip(text: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def title_case(text: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    ``initcap`` starts words only after a blank, so ``o'higgins`` would give ``O'higgins``. A
    marked blank behind every other non-letter makes it start one there too.
    """
    split = F.regexp_replace(text, NOT_CASED, f"$1{MARK} ")
    return F.replace(F.initcap(split), F.lit(f"{MARK} "), F.lit(""))


def normalise_text(text: Column, null_text: str | None = "Nan") -> Column:
    """Strip and title-case; a missing text becomes ``null_text`` (``None`` keeps it missing)."""
    cleaned = title_case(strip(text.cast("string")))
    return cleaned if null_text is None else F.coalesce(cleaned, F.lit(null_text))


def missing_to_null(text: Column, missing=MISSING_TEXTS) -> Column:
    return F.when(~text.isin(*missing), text)


def safe_cast(column: Column, kind: str, default=None) -> Column:
    """Cast that gives ``default`` for a missing value, NaN included, or a failed cast; doubles are cut to int."""
    is_nan = F.typeof(column).isin("float", "double") & F.isnan(column.cast("string").try_cast("double"))
    out = F.when(~is_nan | column.isNull(), column).try_cast(kind)
    return out if default is None else F.coalesce(out, F.lit(default))


def row_json(df: DataFrame) -> Column:
    """The whole row as JSON text, with missing values kept as ``null``."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def clean_feature_name(name: Column) -> Column:
    """Text after the last double underscore."""
    return F.element_at(F.split(name, "__"), -1)


def feature_group(name: Column) -> Column:
    """Text before the first underscore of the cleaned name."""
    return F.element_at(F.split(clean_feature_name(name), "_"), 1)


def quality_label(r2: Column) -> Column:
    label = F.lit(QUALITY_REST)
    for bound, text in reversed(QUALITY_LEVELS):
        label = F.when(r2 > bound, F.lit(text)).otherwise(label)
    return label


def grouped(number: Column, decimals: int) -> Column:
    """``1234.5`` with 2 decimals gives ``1,234.50``; exact ties go to the even digit."""
    return F.format_number(number, decimals)


def fixed(number: Column, decimals: int) -> Column:
    """``1234.5`` with 4 decimals gives ``1234.5000``; exact ties go to the even digit."""
    return F.replace(grouped(number, decimals), F.lit(","), F.lit(""))


def model_slug(name: str) -> str:
    return name.lower().replace(" ", "_")


def model_title(slug: str) -> str:
    return slug.replace("_pipeline", "").replace("_", " ").title()
