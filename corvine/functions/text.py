"""Text normalization as Column expressions; only NFKC, which Spark lacks, is an Arrow UDF, and it gets non-ASCII values alone."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Legal suffixes and what they stand for.
LEGAL_SUFFIXES = {
    "co": "company",
    "corp": "corporation",
    "inc": "incorporated",
    "llc": "limited liability company",
    "llp": "limited liability partnership",
    "ltd": "limited",
    "plc": "public limited company",
    "pty": "proprietary",
    "pvt": "private",
    "sarl": "societe a responsabilite limitee",
    "sas": "societe par actions simplifiee",
    "sasu": "societe par actions simplifiee unipersonnelle",
}
#: The white space of Unicode, as a character class.
WHITE = r"[\t-\r\x1c-\x20\x85\xa0  -     　]+"


@F.pandas_udf(T.StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.str.normalize("NFKC")


def nfkc(text: Column) -> Column:
    """NFKC. ASCII values don't change under it, so they reach the UDF as nulls and cost next to nothing."""
    other = F.when(F.octet_length(text) != F.length(text), text)
    return F.coalesce(_nfkc(other), text)


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITE, " "))


def expand_suffixes(text: Column) -> Column:
    """Known legal suffixes, as whole tokens, in full."""
    full = F.create_map(*[F.lit(x) for pair in LEGAL_SUFFIXES.items() for x in pair])
    return F.array_join(F.transform(F.split(text, " "), lambda t: F.coalesce(F.try_element_at(full, t), t)), " ")


def normalize_text(value: Column, canonicalize_suffixes: bool = True, compose: bool = True) -> Column:
    """NFKC, lower case, '&' as 'and', punctuation as spaces, white space collapsed, legal suffixes in full; null is ''."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    text = F.lower(nfkc(text) if compose else text)
    text = F.regexp_replace(F.replace(text, F.lit("&"), F.lit(" and ")), r"\p{P}", " ")
    text = collapse(text)
    return expand_suffixes(text) if canonicalize_suffixes else text


def normalize_name(value: Column) -> Column:
    return normalize_text(value)


def normalize_address(value: Column) -> Column:
    return normalize_text(value)


def normalize_frame(df: DataFrame) -> DataFrame:
    """Add normalized_name and normalized_address; the input columns stay as they are."""
    missing = sorted({"business_name", "business_address"} - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.withColumns({"normalized_name": normalize_name(F.col("business_name")), "normalized_address": normalize_address(F.col("business_address"))})
