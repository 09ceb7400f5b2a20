"""Text normalisation and HTML to text, as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters whose runs collapse to one space, and the ones
# stripped from both ends (U+0000 .. U+0020).
WHITESPACE = r"[ \t\x0B\f\r\n]"
STRIPPED = "".join(chr(c) for c in range(0x21))

# A run that is not a single space already: most runs are, and need no rewrite.
WHITESPACE_RUN = rf"[\t\x0B\f\r\n]{WHITESPACE}*| {WHITESPACE}+"

# Every character below U+0300 is unchanged by NFC and never combines with its
# predecessor, so only text with a character outside this range needs NFC.
MAY_CHANGE_UNDER_NFC = r"[^\x00-\u02FF]"

# Patterns replaced by a space when HTML becomes text, in order,
# and the entities decoded afterwards (the ampersand last).
HTML_PATTERNS = (
    r"(?is)<(script|style)[^>]*>.*?</(script|style)>",
    r"(?s)<!--.*?-->",
    r"<[^>]*>",
)
HTML_ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
)


def _nfc_batch(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def nfc(text: Column, engine: str = "jvm") -> Column:
    """Unicode NFC.

    ``jvm`` calls the ICU library Spark itself depends on, so text never leaves
    the JVM. ``arrow`` is for clusters that forbid ``reflect``: it sends only the
    texts that may change to Python and nulls for the rest.
    Both are non-deterministic to the optimizer, hence evaluated once and never
    duplicated into a pushed-down filter.
    """
    changes = text.rlike(MAY_CHANGE_UNDER_NFC)
    if engine == "jvm":
        composed = F.reflect(
            F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False)
        )
        return F.when(changes, composed).otherwise(text)
    if engine == "arrow":
        in_batches = F.pandas_udf(_nfc_batch, T.StringType()).asNondeterministic()
        composed = in_batches(F.when(changes, text))
        return F.coalesce(composed, text)
    raise ValueError(f"unknown NFC engine {engine!r}")


def normalize(text: Column, engine: str = "jvm") -> Column:
    """NFC, whitespace runs to one space, strip the ends, lower case."""
    collapsed = F.regexp_replace(nfc(text, engine), WHITESPACE_RUN, " ")
    return F.lower(F.btrim(collapsed, F.lit(STRIPPED)))


def html_to_text(html: Column) -> Column:
    """Markup, comments, scripts and styles removed, common entities decoded."""
    out = html
    for pattern in HTML_PATTERNS:
        out = F.regexp_replace(out, pattern, " ")
    for entity, char in HTML_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out
