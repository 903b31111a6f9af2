"""Text helpers: stable ids, markup stripping, topic patterns."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def stable_id(text: Column) -> Column:
    """The first sixteen hex digits of SHA-256."""
    return F.left(F.sha2(text.cast("binary"), 256), F.lit(16))


#: Entities as they stand in well-formed pages, in the order of their replacement.
COMMON = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def unescape_common(text: Column, entities=COMMON) -> Column:
    """Only the ``entities``, one after the other; one without its semicolon stays as it is."""
    for a, b in entities:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


@F.pandas_udf(StringType())
def unescape_all(text: pd.Series) -> pd.Series:
    """Every HTML entity, by Arrow batches."""
    import html

    return text.map(lambda t: None if t is None else html.unescape(t))


def strip_markup(text: Column, every_entity: bool = False, entities=COMMON) -> Column:
    """Entities decoded (all that HTML knows, even without semicolon, or the listed ones), tags replaced by a space, white space collapsed and trimmed. Only tags go: script bodies stay."""
    plain = unescape_all(text) if every_entity else unescape_common(text, entities)
    space = r"(?U)\s+" if every_entity else r"\s+"  # all entities give any white space, no-break spaces too
    return F.trim(F.regexp_replace(F.regexp_replace(plain, "<[^>]+>", " "), space, " "))


def topic_pattern(words: list[str]) -> str:
    """Single words between word boundaries, phrases anywhere; alternatives in their order."""
    return "|".join(re.escape(w) if " " in w else rf"\b{re.escape(w)}\b" for w in words)
