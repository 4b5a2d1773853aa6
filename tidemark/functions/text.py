from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters after which a new word starts.
WORD_BREAKS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>\t\n\r\f\x0b"

# Boolean spellings accepted besides the ones Spark's own cast knows.
EXTRA_TRUE = "on"
EXTRA_FALSE = "off"

#: A place behind a break, as a regular expression.
AFTER_BREAK = "(?<=[" + re.sub(r"([\\\[\]^&-])", r"\\\1", WORD_BREAKS) + "])"


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every word, lower-case the rest.

    Spark's ``initcap`` starts a word after a space only, so the text is cut behind every other break and each part
    gets its own.
    """
    return F.array_join(F.transform(F.split(text, AFTER_BREAK, -1), F.initcap), "")


def text_flag(text: Column) -> Column:
    """Cast a flag written as text to boolean; an unknown spelling is an error."""
    word = F.lower(F.trim(text))
    return F.when(word == EXTRA_TRUE, True).when(word == EXTRA_FALSE, False).otherwise(word.cast("boolean"))
