"""Text predicates and trims shared by the operators."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words with which a source says that nothing is given.
MISSING_WORDS = (
    "n/a", "na", "n.a.", "n.a", "#n/a", "#na", "none", "null", "nil", "nan", "tbd", "tbc", "tba",
    "unknown", "not disclosed", "not provided", "not available", "(not available)", "not given",
    "not stated", "not reported", "not applicable", "undisclosed", "unspecified", "missing", "blank",
    "n.m.", "n/d", "n.d.", "(none)", "(blank)", "(unknown)", "(n/a)", "[n/a]", "no data", "empty",
)


def outer_trim(c: Column) -> Column:
    """``c`` without outer blanks; the no-break space and the like are blanks."""
    return F.regexp_replace(c, r"(?U)^[\s​﻿]+|[\s​﻿]+$", "")


def one_space(c: Column) -> Column:
    """``c`` trimmed, with every inner run of blanks as one space."""
    return F.regexp_replace(outer_trim(c), r"(?U)\s+", " ")


# one match that fails at the first letter of most texts, instead of cleaning each text first
_WORDS = "|".join(r"\s+".join(re.escape(w) for w in words.split(" ")) for words in MISSING_WORDS)
_MISSING = rf"(?iU)^[\s\u200b\ufeff]*(?:[-–—―‒?._*/\\]+|{_WORDS})?[\s\u200b\ufeff]*$"


def is_missing(c: Column) -> Column:
    """True where ``c`` is null, blank, or only says that nothing is given."""
    return c.isNull() | c.rlike(_MISSING)
