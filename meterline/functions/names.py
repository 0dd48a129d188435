"""Snake-case names, for schemas (driver metadata) and for string columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word starts after a lower-case letter or digit, or at the last
# capital of a run of capitals. Java and Python read this pattern alike.
WORD_START = r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"


def snake_case(name: str) -> str:
    return "_".join(re.split(WORD_START, name)).lower()


def snake_case_text(column: Column | str) -> Column:
    return F.lower(F.regexp_replace(column, WORD_START, "_"))
