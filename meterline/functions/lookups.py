"""Code lists as map literals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_literal(text: str | None) -> str:
    """A SQL string literal."""
    if text is None:
        return "CAST(NULL AS STRING)"
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"


def code_map(codes: Mapping[int, str]) -> Column:
    # As one SQL text: a long list would otherwise be hundreds of calls into the JVM.
    return F.expr("map({})".format(", ".join(f"{code}, {text_literal(text)}" for code, text in codes.items())))


def decode(id_column: Column | str, codes: Mapping[int, str]) -> Column:
    """Text for a code; NULL for NULL and for codes outside the list."""
    key = F.col(id_column) if isinstance(id_column, str) else id_column
    return code_map(codes)[key.cast("int")]
