"""Column functions on whole JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_single_document(text: Column) -> Column:
    """True when the text is exactly one JSON value with nothing behind it.

    The JSON readers stop after the first value, so ``[..] rest`` passes them. Putting the
    text between brackets and between braces makes the rest visible: a tail that one
    wrapping would accept breaks the other. The second pair of tests is for documents with
    NaN or Infinity, which the counting functions do not know.
    """
    bracketed = F.concat(F.lit("["), text, F.lit("]"))
    braced = F.concat(F.lit('{"d":'), text, F.lit("}"))
    plain = (F.json_array_length(bracketed) == 1) & (F.size(F.json_object_keys(braced)) == 1)
    strict_quotes = {"allowSingleQuotes": "false"}
    special = (F.size(F.from_json(bracketed, "array<string>", strict_quotes)) == 1) & F.from_json(
        braced, "d string", strict_quotes
    )["d"].isNotNull()
    return F.when(plain, F.lit(True)).otherwise(F.coalesce(special, F.lit(False)))


def document_state(text: Column) -> Column:
    """``ok``, ``empty`` (an empty list) or ``error`` for the text of one file."""
    return (
        F.when(text.rlike(r"^\s*\[\s*\]\s*$"), F.lit("empty"))
        .when(text.rlike(r"^\s*[\[{]") & is_single_document(text), F.lit("ok"))
        .otherwise(F.lit("error"))
    )
