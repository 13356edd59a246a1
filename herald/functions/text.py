"""Text building from expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters with a meaning in HTML, ampersand first.
HTML_ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")]


def escape_html(text: Column) -> Column:
    for raw, safe in HTML_ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def fill(template: str, **slots: Column) -> Column:
    """Concatenate the template with each ``{slot}`` replaced; NULL shows as nothing."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[
        F.coalesce(slots[part], F.lit("")) if i % 2 else F.lit(part)
        for i, part in enumerate(parts)])


def thousands(number: Column) -> Column:
    """Whole number with separators; fractions round half up."""
    return F.format_number(F.round(number, 0).cast("bigint"), 0)
