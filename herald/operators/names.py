"""Last-name normalization."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: everything from the first "(" to the last ")", line breaks included.
PARENTHESES = r"(?s)\(.*\)"


def clean_last_name(df: DataFrame, column: str = "last_name", keep_steps: bool = False,
                    strip_titles: Sequence[str] = ()) -> DataFrame:
    """Add ``clean_last_name``: the last word of the name without titles, in lower case.

    The name is cut at its first comma, loses parenthesised text, is lower-cased and
    trimmed of spaces, and its last space-separated word is kept. ``strip_titles`` also
    drops those words from the end, which the plain rule does not do. One narrow projection.
    """
    no_comma = F.substring_index(F.col(column), ",", 1)
    no_parens = F.regexp_replace(no_comma, PARENTHESES, "")
    lowered = F.trim(F.lower(no_parens))
    bare = lowered
    if strip_titles:
        words = "|".join(rf"\Q{t.lower()}\E" for t in strip_titles)
        bare = F.regexp_replace(lowered, f"( +({words}))+$", "")
    last_word = F.substring_index(bare, " ", -1)
    steps = {"step1_remove_titles": no_comma, "step2_remove_parens": no_parens,
             "step3_normalized": lowered} if keep_steps else {}
    return df.withColumns({**steps, "clean_last_name": last_word})
