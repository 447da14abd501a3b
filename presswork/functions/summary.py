"""Plain text of feed summaries, which carry small HTML fragments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.text import html_unescape, norm_text

# Tags that separate words.
SPACING_TAGS = ("br", "div", "li", "p")

_SPACING = rf"(?i)<(?:{'|'.join(SPACING_TAGS)})(?=[\s/>])[^>]*>"
_MARKUP = r"(?s)<!--.*?(?:-->|$)|</?[A-Za-z][^>]*>|<[!?/][^>]*>"


def summary_text(fragment: Column) -> Column:
    """Text of a summary; null when there is none.

    References are resolved twice, as feeds escape markup that is escaped already.
    """
    bare = F.regexp_replace(F.regexp_replace(fragment, _SPACING, " "), _MARKUP, "")
    return F.nullif(norm_text(html_unescape(bare, times=2)), F.lit(""))
