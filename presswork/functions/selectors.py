"""Simple CSS selectors (tag, .class, #id, [attr="value"])."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.text import strip

_SIMPLE = r'^([A-Za-z][\w-]*)?((?:[.#][\w-]+|\[[\w:-]+(?:=(?:"[^"]*"|\x27[^\x27]*\x27|[\w-]+))?\])*)$'


class Selectors:
    """Simple selectors in order, looked up by tag, id or class of an element."""

    def __init__(self, parts: list[tuple[str, str, list[str], str, str | None]]) -> None:
        """parts: (tag, id, classes, attribute, its value or None for any), '' for none."""
        self.by_tag, self.by_id, self.by_class, self.others = {}, {}, {}, []
        for place, (tag, ident, classes, attr, value) in enumerate(parts, 1):
            if attr or (bool(tag) + bool(ident) + len(classes)) != 1:
                self.others.append((place, tag, ident, frozenset(classes), attr, value))
            elif tag:
                self.by_tag.setdefault(tag, place)
            elif ident:
                self.by_id.setdefault(ident, place)
            else:
                self.by_class.setdefault(classes[0], place)

    @classmethod
    def fixed(cls, selectors: tuple[str, ...]) -> Selectors:
        """Selectors known when the plan is built: tag, .class and #id compounds."""
        out = []
        for selector in selectors:
            if not re.fullmatch(r"([A-Za-z][\w-]*)?(?:[.#][\w-]+)*", selector):
                raise ValueError(f"unsupported selector: {selector}")
            tag = re.match(r"[\w-]*", selector)[0].lower()
            out.append((tag, "".join(re.findall(r"#([\w-]+)", selector)), re.findall(r"\.([\w-]+)", selector), "", None))
        return cls(out)

    @classmethod
    def configured(cls, rows: list[dict] | None) -> Selectors:
        """Selectors of a source, as ``compiled`` leaves them."""
        return cls([(r["tag"], r["id"], r["cls"], r["attr"], r["value"]) for r in rows or []])

    def first(self, tag: str, ident: str, classes: list[str], attrs: dict[str, str]) -> int | None:
        """Place (from 1) of the first selector that matches an element."""
        hits = [self.by_class[c] for c in classes if c in self.by_class]
        for table, key in ((self.by_tag, tag), (self.by_id, ident)):
            if key in table:
                hits.append(table[key])
        for place, want, name, needed, attr, value in self.others:
            if (
                want in ("", tag) and name in ("", ident) and needed.issubset(classes)
                and (not attr or (attr in attrs and value in (None, attrs[attr])))
            ):
                hits.append(place)
                break
        return min(hits, default=None)


def text_list(values: Column) -> Column:
    """Non-blank entries of a configured list, trimmed; null counts as empty."""
    kept = F.filter(values, lambda v: v.isNotNull() & (strip(v) != ""))
    return F.coalesce(F.transform(kept, strip), F.array().cast("array<string>"))


def compiled(selectors: Column) -> Column:
    """Configured selectors in parts, for ``Selectors.configured``.

    Run this on the configuration table, once per source. Selectors with
    combinators or pseudo-classes are refused.
    """

    def parts(s):
        plain = F.regexp_replace(s, r"\[.*?\]", "")
        quoted = F.regexp_extract(s, r'=[\x27"]?([^\x27"\]]*)[\x27"]?\]', 1)
        return F.struct(
            F.when(s.rlike(_SIMPLE), F.lower(F.regexp_extract(s, _SIMPLE, 1)))
            .otherwise(F.raise_error(F.concat(F.lit("unsupported selector: "), s)).cast("string"))
            .alias("tag"),
            F.regexp_extract(plain, r"#([\w-]+)", 1).alias("id"),
            F.regexp_extract_all(plain, F.lit(r"\.([\w-]+)"), 1).alias("cls"),
            F.lower(F.regexp_extract(s, r"\[([\w:-]+)", 1)).alias("attr"),
            F.when(s.contains("="), quoted).alias("value"),
        )

    return F.transform(text_list(selectors), parts)
