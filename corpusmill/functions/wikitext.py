"""Wiki and HTML markup removal as one chain of native string expressions.

Java's regex engine backtracks, so a rule such as "``<`` up to the next ``>``" re-reads the rest of the
text for every unmatched ``<``. Each rule below therefore has a second alternative that recognises an
opening which cannot be completed, captures everything up to the point where the next attempt could do
better, and writes it back unchanged through ``$1``. Every rule reads a text once, whatever it holds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inline flags: Unicode-aware classes, and only "\n" ends a line for ".".
FLAGS = "(?Ud)"

# What each rule must remove, in the order the rules apply. Kept as plain patterns for
# reference, for the SQL checks and for the brute-force tests.
RULES: tuple[tuple[str, str, str], ...] = (
    ("templates", r"\{\{[^}]*\}\}", ""),
    ("file links", r"\[\[(File|Image):[^\]]*\]\]", ""),
    ("piped links", r"\[\[([^|\]]+)\|([^\]]+)\]\]", r"\2"),
    ("simple links", r"\[\[([^\]]+)\]\]", r"\1"),
    ("bold", r"'''", ""),
    ("italic", r"''", ""),
    ("comments", r"<!--.*?-->", ""),
    ("labelled external links", r"\[https?://[^\s\]]+ ([^\]]+)\]", r"\1"),
    ("bare external links", r"\[https?://[^\s\]]+\]", ""),
    ("headings", r"=+\s*([^=]+)\s*=+", r"\1"),
    ("paired references", r"<ref[^>]*>.*?</ref>", ""),
    ("closed references", r"<ref[^>]*/\s*>", ""),
    ("tags", r"<[^>]+>", ""),
    ("whitespace", r"\s+", " "),
)



def _unfinished(opening: str, rest: str) -> str:
    """An alternative that keeps an opening and the rest up to where another attempt is worthwhile.

    ``rest`` is looked at before the opening is captured again from behind: Java does not undo captures
    made inside a lookbehind, so nothing may fail after them.
    """
    return f"(?={rest})(?<=({opening}))({rest})"


# The same rules in the single-pass form described above. Each begins with its literal opening, which is
# what the engine looks for fastest.
_LINEAR: dict[str, tuple[str, str]] = {
    "templates": (
        r"\{\{(?:[^}]*+\}\}|" + _unfinished(r"\{\{", r"[^}]*+(?:\}(?!\})|\z)") + ")",
        "$1$2",
    ),
    "file links": (
        r"\[\[(?:(?:File|Image):[^\]]*+\]\]|"
        + _unfinished(r"\[\[", r"(?:File|Image):[^\]]*+(?:\](?!\])|\z)")
        + ")",
        "$1$2",
    ),
    "piped links": (
        r"\[\[(?:[^|\]]++\|([^\]]++)\]\]|" + _unfinished(r"\[\[", r"(?!\|)[^\]]*+(?:\]|\z)") + ")",
        "$1$2$3",
    ),
    "simple links": (
        r"\[\[(?:([^\]]++)\]\]|" + _unfinished(r"\[\[", r"[^\]]*+(?:\]|\z)") + ")",
        "$1$2$3",
    ),
    "comments": (r"<!--(?:.*?-->|" + _unfinished("<!--", r"[^\n]*+") + ")", "$1$2"),
    "labelled external links": (
        r"\[http(?:s?://[^\s\]]++ ([^\]]++)\]|"
        + _unfinished(r"\[http", r"s?://[^\s\]]++(?: [^\]]++\z)?+")
        + ")",
        "$1$2$3",
    ),
    "bare external links": (
        r"\[http(?:s?://[^\s\]]++\]|" + _unfinished(r"\[http", r"s?://[^\s\]]++") + ")",
        "$1$2",
    ),
    "headings": (r"=(?<!==)=*+(?:\s*+([^=\s][^=]*+)|\s*(\s))=++", "$1$2"),
    "paired references": (
        r"<ref(?:[^>]*+>.*?</ref>|" + _unfinished("<ref", r"[^>]*+(?:>(?:[^\n]*>)?+|\z)") + ")",
        "$1$2",
    ),
    "closed references": (
        r"<ref(?:[^>]*/\s*>|" + _unfinished("<ref", r"[^>]*+(?:>|\z)") + ")",
        "$1$2",
    ),
    "tags": (r"<(?:[^>]++>|" + _unfinished("<", r"[^>]*+\z") + ")", "$1$2"),
    # A lone space is left as it is instead of being replaced by itself.
    "whitespace": (r"\s(?:\s++|(?<! ))", " "),
}


def apply_rule(text: Column, name: str) -> Column:
    if name == "bold":
        return F.replace(text, F.lit("'''"), F.lit(""))
    if name == "italic":
        return F.replace(text, F.lit("''"), F.lit(""))
    pattern, replacement = _LINEAR[name]
    return F.regexp_replace(text, FLAGS + pattern, replacement)


def strip_markup(text: Column) -> Column:
    """All rules in order, then the outer blanks (only spaces are left by then)."""
    for name, _, _ in RULES:
        text = apply_rule(text, name)
    return F.trim(text)
