"""Column expressions over markup text.

Everything here is a built-in Spark expression, so it stays inside the JVM and
inside the stage that scans the documents. The patterns avoid quantified groups,
for which the Java engine recurses once a repetition, so that a long page could overflow
the task's stack; the ones that are repeated are possessive, which it matches in a loop.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names that carry meaning in the form markup.
LABEL_CLASS = "highlight"
HINT_CLASS = "placeholder"

# Characters with a meaning in the form and the entity written for
# each. The ampersand comes first for writing and last for reading.
ENTITIES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ("[", "&#91;"),
    ("]", "&#93;"),
)

# White space that is not already a single space, so that most of a text's spaces
# are passed over and not replaced by themselves.
WHITE = r"[ \t\r\n\f](?:[ \t\r\n\f]+|(?<=[\t\r\n\f]))"
# As in a browser, a "<" before anything but a name is text, and a tag, script,
# style or comment without an end takes the rest and is not shown. So a start that
# is found is mostly a match too, and the engine does not run to the end of a page
# again and again for starts without an end.
_TAG = r"[a-z/!?][^>]*(?:>|\z)"
# Alternatives share their first character: one comparison rules most places out.
_HIDDEN = (
    r"script(?:\s[^>]*)?>.*?(?:</script\s*>|\z)"
    r"|style(?:\s[^>]*)?>.*?(?:</style\s*>|\z)"
    r"|!--(?:-?>|.*?(?:--!?>|\z))"
)
TAG = rf"(?i)<{_TAG}"
HIDDEN = rf"(?is)<(?:{_HIDDEN})"
HIDDEN_OR_TAG = rf"(?is)<(?:{_HIDDEN}|{_TAG})"
H2_OPEN = r"(?i)<h2(?:\s[^>]*)?>"
H2_CLOSE = r"(?i)</h2\s*>"
ITEM_OPEN = r"(?i)<li(?:\s[^>]*)?>"
ITEM_END = r"(?i)</li\s*>|<h2(?:\s[^>]*)?>"
# A start tag does not run over further starts. Spans inside belong to the hint.
HINT_SPAN = (
    r"""(?is)<span(?:\s[^<>]*)?\sclass\s*=\s*["'](?:[^"'<>]*\s)?"""
    + HINT_CLASS
    + r"""(?:\s[^"'<>]*)?["'][^<>]*>"""
    + r"""((?:[^<]*<span(?:\s[^<>]*)?>[^<]*</span\s*>)*+.*?)(?:</span\s*>|\z)"""
)

# A repeated group that never gives back is matched in a loop, without recursion.
def _others(wanted: str) -> str:
    """Whole attributes that stand before the one looked for, however many."""
    value = r"""(?:\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>]+))?"""
    return rf"""(?:\s+(?!{wanted})[^\s=<>"']+{value})*+"""


LANG = rf"""(?i)<html{_others(r"lang\s*=")}\s+lang\s*=\s*["']?([^"'\s<>]*)"""
_CHARSET_OF = r"""content\s*=\s*["'][^"'<>]*?charset\s*=\s*"""
_CHARSET_IN = rf"""{_others(_CHARSET_OF)}\s+{_CHARSET_OF}([^"'\s/<>;]+)"""
_TYPE = r"""http-equiv\s*=\s*["']?content-type"""
_EQUIV = rf"""{_others(_TYPE)}\s+{_TYPE}"""
# The first tag that tells counts, in one of three spellings with a group each.
CHARSET = (
    rf"""(?i)<meta(?:{_others(r"charset\s*=")}\s+charset\s*=\s*["']?([^"'\s/<>;]+)"""
    rf"""|{_EQUIV}["']?{_CHARSET_IN}"""
    rf"""|{_CHARSET_IN}[^"'<>]*["']{_EQUIV})"""
)
# Only the first start is tried: without an end after it there is none at all.
TITLE = r"(?is)\A(?>.*?<title(?:\s[^<>]*)?>)(.*?)</title\s*>"
H1 = r"(?is)\A(?>.*?<h1(?:\s[^<>]*)?>)(.*?)</h1\s*>"


def blank_to_null(text: Column) -> Column:
    """NULL for the empty string."""
    return F.nullif(text, F.lit(""))


def squeeze(text: Column) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(text, WHITE, " "))


def without_hidden(html: Column) -> Column:
    """Markup without scripts, styles, comments and a tag cut off at the end."""
    tail = F.substring_index(html, ">", -1)
    head = F.left(html, F.length(html) - F.length(tail))
    cut = F.concat(head, F.regexp_replace(tail, TAG, ""))
    whole = F.when(F.contains(tail, F.lit("<")), cut).otherwise(html)
    return F.regexp_replace(whole, HIDDEN, " ")


def plain(html: Column) -> Column:
    """Visible text: hidden parts and tags become a space, then white space is squeezed."""
    return squeeze(F.regexp_replace(html, HIDDEN_OR_TAG, " "))


def plain_fragment(html: Column) -> Column:
    """:func:`plain` for markup whose hidden parts are already gone."""
    return squeeze(F.regexp_replace(html, TAG, " "))


def first_group(html: Column, pattern: str, group: int = 1) -> Column:
    """A capture of the first match, NULL when nothing or only '' is captured."""
    return blank_to_null(F.regexp_extract(html, pattern, group))


def item_content(fragment: Column) -> Column:
    """Markup of one item: up to its closing tag, or all if it has none.

    The usual spelling is looked for first, as bytes, since the last fragment runs
    on to the end of its page.
    """
    short = F.substring_index(fragment, "</li>", 1)
    return F.get(F.split(short, ITEM_END, 2), F.lit(0))


def escape(text: Column) -> Column:
    """Write the characters of :data:`ENTITIES` as entities."""
    for char, entity in ENTITIES:
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`; other entities stay as they are."""
    for char, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text
