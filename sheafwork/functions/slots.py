"""Label, value and hint of one list item, as column expressions.

They are written in steps so that each step can be its own column, or its own
``transform`` when the items of a document are still one array.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafwork.functions import markup

_BRACKETS = r"\[[^\]]*\]"
_ALL_BRACKETS = r"\A\[[^\]]*\]\z"
# A colon after an opening bracket, or after the last one found, with no other
# bracket in between.
_BRACKETED_COLON = r"((?:\[|\G(?!\A))[^\[\]:]*):"
# Takes the place of a colon that does not end a label, in a copy as long as the text.
_NO_COLON = "."


def has_hint(content: Column) -> Column:
    """Whether the item has a placeholder span."""
    return F.contains(content, F.lit(markup.HINT_CLASS)) & content.rlike(markup.HINT_SPAN)


def given_text(content: Column, text: Column) -> Column:
    """The item's text without its placeholder, whose words are not an answer."""
    given = markup.plain_fragment(F.regexp_replace(content, markup.HINT_SPAN, " "))
    return F.when(F.contains(content, F.lit(markup.HINT_CLASS)), given).otherwise(text)


def label_cut(text: Column) -> Column:
    """Two parts as long as those before and after the first colon outside brackets, or
    one part without such a colon. The parts tell where to cut; their text is not the
    original one.
    """
    # Every bracket that opens before the last one that closes is a closed one.
    tail = F.substring_index(text, "]", -1)
    head = F.left(text, F.length(text) - F.length(tail))
    guarded = F.concat(F.regexp_replace(head, _BRACKETED_COLON, "$1" + _NO_COLON), tail)
    bracketed = F.contains(text, F.lit("]"))
    return F.split(F.when(bracketed, guarded).otherwise(text), ":", 2)


def cut_label(cut: Column, text: Column) -> Column:
    """Label of a :func:`label_cut`; brackets are no part of it. NULL if there is none."""
    before = F.when(F.size(cut) == 2, F.left(text, F.length(F.get(cut, F.lit(0)))))
    bare = markup.squeeze(F.regexp_replace(before, _BRACKETS, " "))
    label = F.when(F.contains(before, F.lit("]")), bare).otherwise(F.trim(before))
    return markup.blank_to_null(markup.unescape(label))


def cut_raw(cut: Column, label: Column, text: Column) -> Column:
    """Text after the label, or all of it without a label, with entities as written."""
    after = F.substr(text, F.length(F.get(cut, F.lit(0))) + 2)
    return F.trim(F.when(label.isNotNull(), after).otherwise(text))


def value_of(raw: Column) -> Column:
    """The value of a :func:`cut_raw`; NULL if empty."""
    return markup.blank_to_null(markup.unescape(raw))


def is_bracketed(raw: Column) -> Column:
    """Whether a value is wholly ``[...]``, the brackets not being written as entities."""
    ends = F.endswith(raw, F.lit("]")) & raw.rlike(_ALL_BRACKETS)
    return F.coalesce(ends, F.lit(False))


def hint_of(content: Column, hinted: Column, bracketed: Column, raw: Column) -> Column:
    """Words of the placeholder span or of the brackets, without the brackets."""
    span = markup.plain_fragment(F.regexp_extract(content, markup.HINT_SPAN, 1))
    words = F.when(hinted, span).when(bracketed, raw)
    inner = F.trim(F.regexp_replace(words, r"\A\[([^\]]*)\]\z", "$1"))
    return markup.blank_to_null(markup.unescape(inner))
