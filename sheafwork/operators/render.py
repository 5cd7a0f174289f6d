"""Render rows into form documents: row-local, no shuffle."""

from __future__ import annotations

import html as html_lib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.functions import markup


@dataclass(frozen=True)
class Slot:
    """One list item. The value is a column, or always missing without one."""

    hint: str
    label: str | None = None
    column: str | None = None

    def __post_init__(self):
        if self.label is not None and set(self.label) & set(":[]"):
            raise ValueError(f"a label cannot contain ':', '[' or ']': {self.label!r}")
        if not self.hint.strip():
            raise ValueError("a hint cannot be blank")


@dataclass(frozen=True)
class Group:
    """A bracketed list item holding a nested list of slots."""

    heading: str
    slots: tuple[Slot, ...]


@dataclass(frozen=True)
class Section:
    """A numbered heading, an optional marker and the items below it."""

    title: str
    entries: tuple[Slot | Group, ...]
    marker: str | None = None

    def __post_init__(self):
        if self.title.rstrip().endswith(")"):
            raise ValueError(f"a title cannot end with ')': {self.title!r}")
        if self.marker is not None and (set(self.marker) & set("()") or not self.marker.strip()):
            raise ValueError(f"a marker cannot be blank or contain '(' or ')': {self.marker!r}")


@dataclass(frozen=True)
class Form:
    """A document: sections are numbered from 1 in the given order."""

    title: str
    sections: tuple[Section, ...]
    lang: str = "en"


def _text(value: str) -> str:
    return html_lib.escape(value, quote=False)


def _bracketed(value: str) -> str:
    return f"[{_text(value).replace('[', '&#91;').replace(']', '&#93;')}]"


def _value(slot: Slot) -> Iterator[str | Column]:
    missing = f'<span class="{markup.HINT_CLASS}">{_bracketed(slot.hint)}</span>'
    if slot.column is None:
        yield missing
    else:
        text = F.col(slot.column).cast("string")
        # A blank value cannot be told from a missing one in the document.
        blank = F.trim(text, F.lit(" \t\r\n\f")) == ""
        yield F.when(text.isNull() | blank, F.lit(missing)).otherwise(markup.escape(text))


def _entry(entry: Slot | Group, nested: bool = False) -> Iterator[str | Column]:
    yield "<li>"
    if isinstance(entry, Group):
        yield f'<span class="{markup.LABEL_CLASS}">{_bracketed(entry.heading)}</span>\n<ul>\n'
        for slot in entry.slots:
            yield from _entry(slot, nested=True)
        yield "</ul>\n"
    else:
        if entry.label is not None:
            label = f"{_text(entry.label)}:"
            if not nested:
                label = f'<span class="{markup.LABEL_CLASS}">{label}</span>'
            yield label + " "
        yield from _value(entry)
    yield "</li>\n"


def _document(form: Form) -> Iterator[str | Column]:
    title = _text(form.title)
    yield (
        f'<!DOCTYPE html>\n<html lang="{html_lib.escape(form.lang)}">\n<head>\n'
        f'<meta charset="UTF-8">\n<title>{title}</title>\n</head>\n'
        f"<body>\n<h1>{title}</h1>\n"
    )
    for no, section in enumerate(form.sections, 1):
        marker = "" if section.marker is None else f" ({_text(section.marker)})"
        yield (
            f"<h2>{no}. {_text(section.title)}{marker}</h2>\n"
            "<div>\n<ul>\n"
        )
        for entry in section.entries:
            yield from _entry(entry)
        yield "</ul>\n</div>\n"
    yield "</body>\n</html>\n"


def render(rows: DataFrame, form: Form, doc_id: str, *keep: str) -> DataFrame:
    """(doc_id, html): one form per row, its slots filled from the row's columns.

    A NULL or blank value leaves a placeholder with the slot's hint. Values are
    escaped so that they read back as they were, but for white space, which is
    squeezed on reading. Columns named in ``keep`` are carried along.
    """
    parts: list[Column] = []
    literal = ""
    for part in _document(form):
        if isinstance(part, str):
            literal += part
        else:
            parts += [F.lit(literal), part]
            literal = ""
    parts.append(F.lit(literal))
    return rows.select(F.col(doc_id).alias("doc_id"), *keep, F.concat(*parts).alias("html"))
