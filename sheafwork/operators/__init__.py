"""DataFrame operators over manifests, documents, sections, items and slots."""

from sheafwork.operators.items import item_tree, list_items
from sheafwork.operators.manifests import manifest_path
from sheafwork.operators.metadata import document_metadata, document_text
from sheafwork.operators.render import Form, Group, Section, Slot, render
from sheafwork.operators.reports import (
    completeness,
    completeness_documents,
    completeness_windows,
    label_map,
    merge_parts,
    wide,
    wide_documents,
    wide_of_parts,
    wide_parts,
)
from sheafwork.operators.sections import parse_heading, sections
from sheafwork.operators.slots import label_values, slots, unfilled

__all__ = [
    "Form",
    "Group",
    "Section",
    "Slot",
    "completeness",
    "completeness_documents",
    "completeness_windows",
    "document_metadata",
    "document_text",
    "item_tree",
    "label_map",
    "label_values",
    "list_items",
    "manifest_path",
    "merge_parts",
    "parse_heading",
    "render",
    "sections",
    "slots",
    "unfilled",
    "wide",
    "wide_documents",
    "wide_of_parts",
    "wide_parts",
]
