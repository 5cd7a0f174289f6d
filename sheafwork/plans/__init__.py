"""Operators put together into whole jobs."""

from sheafwork.plans.forms import (
    CUSTOMER_FORM,
    customer_documents,
    document_slots,
    order_documents,
    supplier_documents,
    text_documents,
)
from sheafwork.plans.pages import careless_manifests, items_per_language, page_manifest

__all__ = [
    "CUSTOMER_FORM",
    "careless_manifests",
    "customer_documents",
    "document_slots",
    "items_per_language",
    "order_documents",
    "page_manifest",
    "supplier_documents",
    "text_documents",
]
