"""Readers for manifests and documents, batch and stream."""

from sheafwork.sources.documents import (
    documents_from_pages,
    scan_documents,
    stream_documents,
    write_documents,
)
from sheafwork.sources.manifest import (
    MANIFEST_SCHEMA,
    WRITE_OPTIONS,
    scan_manifest,
    scan_manifest_checked,
    store_checked,
    stream_manifest,
    stream_manifest_checked,
)
from sheafwork.sources.packing import pack_documents, read_packed

__all__ = [
    "MANIFEST_SCHEMA",
    "WRITE_OPTIONS",
    "documents_from_pages",
    "pack_documents",
    "read_packed",
    "scan_documents",
    "scan_manifest",
    "scan_manifest_checked",
    "store_checked",
    "stream_documents",
    "stream_manifest",
    "stream_manifest_checked",
    "write_documents",
]
