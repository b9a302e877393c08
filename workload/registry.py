"""All registered queries by name."""

from __future__ import annotations

from .payload_queries import PAYLOAD_QUERIES
from .document_queries import DOCUMENT_QUERIES
from .export_queries import EXPORT_QUERIES
from .operator_queries import OPERATOR_QUERIES
from .source_queries import SOURCE_QUERIES
from .stored_queries import STORED_QUERIES
from .view_queries import VIEW_QUERIES

QUERIES = {q.name: q for q in [*VIEW_QUERIES, *PAYLOAD_QUERIES, *OPERATOR_QUERIES, *EXPORT_QUERIES, *SOURCE_QUERIES, *STORED_QUERIES, *DOCUMENT_QUERIES]}
