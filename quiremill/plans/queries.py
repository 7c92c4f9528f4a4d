"""The queries over the driver tables, one and more for each operator family."""

from quiremill.plans import document_queries, layout_queries, quality_queries, structure_queries, text_queries  # noqa: F401
