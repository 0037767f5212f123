"""Sources: metadata CSV, paper JSON, the driver's Parquet tables."""

from .papers import load_corpus, paper_documents, read_metadata, read_papers  # noqa: F401
