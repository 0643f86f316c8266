"""streaming of the document-corpus engine."""
