"""sources of the document-corpus engine."""
