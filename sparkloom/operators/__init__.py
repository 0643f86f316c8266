"""operators of the document-corpus engine."""
