"""functions of the document-corpus engine."""
