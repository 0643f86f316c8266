"""plans of the document-corpus engine."""
