"""Functions of the document and row engine."""
