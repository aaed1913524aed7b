"""docloom: a document and row engine on PySpark."""
