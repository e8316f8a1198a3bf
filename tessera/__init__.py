"""tessera: document-corpus analytics expressed as Spark DataFrame and SQL plans."""
