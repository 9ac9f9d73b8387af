"""textloom: text-corpus analytics and curation as Spark DataFrame operators."""
