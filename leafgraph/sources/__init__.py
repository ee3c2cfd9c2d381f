"""Where documents come from."""

from leafgraph.sources.corpus import corpus_tree_sql, markdown_corpus, markdown_corpus_sql
from leafgraph.sources.files import load_documents, load_table, validate_documents, write_stage

__all__ = ["corpus_tree_sql", "load_documents", "load_table", "markdown_corpus", "markdown_corpus_sql", "validate_documents", "write_stage"]
