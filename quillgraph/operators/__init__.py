"""quillgraph.operators."""
