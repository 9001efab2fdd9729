"""quillgraph.functions."""
