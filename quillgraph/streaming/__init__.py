"""quillgraph.streaming."""
