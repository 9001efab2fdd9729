"""quillgraph.sources."""
