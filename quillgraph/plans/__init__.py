"""quillgraph.plans."""
