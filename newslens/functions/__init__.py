"""Column functions: text, HTML, chunks, model responses."""
