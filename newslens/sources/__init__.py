"""Reading and writing: day partitions, upserts, JSON lines, pages over HTTP."""
