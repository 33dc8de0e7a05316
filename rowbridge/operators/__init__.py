"""DataFrame operators: transforms, splits, merges, numbering, cells, reports."""
