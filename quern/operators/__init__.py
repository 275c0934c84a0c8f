"""DataFrame operators: row selection, ordering, deduplication, packing, vocabulary counts."""
