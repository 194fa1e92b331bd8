"""Row and table operators. Each takes and returns DataFrames (or a ChainResult) and only builds a plan."""
