"""DataFrame operators: merchant resolution, categories, FX, report, vector top-1, chunked dimension search."""
