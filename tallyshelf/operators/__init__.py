"""DataFrame operators: cleaning, de-duplication, reshaping, grouping, quantiles."""
