"""DataFrame-in, DataFrame-out operators. Column names are always arguments."""
