"""DataFrame -> DataFrame operators: joins, windows, splits, selections."""
