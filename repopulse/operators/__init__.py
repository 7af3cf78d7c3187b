"""DataFrame to DataFrame operators. None runs a job or collects rows, and none sorts its result
unless the order is the feature."""
