"""Analytics over knowledge documents, on Spark."""
