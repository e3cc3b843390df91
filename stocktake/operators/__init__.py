"""DataFrame -> DataFrame building blocks with column names as arguments."""
