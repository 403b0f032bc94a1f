"""DataFrame operators: DataFrame in, DataFrame out, for batch and streams alike."""
