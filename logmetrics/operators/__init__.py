"""Table operators: DataFrame -> DataFrame, batch and micro-batch alike."""
