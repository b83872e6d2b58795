"""Transaction operators: DataFrame -> DataFrame, batch or streaming where legal."""
