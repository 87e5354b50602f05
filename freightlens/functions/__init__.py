"""Column functions: the blank and number model of source data, classifications, and event picks."""
