"""DataFrame operators: ``(df, params) -> df``, lazy, no driver collects."""
