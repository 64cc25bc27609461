"""Feature jobs: DataFrames in, DataFrame out; nothing runs until the caller writes or collects."""
