"""What each layer computes: DataFrame in, DataFrame out; `runs` does the writing."""
