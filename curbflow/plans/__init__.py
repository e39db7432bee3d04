"""The named relations, each a pure function of upstream DataFrames."""
