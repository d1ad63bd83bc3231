"""DataFrame operators. Each takes DataFrames and returns a lazy DataFrame unless it says otherwise."""
