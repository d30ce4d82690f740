"""DataFrame operators.  Each takes and returns DataFrames and runs no driver-side loop over rows."""
