"""tallymart: retail, recommendation and statistics operators for PySpark DataFrames."""
