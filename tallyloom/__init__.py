"""tallyloom: clean -> build features -> sample -> fit -> measure, as Spark DataFrames.

Every function takes and returns DataFrames or Columns.  Randomness is a hash
of a row key and a seed, so a result does not depend on how rows are laid out.
"""
