"""riskspark: credit-risk analytics as PySpark DataFrame operators.

Every public operator takes DataFrames and returns a DataFrame; nothing is
collected to the driver except bounded scalars (a handful of cut points,
fitted model coefficients).
"""

__version__ = "0.1.0"
