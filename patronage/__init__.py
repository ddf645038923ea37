"""Customer analytics as Spark DataFrame operators.

``sources``    reading, checking and writing tables
``functions``  column expressions and small distributed helpers
``operators``  one module per family of operators
``plans``      operators joined into whole jobs, and the look-ups over their results
"""

__version__ = "0.1.0"
