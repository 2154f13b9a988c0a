"""riskloom: credit-risk analytics as Spark DataFrame operators.

Every operator takes and returns a ``DataFrame`` and stays lazy; reports are
flat tables built in a fixed number of Spark jobs, whatever the number of
columns. See README.md for the module map.
"""

__version__ = "0.1.0"
