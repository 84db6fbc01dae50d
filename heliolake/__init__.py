"""heliolake: a PySpark-native analytics engine for photovoltaic-installation inventories.

Everything is a function from DataFrame to DataFrame. Plans are declared with the
DataFrame and SQL API and left to Catalyst and adaptive execution; geometry codecs
are the only code that leaves the JVM, in Arrow batches.
"""

__version__ = "0.1.0"
