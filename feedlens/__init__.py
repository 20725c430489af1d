"""feedlens: product analytics on Spark.

Every operator takes DataFrames and returns a lazy DataFrame; nothing reads the
wall clock (dates are passed in) and nothing is collected to the driver.
"""

__version__ = "0.1.0"
