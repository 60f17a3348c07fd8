"""marketloom: exchange market-data analytics as PySpark DataFrame operators.

Every operator takes and returns DataFrames that hold *many* securities, keyed
by ``(market, code)``; nothing is collected to the driver.
"""

__version__ = "0.1.0"
