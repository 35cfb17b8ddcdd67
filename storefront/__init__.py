"""Storefront analytics on Spark.

Retail analytics (loyalty, order fulfilment, a weekly sales mart) expressed
as plain DataFrame plans: no Python UDFs, no driver-side loops.
"""

__version__ = "0.1.0"
