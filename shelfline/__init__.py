"""Retail marts on Spark: raw feeds to bronze, silver and gold tables.

Every step is a plain ``DataFrame -> DataFrame`` function; reading and writing
happen only in ``shelfline.sources`` and the layer runs in ``shelfline.plans``.
"""

__version__ = "0.1.0"
