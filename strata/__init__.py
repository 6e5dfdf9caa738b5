"""strata: layered retail analytics (raw -> Bronze -> Silver -> Gold -> Platinum) on Spark.

Every builder is a plain DataFrame -> DataFrame function; see ``strata.plans``.
"""

__version__ = "0.1.0"
