"""mercato: retail sales analytics on Spark.

Raw transactions -> star schema (date, store, product and customer-group
dimensions around a sales fact) -> aggregate marts -> declarative data
quality checks -> exploratory questions. Everything is expressed with
DataFrames and built-in functions so Catalyst and AQE plan the work.
"""

__version__ = "0.1.0"
