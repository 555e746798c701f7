"""creditstats: film-credit and box-office analytics on Spark.

Layout:
  functions/  Column -> Column cleaning expressions (names, dates, money)
  sources/    driver tables, HTML page extraction (one mapInArrow job)
  operators/  item cleaning, star-schema modelling, reports, ordering
  plans/      end-to-end flows and the role-mapped queries over driver tables
  sinks/      CSV reports and table output
  streaming/  the same transformations on Structured Streaming
"""

__version__ = "0.1.0"
