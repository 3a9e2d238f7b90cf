"""kinora: a Spark-native catalogue and ratings analytics engine.

Everything is expressed as DataFrame / SQL work so that Catalyst and AQE pick
the physical plan.  Sub-packages:

* ``sources``   - readers for raw item/rating files and the driver-table fixtures
* ``functions`` - column expressions (year parsing, title cleaning, rounding ...)
* ``operators`` - DataFrame -> DataFrame building blocks (clean, summarise,
                  TF-IDF, similarity, serving reads, linkage, append, quality)
* ``plans``     - composites (the full pipeline, the registered query set)
* ``streaming`` - incremental (availableNow) variants of the batch jobs
"""

__version__ = "0.1.0"
