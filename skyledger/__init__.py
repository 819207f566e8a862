"""skyledger: a Spark-native star-schema warehouse for visual meteor observations.

Raw session, rate, magnitude and weather exports become conformed
dimensions and facts; OLAP questions (slice, roll-up, drill-across,
histogram mean, pivot) run on top.  Everything is DataFrame / Spark SQL so
Catalyst and AQE plan the work.
"""

__version__ = "0.1.0"
