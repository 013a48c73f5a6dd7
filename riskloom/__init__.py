"""riskloom — PySpark-native cohort construction, leak-safe splitting and encoding,
exact distributed ranking metrics, batch text-scoring jobs and experiment
leaderboards.

Every operator is a ``DataFrame -> DataFrame`` function whose column names are
parameters; nothing data-sized is collected to the driver.
"""

__version__ = "0.1.0"
