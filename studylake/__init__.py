"""studylake: a Spark-native warehouse load for wearable-device study data.

Raw JSON drops of sensor readings and participant-reported events are
normalised into partitioned Parquet zones, resolved against a star schema and
loaded into an event fact, an hourly aggregate fact (upserted when late data
arrives) and a reject account.  Every step is a DataFrame plan; nothing on the
data path goes through the driver.
"""

__version__ = "0.1.0"
