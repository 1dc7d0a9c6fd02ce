"""Social-feed processing as Spark DataFrame operators.

Feeds, tweets and mail become one record, the *drop*; drops are matched to the
user streams (*rivers*) that subscribed to them, enriched, and prepared for
outside deployments.  Every operator takes and returns DataFrames.
"""
