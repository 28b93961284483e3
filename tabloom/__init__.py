"""tabloom: tabular analytics and ML preparation as plain PySpark jobs.

Every operator takes a DataFrame and returns a DataFrame, or is a ``pyspark.ml``
stage whose learned state can be fitted once, saved, and applied to batch and
streaming data alike.
"""
