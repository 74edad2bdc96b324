"""tidemark: a Spark-native CDC lakehouse job suite.

bronze change feeds -> silver latest-image tables -> gold sales mart, written
as DataFrame plans (see README.md).
"""

__version__ = "0.1.0"
