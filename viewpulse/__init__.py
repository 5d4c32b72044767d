"""User-engagement analytics on Spark: plain DataFrame-to-DataFrame operators."""
