"""Cytoline: a Spark-native engine for cohort-scale interval, coverage and matrix analytics."""
