"""vocalstat: descriptive statistics of versioned speech-corpus tables on Spark.

Every statistic is a DataFrame plan grouped by dataset key columns
(``ver, lc, alg, sp``) so that one job covers all datasets at once.
"""

__version__ = "0.1.0"
