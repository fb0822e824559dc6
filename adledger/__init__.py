"""adledger: daily advertising performance tables on Spark.

Raw, append-only reports of three ad networks (search, search partner,
social) become clean daily tables per ad and per keyword for all sites in
one job.  Every step is a DataFrame function; see README.md.
"""

__version__ = "0.1.0"
