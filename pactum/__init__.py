"""pactum: public-procurement analytics as plain Spark DataFrame jobs.

Every job is a function ``DataFrame -> DataFrame``; nothing is collected to
the driver except bounded metadata (column lists, a handful of scalars).
"""

__version__ = "0.1.0"
