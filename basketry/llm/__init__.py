"""Training-data pipeline operators: quality, licences, HTML, packing, secrets,
WARC revisits, source mixing, near-duplicates, token files and exact top-k.

Nothing outside this package imports it (``__spark_entry__`` adds its queries
when it is present).  Each module holds one operator with a general interface;
``registry`` holds the thin ``opN_*`` queries and their SQL.
"""
