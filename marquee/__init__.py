"""Viewing-engagement analytics as Spark DataFrame jobs.

``sources``    readers for the feeds, plus an adapter over commerce tables
``functions``  column expressions (text, calendar, number); no UDFs
``operators``  reusable DataFrame steps: keys, ranking, movement, checks
``plans``      the build job and every question asked of its tables
``streaming``  incremental ingest of landed video statistics
"""
