"""Company-and-location intake as Spark DataFrame jobs.

``functions``  Column expressions, no session needed
``sources``    scans and feed mappings
``operators``  DataFrame -> DataFrame steps
``plans``      the composed jobs (ingest, score and queue, evaluate, ...)
``streaming``  Structured Streaming forms of ingest and review
"""
