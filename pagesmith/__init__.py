"""Web-page harvesting and structured extraction as Spark jobs.

Layout
------
functions  : Column -> Column expressions (text, url, html, tokens, chunks, json)
sources    : tables of fetched pages and documents, and page frontiers
operators  : DataFrame -> DataFrame steps (cards, tables, listings, runs, vectors, ...)
plans      : the end-to-end jobs composed from the operators
streaming  : the same extraction job over newly arriving page files
"""
