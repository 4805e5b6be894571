"""Training-data operators: tokens, licences, search, language, PII, URLs, leaks, copies, HTML.

Nothing else in the package imports this one; ``queries`` here registers the
``opN_*`` queries for the driver entry.
"""
