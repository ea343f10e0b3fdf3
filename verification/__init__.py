"""Registered queries and their SQL counterparts on the given tables.

``inputs`` maps the given tables onto the raw haulage tables the library cleans; ``ctes``
says the same, and what every plan should give, in SQL.  ``cases`` pairs them up.
"""
