"""Queries over the test tables, each with the SQL that gives the same rows.

`all_queries()` maps a name to (Spark function, SQL text or None).
"""

from quirework.queries import catalogue, nested, relational, star, storage, text


def all_queries() -> dict:
    found: dict = {}
    for module in (relational, storage, text, catalogue, nested, star):
        for name, pair in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is defined twice")
            found[name] = pair
    return found
