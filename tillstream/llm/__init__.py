"""Training-data operators: quality, secrets, near-duplicates, tokens, search, mixing and sharding.

Nothing outside this folder imports it. The modules hold the operators; ``queries`` and ``oracle``
register them for the driver.
"""
