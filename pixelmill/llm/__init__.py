"""Training-data operators over text, vectors, pages and conversations.

Nothing outside this folder imports it.  Every module holds one operator; ``queries`` registers the
thin contract queries and ``oracles`` their SQL.
"""
