"""Operators of a large-scale training-data pipeline (documents, chats, token ids).

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries only when it can be imported.
"""
