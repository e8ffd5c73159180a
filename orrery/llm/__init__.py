"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the package imports this subpackage; ``corpus_pipeline.py``
and ``__spark_entry__.py`` (guarded) do.

An operator takes the columns it needs by name and carries the whole input
row as a struct, so other columns pass through whatever their names are, also
where they equal a name used inside. What nulls, empty and very long texts,
ties, repeated rows and empty tables give is stated in each module.
"""
