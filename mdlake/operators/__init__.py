"""DataFrame operators; every one is ``op(df, ...) -> DataFrame`` and lazy."""
