"""mdlake: market-data lake jobs written as plain Spark DataFrame transforms."""
