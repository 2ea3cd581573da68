"""DataFrame operators that take column names, so they run on any table."""
