"""The library's operators run over the test tables, next to equivalent SQL."""
