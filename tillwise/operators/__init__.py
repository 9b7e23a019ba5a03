"""DataFrame -> DataFrame operators, no hidden I/O."""
