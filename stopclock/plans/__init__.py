"""Jobs: readers, operators and writers put together."""
