"""Jobs and views put together from sources and operators."""
