"""SQL that states the expected results independently."""
