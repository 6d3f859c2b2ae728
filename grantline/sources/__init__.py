"""Landed exports and catalog tables as DataFrames."""
