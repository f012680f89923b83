"""Playlist analytics and recommendation operators on Spark DataFrames."""
