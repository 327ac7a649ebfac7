"""Stages composed from operators, each DataFrames in, DataFrames out."""
