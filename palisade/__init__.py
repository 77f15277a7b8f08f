"""Exposure analytics over vulnerability findings, written as Spark DataFrame plans."""
