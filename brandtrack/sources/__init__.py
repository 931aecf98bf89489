"""Inputs and outputs: star-schema tables, the conversion list, published results."""
