"""Tidemark: layered event analytics on Spark DataFrames.

JSON event streams land in an append-only Bronze layer, are cleaned into Silver,
rolled up into hourly Gold metrics, and hours that leave their entity's own
statistical baseline are flagged. Everything between a source and a sink is a
plain ``DataFrame -> DataFrame`` function without actions.
"""
