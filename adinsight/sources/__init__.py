"""Inputs: the request control table, the delivery facts, fixed lookups."""
