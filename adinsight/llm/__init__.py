"""Operators of a training-data pipeline (see ``queries`` for their registered form).

Nothing outside this package imports it, except the driver contract file, which
adds its queries when the package is present.
"""
