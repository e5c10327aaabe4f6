"""Operators of a training-data pipeline. Nothing else in ambermill imports this subpackage."""
