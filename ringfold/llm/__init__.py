"""Operators of a training-data pipeline. Nothing else in ringfold imports this subpackage."""
