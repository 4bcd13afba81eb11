"""ringfold.operators"""
