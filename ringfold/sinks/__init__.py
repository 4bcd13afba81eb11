"""ringfold.sinks"""
