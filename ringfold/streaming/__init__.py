"""ringfold.streaming"""
