"""ringfold.sources"""
