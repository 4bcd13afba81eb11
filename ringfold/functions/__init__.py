"""ringfold.functions"""
