"""ringfold.plans"""
