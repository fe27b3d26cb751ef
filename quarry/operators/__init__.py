"""quarry.operators"""
