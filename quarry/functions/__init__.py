"""quarry.functions"""
