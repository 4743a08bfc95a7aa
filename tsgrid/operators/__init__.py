"""tsgrid.operators"""
