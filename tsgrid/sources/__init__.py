"""tsgrid.sources"""
