"""tsgrid.streaming"""
