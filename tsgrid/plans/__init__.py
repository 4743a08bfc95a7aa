"""tsgrid.plans"""
