"""folioforge.plans"""
