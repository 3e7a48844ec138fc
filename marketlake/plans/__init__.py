"""marketlake.plans"""
