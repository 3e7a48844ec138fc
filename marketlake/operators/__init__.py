"""marketlake.operators"""
