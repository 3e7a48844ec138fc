"""marketlake.sources"""
