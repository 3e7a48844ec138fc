"""marketlake.streaming"""
