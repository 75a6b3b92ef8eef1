"""phonoloom.streaming"""
