"""phonoloom.sources"""
