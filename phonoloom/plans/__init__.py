"""phonoloom.plans"""
