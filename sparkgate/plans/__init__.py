"""sparkgate.plans"""
