"""sparkgate.operators"""
