"""sparkgate.streaming"""
