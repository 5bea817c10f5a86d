"""sparkgate.sources"""
