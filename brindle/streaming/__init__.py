"""brindle.streaming"""
