"""brindle.sources"""
