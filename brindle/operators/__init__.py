"""brindle.operators"""
