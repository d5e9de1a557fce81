"""brindle.functions"""
